"""Which rules run."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    """``preserve_structure`` keeps a sensitive field with a marker instead of dropping
    it; the switches below it are groups of rules.

    A text of ``long_bytes`` or more is redacted by the Python rules, each of which has
    ``rule_seconds``; one that cannot be finished becomes a marker, and no other row is
    concerned. (Without phones and keys no text ever goes to Python.)"""

    preserve_structure: bool = True
    emails: bool = True
    api_keys: bool = True
    tokens: bool = True
    passwords: bool = True
    phones: bool = True
    cards: bool = True
    ips: bool = True
    urls: bool = True
    uuids: bool = False
    long_bytes: int = 4 << 20
    rule_seconds: float = 60.0


DEFAULT = Options()
