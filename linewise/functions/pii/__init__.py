"""Removal of personal data and secrets from text, names and nested columns."""

from .keys import is_sensitive_key, key_marker
from .options import Options
from .text import redact_text
from .walk import redact, redact_column, redact_json

__all__ = ["Options", "is_sensitive_key", "key_marker", "redact", "redact_column", "redact_json", "redact_text"]
