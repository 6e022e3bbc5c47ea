"""The rules on one Python string, for the few rows whose text needs the two rules that
are not plain patterns: phone numbers and path-like encoded runs."""

from __future__ import annotations

import unicodedata
from bisect import bisect_left, bisect_right
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate

import regex

from .options import Options
from .rules import (
    ENCODED_MARKER,
    ENCODED_RUN,
    FAILED_MARKER,
    FOLD_NEEDED,
    NBSP_ENTITY,
    PHONE,
    PHONE_MARKER,
    RULES,
    SPACE,
)

# --- fixed values: phone numbers -----------------------------------------------------
CONTEXT_WORDS = ("phone", "mobile", "cell", "contact", "tel", "call")
CONTEXT_UNITS = 15
MIN_DIGITS, FULL_DIGITS, STATUS_DIGITS, MAX_DIGITS, MARKER_DIGITS = 7, 11, 10, 15, 2
AT_SIGNS = "\uFE6B\u24B6\u24D0\u249C\U0001f110\U0001f130\U0001f150\U0001f170"

# --- fixed values: words of a URL path -------------------------------------------------
PATH_WORD = r"(?:[a-z]+|[A-Z][a-z]+)(?:[A-Z][a-z]+)*[0-9]{0,2}|[A-Z]{1,4}[0-9]{0,2}|[a-z][0-9]{1,2}|[0-9]+"
LONG_PATH_WORD = r"(?:[a-z]+|[A-Z](?>[a-z]*[aeiouy][a-z]*|[a-z]))(?:[A-Z](?>[a-z]*[aeiouy][a-z]*|[a-z]))*[0-9]{0,2}"
CLUSTERS = r"ch|ck|gh|ng|ph|sh|th|wh|scr|spl|spr|str|ql"
CONSONANT = r"[^aeiouy0-9]"
NAME_WORD = r"[A-Za-z][a-z]{2,}"


def _compiled(pattern: str) -> regex.Pattern:
    return regex.compile(pattern, regex.ASCII)


_phone, _fold_needed = _compiled(PHONE), _compiled(FOLD_NEEDED)
_international = _compiled(r"\+[1-9][0-9]{0,14}")
_formatting = _compiled(rf"[().{SPACE}-]|^\+")
_foldable = regex.compile(rf"[^\x00-\x7F]|=\r?\n|(?i:{NBSP_ENTITY})")
_marker = _compiled(regex.escape(PHONE_MARKER))
# the next group of a number: separators, then a marker or digits that are no date, time
# or UUID; the unit that would follow a measured value is looked for apart
_group = _compiled(
    rf"[ \t./()-]{{0,3}}+(?:({regex.escape(PHONE_MARKER)})"
    r"|(?![0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}:[0-9]{2}|[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-)([0-9]{1,10}+)(?![0-9A-Za-z]))"
)
_unit = _compiled(r"[ \t]?(?:ms|secs?|s|bytes|kb|mb|gb|kib|mib|KB|MB|KiB|MiB)(?![0-9A-Za-z])")
_run = _compiled(ENCODED_RUN)
_authority = _compiled(rf"://(?:[^{SPACE}/?#@]*+@)*+([A-Za-z0-9.-]*+(?::[0-9]*+)?+)")
# a piece of a path that reads as one: a number; or a word, long ones capitalised with a vowel in each
# part, in which no four consonants follow each other, a cluster that is said as one counting as one
_hard = rf"(?i:(?>{CLUSTERS}|.)*?(?>{CLUSTERS}|{CONSONANT}){{4}})"
_path_piece = _compiled(rf"[0-9]+|(?!{_hard})(?:(?=.{{1,7}}\Z)|(?=.{{8}})(?=(?:{LONG_PATH_WORD})\Z))(?:{PATH_WORD})")
_name = _compiled(NAME_WORD)
_letter = _compiled("[A-Za-z]")
_context = regex.compile("|".join(CONTEXT_WORDS), regex.ASCII | regex.IGNORECASE)


@lru_cache(maxsize=4096)
def _fold_char(char: str) -> str:
    category = unicodedata.category(char)
    if category == "Cf":
        return ""
    if char in AT_SIGNS:
        return "@"
    if category == "Zs":
        return " "
    if category == "Pd" or char == "\u2212":
        return "-"
    folded = unicodedata.normalize("NFKC", char)
    return folded if folded == "" or any(c < "\x80" for c in folded) else char


def _soft_or_entity(piece: str) -> str | None:
    if piece[0] == "=":
        return ""
    # an entity longer than ten characters asks for the fold but is not folded
    return (" " if len(piece) <= 10 else piece) if piece[0] == "&" else None


class _Folded:
    """A text as the phone rule reads it, and the way back to the original."""

    def __init__(self, text: str):
        self.spans: list[tuple[int, int, int, int]] = []  # folded from, to, original from, to
        self.text = text
        if not _fold_needed.search(text):
            return
        out, copied, length = [], 0, 0
        for m in _foldable.finditer(text):
            piece = m.group()
            folded = _soft_or_entity(piece)
            folded = _fold_char(piece) if folded is None else folded
            if folded == piece:
                continue
            out += [text[copied : m.start()], folded]
            at = length + m.start() - copied
            length = at + len(folded)
            self.spans.append((at, length, m.start(), m.end()))
            copied = m.end()
        self.text = "".join(out) + text[copied:]

    def original(self, at: int) -> tuple[int, int]:
        """Start and end of the original character a folded one came from."""
        i = bisect_right(self.spans, (at, 1 << 60, 0, 0)) - 1
        if i < 0:
            return at, at + 1
        start, end, origin, origin_end = self.spans[i]
        if at < end:
            return origin, origin_end
        return origin_end + at - end, origin_end + at - end + 1


class _Units:
    """Places of a text in UTF-16 units, and the context words between them."""

    def __init__(self, text: str):
        self.at = None if text.isascii() or max(text) <= "\uFFFF" else [0, *accumulate(1 + (c > "\uFFFF") for c in text)]
        found = _context.finditer(text, overlapped=True)
        self.words = sorted((self.of(m.start()), self.of(m.end())) for m in found)

    def of(self, place: int) -> int:
        return place if self.at is None else self.at[place]

    def word_near(self, start: int, end: int) -> bool:
        """Whether a context word lies whole within CONTEXT_UNITS of both ends."""
        low, high = self.of(start) - CONTEXT_UNITS, self.of(end) + CONTEXT_UNITS
        k = bisect_left(self.words, (low, 0))
        return k < len(self.words) and self.words[k][1] <= high


@dataclass(frozen=True)
class _Group:
    """Digits (or, with none, a marker) that may go on with a number, up to ``end``."""

    end: int
    digits: int
    status: bool
    measured: bool

    def fits(self, before: int) -> bool:
        if before >= STATUS_DIGITS and (self.status or self.measured):
            return False
        return before + self.digits <= MAX_DIGITS and (before < FULL_DIGITS or self.digits <= 2)


def _groups(text: str, at: int):
    while m := _group.match(text, at):
        at, run = m.end(), m.group(2) or ""
        yield _Group(at, len(run), len(run) == 3 and run[0] in "12345", bool(run) and _unit.match(text, at) is not None)


def _reach(text: str, end: int, digits: int) -> tuple[int, int]:
    """Where a number of ``digits`` up to ``end`` stops, and how many it has then."""
    for group in _groups(text, end):
        if not group.digits:
            end, digits = group.end, max(digits, MARKER_DIGITS)
        elif not group.fits(digits):
            break
        else:
            last, end, digits = digits >= FULL_DIGITS, group.end, digits + group.digits
            if last:
                break
    return end, digits


def _replace_spans(text: str, pattern: regex.Pattern, end_of) -> str:
    """Puts the phone marker on each span ``(match start, end_of(match, units))`` of the folded
    text that is not None, at the places it came from."""
    view = _Folded(text)
    units, spans, free, at = None, [], 0, 0
    while m := pattern.search(view.text, at):
        at = m.end()
        first = view.original(m.start())[0]
        if first < free:
            continue
        units = units or _Units(view.text)
        end = end_of(m, units)
        if end is not None:
            at, free = end, view.original(end - 1)[1]
            spans.append((first, free))
    edges = [0, *(edge for span in spans for edge in span), len(text)]
    return PHONE_MARKER.join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _after_marker(m: regex.Match, units: _Units) -> int:
    return _reach(m.string, m.end(), MARKER_DIGITS)[0]


def _phone_end(m: regex.Match, units: _Units) -> int | None:
    if _international.fullmatch(m.group()):
        end, digits = _reach(m.string, m.end(), m.end() - m.start() - 1)
        return end if digits >= MIN_DIGITS else None
    written = _formatting.search(m.group()) is not None
    return m.end() if written or units.word_near(m.start(), m.end()) else None


def redact_phones(text: str) -> str:
    if PHONE_MARKER in text:
        text = _replace_spans(text, _marker, _after_marker)
    return _replace_spans(text, _phone, _phone_end)


def _encoded(run: str, following: str) -> str:
    """What stays of an encoded run: nothing, or, where its pieces read as a URL path, those
    that are words of one."""
    pieces = run.split("/")
    facts = Counter()
    shown = []
    for piece in pieces:
        kept = not piece or _path_piece.fullmatch(piece) is not None
        facts["kept"] += kept
        facts["words"] += kept and len(piece) > 1 and _letter.search(piece) is not None
        facts["names"] += _name.fullmatch(piece) is not None
        shown.append(piece if kept else ENCODED_MARKER)
    padded = following == "=" or not {"+", "="}.isdisjoint(run)
    is_path = facts["words"] >= 4 and facts["names"] >= 2 and facts["words"] > len(pieces) - facts["kept"]
    return "/".join(shown) if is_path and not padded else ENCODED_MARKER


def redact_encoded(text: str) -> str:
    runs = [m.span() for m in _run.finditer(text)]
    if not runs:
        return text
    hosts = [m.span(1) for m in _authority.finditer(text) if m.end(1) > m.start(1)]
    edges = []
    for start, end in runs:
        # A run that starts in a host and leaves it by a slash counts from behind that slash.
        k = bisect_right(hosts, (start, len(text))) - 1
        leaves = k >= 0 and start < hosts[k][1] < end and text[hosts[k][1]] == "/"
        edges.append((hosts[k][1] + 1 if leaves else start, end))
    between = [0, *(end for _, end in edges)], [*(start for start, _ in edges), len(text)]
    clear = [text[a:b] for a, b in zip(*between)]
    shown = [_encoded(text[a:b], text[b : b + 1]) for a, b in edges]
    return "".join(part for pair in zip(clear, [*shown, ""]) for part in pair)


@lru_cache(maxsize=65536)
def redact_name(name: str, options: Options) -> str:
    """A field name under the rules for names; names repeat from document to document."""
    return redact_string(name, options, names=True)


_SPECIAL = {"phone": redact_phones, "encoded": redact_encoded}


@lru_cache(maxsize=64)
def _steps(options: Options, names: bool):
    steps = []
    for rule in RULES:
        if not getattr(options, rule.group) or (names and not rule.in_names):
            continue
        if rule.special:
            steps.append((rule.needs, rule.caseless, _SPECIAL[rule.special]))
        else:
            pattern, into = _compiled(rule.pattern), rule.replacement.replace("$1", r"\g<1>").replace("$2", r"\g<2>")
            steps.append((rule.needs, rule.caseless, lambda t, p=pattern, r=into: p.sub(r, t, timeout=options.rule_seconds)))
    return steps


# every rule needs one of these somewhere, or a run of 32 letters
_live = _compiled(r"[^A-Za-z ,.]|eyJ|(?i:bearer)|[A-Za-z]{32}")


def redact_string(text: str, options: Options, names: bool = False) -> str:
    """Every rule in order; a text a rule cannot run on is given up whole."""
    if not _live.search(text):
        return text
    try:
        for needs, caseless, run in _steps(options, names):
            seen = text.lower() if caseless else text
            if not needs or any(n in seen for n in needs):
                text = run(text)
        return text
    except Exception:  # noqa: BLE001 - a partly redacted text must never leave
        return FAILED_MARKER
