"""Chat formatting of typed content parts.

A turn's parts are visited in order. Texts are joined and escaped; each image, audio or document
part becomes a placeholder, and an attachment with its reference and the number of tokens that
the placeholder stands for. A turn is formatted on its own, one row each, so a conversation
of any length is written, read and checked as a stream of its turns.

Control strings open with ``<|``. In texts and roles ``<``, any backslashes and ``|`` get one more
backslash before the bar, and lose it again when read, so no text can hold a control string.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = "array<struct<kind:string,text:string,ref:string,width:long,height:long,seconds:double,pages:long>>"
START, END = "<|im_start|>", "<|im_end|>"
_OPEN, _ESCAPED = re.compile(r"<(\\*)\|"), re.compile(r"<\\(\\*)\|")
_TURN = re.compile(r"<\|im_start\|>([^\n]*)\n(.*)<\|im_end\|>\n", re.S)
_PLACEHOLDER = re.compile(r"<\|(image|audio|document):(\d+)\|>")


def escape(text: str) -> str:
    return _OPEN.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


def escape_role(role: str) -> str:
    """Roles stand on one line, so their line ends and backslashes are written out too."""
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


@dataclass(frozen=True)
class Expansion:
    """Tokens that a placeholder stands for."""

    tile: int = 512
    tile_tokens: int = 170
    image_tokens: int = 85
    audio_per_second: float = 25.0
    page_tokens: int = 750

    def image(self, width: int, height: int) -> int:
        return self.image_tokens + self.tile_tokens * -(-max(width, 1) // self.tile) * -(-max(height, 1) // self.tile)

    def audio(self, seconds: float) -> int:
        return max(1, round(max(seconds, 0.0) * self.audio_per_second))

    def document(self, pages: int) -> int:
        return max(1, pages) * self.page_tokens


@dataclass
class Flattener:
    """Visits a turn's parts; ``pieces`` is what is written, ``attachments`` what it refers to."""

    expansion: Expansion
    pieces: list[str] = field(default_factory=list)
    attachments: list[tuple[int, str, str | None, int]] = field(default_factory=list)
    _texts: list[str] = field(default_factory=list)

    def visit(self, part: dict | None) -> None:
        if part is not None:
            getattr(self, f"visit_{part['kind'] or 'text'}", self.visit_other)(part)

    def visit_text(self, part: dict) -> None:
        self._texts.append(part["text"] or "")

    def visit_image(self, part: dict) -> None:
        self._attach(part, self.expansion.image(part["width"] or 1, part["height"] or 1))

    def visit_audio(self, part: dict) -> None:
        self._attach(part, self.expansion.audio(part["seconds"] or 0.0))

    def visit_document(self, part: dict) -> None:
        self._attach(part, self.expansion.document(part["pages"] or 1))

    def visit_other(self, part: dict) -> None:
        raise ValueError(f"a part of unknown kind {part['kind']!r}")

    def _attach(self, part: dict, tokens: int) -> None:
        self._flush()
        number = len(self.attachments)
        self.pieces.append(f"<|{part['kind']}:{number}|>")
        self.attachments.append((number, part["kind"], part["ref"], tokens))

    def _flush(self) -> None:
        if self._texts:
            self.pieces.append(escape("".join(self._texts)))
            self._texts.clear()

    def content(self) -> str:
        self._flush()
        return "".join(self.pieces)


def text_parts(text: Column) -> Column:
    """A plain text column as one text part."""
    blank = (F.lit(None).cast(t).alias(n) for n, t in (("ref", "string"), ("width", "long"), ("height", "long"), ("seconds", "double"), ("pages", "long")))
    return F.array(F.struct(F.lit("text").alias("kind"), F.coalesce(text.cast("string"), F.lit("")).alias("text"), *blank)).cast(PARTS)


_OUT = "conv_id long, turn long, formatted string, loss_start long, loss_end long, n_expanded long, attachments array<struct<number:long,kind:string,ref:string,tokens:long>>"


def format_turns(turns: DataFrame, parts: Column, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", learned: tuple[str, ...] = ("assistant",), expansion: Expansion | None = None) -> DataFrame:
    """One row per turn: ``conv_id, turn, formatted, loss_start, loss_end, n_expanded, attachments``.

    The loss span, in code points of ``formatted``, is the content of a turn whose role is in
    ``learned``, and null otherwise. ``n_expanded`` adds up the attachments' tokens. A null role is
    empty, null parts are none, a null kind is text and an unknown kind is an error."""
    rules = expansion or Expansion()

    def run(batches):
        for batch in batches:
            rows = []
            for conv, turn, role, own in zip(*(c.to_pylist() for c in batch.columns)):
                visitor = Flattener(rules)
                for part in own or []:
                    visitor.visit(part)
                content, head = visitor.content(), f"{START}{escape_role(role or '')}\n"
                span = (len(head), len(head) + len(content)) if role in learned else (None, None)
                rows.append((conv, turn, f"{head}{content}{END}\n", *span, sum(a[3] for a in visitor.attachments), [dict(zip(("number", "kind", "ref", "tokens"), a)) for a in visitor.attachments]))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names)

    names = ["conv_id", "turn", "formatted", "loss_start", "loss_end", "n_expanded", "attachments"]
    item = pa.struct([("number", pa.int64()), ("kind", pa.string()), ("ref", pa.string()), ("tokens", pa.int64())])
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(item)]
    rows = turns.select(F.col(id_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), parts.alias("parts"))
    return rows.mapInArrow(run, _OUT)


def read_turn(formatted: str) -> tuple[str, list[str | tuple[str, int]]]:
    """A formatted turn's role, and its texts and ``(kind, number)`` placeholders in order."""
    found = _TURN.fullmatch(formatted)
    if not found:
        raise ValueError("not a formatted turn")
    out, at = [], 0
    for m in _PLACEHOLDER.finditer(found[2]):
        out += [unescape(found[2][at : m.start()]), (m[1], int(m[2]))]
        at = m.end()
    return unescape_role(found[1]), [*out, unescape(found[2][at:])]


def digests(formatted: DataFrame) -> DataFrame:
    """Each conversation read back from ``format_turns``: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars``.

    Turns go by number, equal numbers by what they say; rows with a null id are one conversation.
    A conversation is read as a stream of turns and never held whole."""
    order = ["conv_id", "turn", "formatted"]
    rows = formatted.select(*order, "loss_start", "loss_end")
    parts = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(parts, "conv_id").sortWithinPartitions(*order)

    def run(batches):
        key, state, done = None, None, []

        def close():
            if state:
                done.append((key, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4]))

        for batch in batches:
            for conv, _, text, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                if state is None or conv != key:
                    close()
                    key, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, content = read_turn(text)
                said = "".join(c for c in content if isinstance(c, str))
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                state[4] += len(text)
                if start is not None:
                    learned = unescape(_PLACEHOLDER.sub("", text[start:end]))
                    state[2] += len(learned)
                    state[3].update(learned.encode())
            if len(done) >= 10_000:
                yield batch_of(done)
                done.clear()
        close()
        yield batch_of(done)

    def batch_of(rows):
        columns = zip(*rows) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
