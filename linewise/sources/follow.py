"""Log files that are still being written, as a resumable stream of lines.

A streaming source whose position is (file, byte). Every trigger is planned first: byte ranges of
whole lines, up to a number of bytes, are written as the next entry of a plan beside the
query's position, and the offset Spark keeps is that entry's number. So a restarted query
re-reads exactly the ranges of an unfinished batch and goes on behind them. A file is known by
its inode, so it is followed through rotation by renaming; one that shrinks (a copy and
truncate) starts again. Long ranges are split over tasks at any byte: a line belongs to the
piece it starts in. A last line without its newline waits.

Files must lie on a file system that the driver and the executors have mounted, as the files
a collector tails do.
"""

from __future__ import annotations

import glob
import json
import os
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..session import ship_package

NAME = "linewise_log_lines"
BLOCK = 1 << 16


def local_path(path: str) -> str:
    """A mounted path from a path or a ``file:`` address; other stores cannot be followed."""
    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme and scheme[1] != "file":
        raise ValueError(f"{path}: only mounted file systems can be followed")
    return re.sub(r"^file:/*", "/", path)


def _line_end(path: str, start: int, most: int, size: int) -> int:
    """Where the last whole line ends within ``most`` bytes from ``start``; if the first line
    is longer, where it ends; ``start`` if it has not ended yet."""
    stop = min(size, start + most)
    with open(path, "rb") as f:
        at = stop
        while at > start:
            begin = max(start, at - BLOCK)
            f.seek(begin)
            found = f.read(at - begin).rfind(b"\n")
            if found >= 0:
                return begin + found + 1
            at = begin
        at = stop
        f.seek(at)
        while at < size:
            block = f.read(min(BLOCK, size - at))
            if not block:
                break
            if (found := block.find(b"\n")) >= 0:
                return at + found + 1
            at += len(block)
    return start


def _identity(info: os.stat_result) -> str:
    return f"{info.st_dev}:{info.st_ino}"


@dataclass
class Piece(InputPartition):
    """Lines that start in [start, stop) of a file; none starts at ``end`` or later."""

    path: str
    identity: str
    name: str
    start: int
    stop: int
    end: int
    first: bool


class Intake:
    """The plan: numbered entries, each with its ranges and where every file then stands."""

    def __init__(self, pattern: str, position: str, max_bytes: int, split_bytes: int, max_age: float):
        self.pattern, self.position = local_path(pattern), local_path(position)
        self.max_bytes, self.split_bytes, self.max_age = max_bytes, split_bytes, max_age
        os.makedirs(self.position, exist_ok=True)

    def _entry(self, number: int) -> str:
        return os.path.join(self.position, f"{number}.json")

    def last(self) -> int:
        return max((int(n[:-5]) for n in os.listdir(self.position) if re.fullmatch(r"\d+\.json", n)), default=0)

    def entry(self, number: int) -> dict:
        if not number:
            return {"ranges": [], "files": {}}
        with open(self._entry(number)) as f:
            return json.load(f)

    def _here(self, known: dict) -> dict[str, tuple[str, os.stat_result]]:
        """Files by identity: those the pattern names, and known ones under whatever name."""
        found: dict[str, tuple[str, os.stat_result]] = {}
        folders = {os.path.dirname(f["path"]) for f in known.values()}
        names = glob.glob(self.pattern, recursive=True)
        others = [os.path.join(d, n) for d in folders if os.path.isdir(d) for n in os.listdir(d)]
        for path, named in [*((p, True) for p in names), *((p, False) for p in others)]:
            try:
                info = os.stat(path)
            except FileNotFoundError:  # gone since it was listed
                continue
            identity = _identity(info)
            if os.path.isfile(path) and identity not in found and (named or identity in known):
                found[identity] = (path, info)
        return found

    def extend(self) -> int:
        """The number of the newest entry, after one more if there is anything new."""
        last = self.last()
        files = self.entry(last)["files"]
        here, ranges, left, shrunk = self._here(files), [], self.max_bytes, False
        after: dict[str, dict] = {}
        for identity, (path, info) in sorted(here.items(), key=lambda x: (x[1][1].st_mtime_ns, x[1][0])):
            state = files.get(identity)
            if state is None:
                if last == 0 and self.max_age and time.time() - info.st_mtime > self.max_age:
                    state = {"name": path, "pos": info.st_size, "generation": 0}  # untouched for long at the first start
                else:
                    state = {"name": path, "pos": 0, "generation": 0}
            state = {**state, "path": path}
            if info.st_size < state["pos"]:
                state |= {"pos": 0, "generation": state["generation"] + 1}
                shrunk = True  # to be remembered: it may grow past the old position before the next look
            if left > 0 and info.st_size > state["pos"]:
                end = _line_end(path, state["pos"], left, info.st_size)
                if end > state["pos"]:
                    ranges.append({"path": path, "identity": identity, "name": f"{state['name']}#{identity}.{state['generation']}", "start": state["pos"], "end": end})
                    left -= end - state["pos"]
                    state["pos"] = end
            after[identity] = state
        if not ranges and not shrunk:
            return last
        draft = self._entry(last + 1) + ".draft"
        with open(draft, "w") as f:
            json.dump({"ranges": ranges, "files": after}, f)
            f.flush()
            os.fsync(f.fileno())
        os.replace(draft, self._entry(last + 1))
        return last + 1

    def pieces(self, start: int, end: int) -> list[Piece]:
        out = []
        for number in range(start + 1, end + 1):
            for r in self.entry(number)["ranges"]:
                for at in range(r["start"], r["end"], self.split_bytes):
                    out.append(Piece(path=r["path"], identity=r["identity"], name=r["name"], start=at, stop=min(at + self.split_bytes, r["end"]), end=r["end"], first=at == r["start"]))
        return out

    def forget(self, before: int) -> None:
        """Entries that no restart can ask for any more."""
        for name in os.listdir(self.position):
            if re.fullmatch(r"\d+\.json", name) and int(name[:-5]) < before:
                os.remove(os.path.join(self.position, name))


def _place_of(piece: Piece) -> str:
    """The file's name now; it may have been renamed since it was planned."""
    folder = os.path.dirname(piece.path)
    for path in [piece.path, *(os.path.join(folder, n) for n in sorted(os.listdir(folder)))]:
        try:
            if _identity(os.stat(path)) == piece.identity:
                return path
        except FileNotFoundError:
            continue
    raise FileNotFoundError(f"{piece.name}: its bytes {piece.start} to {piece.end} were planned, and the file is gone")


def read_piece(piece: Piece, block: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The lines that start in a piece, as ``file, pos, text``; ``pos`` is the line's first byte."""
    with open(_place_of(piece), "rb") as f:
        at = piece.start
        if not piece.first:  # the line that reaches into this piece is the one before's
            f.seek(at - 1)
            at += len(f.readline()) - 1
        f.seek(at)
        while at < piece.stop:
            starts, texts, size = [], [], 0
            while at < piece.stop and size < block:
                line = f.readline(piece.end - at)
                starts.append(at)
                texts.append(line.removesuffix(b"\n").decode("utf-8", "replace"))
                size += len(line)
                at += max(len(line), 1)
            yield pa.RecordBatch.from_arrays([pa.array([piece.name] * len(starts)), pa.array(starts, pa.int64()), pa.array(texts)], ["file", "pos", "text"])


class _Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.intake = Intake(options["path"], options["position"], int(options["max_bytes"]), int(options["split_bytes"]), float(options["max_age"]))

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        return {"entry": self.intake.extend()}

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        return self.intake.pieces(start["entry"], end["entry"])

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return read_piece(partition)

    def commit(self, end: dict) -> None:
        self.intake.forget(end["entry"] - 1)


class LogLines(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "file string, pos bigint, text string"

    def streamReader(self, schema) -> _Reader:
        return _Reader(self.options)


def follow_line_files(
    spark: SparkSession, path: str, position: str, max_bytes: int = 64 << 20, split_bytes: int = 16 << 20, max_age: float = 86_400
) -> DataFrame:
    """The lines of all files that ``path`` (a glob) names, as they are written: ``file, pos,
    text``. ``file`` stays the same through renaming, ``pos`` is the line's first byte.

    ``position`` is a folder of the query's own, kept like its checkpoint. A trigger takes at
    most ``max_bytes`` (or one line), a task ``split_bytes``. At the first start files
    untouched for ``max_age`` seconds are passed over (0: none are); later ones are read from
    their beginning."""
    ship_package(spark)
    spark.dataSource.register(LogLines)
    reader = spark.readStream.format(NAME).option("path", path).option("position", position)
    return reader.option("max_bytes", max_bytes).option("split_bytes", split_bytes).option("max_age", max_age).load()
