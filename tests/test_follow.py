"""Files that grow, rotate and shrink while they are read."""

import os

import pytest
from pyspark.sql import functions as F

from linewise.sources.follow import Intake, follow_line_files, local_path, read_piece


def drained(intake, done):
    """All lines from entry ``done`` on, and the newest entry."""
    rows, entries = [], 0
    while True:
        newest = intake.extend()
        if newest == done:
            return rows, newest, entries
        for piece in intake.pieces(done, newest):
            for batch in read_piece(piece, block=64):
                rows += zip(*(c.to_pylist() for c in batch.columns))
        done, entries = newest, entries + 1


def test_ranges_cover_every_line_once_whatever_the_sizes(tmp_path):
    texts = ["", "a", "\n", "one\ntwo\n\nthree", "x" * 5000 + "\ny\n", "é😀\n" * 300, "\n\n\n", "no newline at all" * 20]
    for n, (most, split) in enumerate([(1, 1), (7, 3), (64, 1000), (10**6, 17), (10**6, 10**6)]):
        folder = tmp_path / str(n)
        folder.mkdir()
        for k, text in enumerate(texts):
            (folder / f"{k}.log").write_text(text)
        rows, _, entries = drained(Intake(f"{folder}/*.log", f"{folder}/position", most, split, 0), 0)
        got = {k: [t for f, _, t in sorted(rows) if f.split("#")[0].endswith(f"/{k}.log")] for k in range(len(texts))}
        assert got == {k: t.split("\n")[:-1] for k, t in enumerate(texts)}
        assert len({(f, p) for f, p, _ in rows}) == len(rows) and (entries > 3 or most > 64)
        for f, p, text in rows:
            raw = (folder / os.path.basename(f.split("#")[0])).read_bytes()
            assert raw[p:].startswith(text.encode() + b"\n") and (p == 0 or raw[p - 1 : p] == b"\n")


def test_appends_rotation_and_truncation(tmp_path):
    log, place = tmp_path / "app.log", Intake(f"{tmp_path}/app.log", f"{tmp_path}/position", 1000, 10, 0)
    log.write_text("1\n2\nhal")
    rows, at, _ = drained(place, 0)
    assert [r[2] for r in rows] == ["1", "2"]
    with log.open("a") as f:
        f.write("f\n4\n")
    log.rename(tmp_path / "rotated-away")
    log.write_text("5\n")
    rows, at, _ = drained(Intake(f"{tmp_path}/app.log", f"{tmp_path}/position", 1000, 10, 0), at)
    assert sorted(r[2] for r in rows) == ["4", "5", "half"] and len({r[0] for r in rows}) == 2
    planned = place.pieces(at - 1, at)
    with log.open("r+") as f:
        f.truncate(0)
        f.write("6")
    rows, at, _ = drained(place, at)
    assert rows == []
    with log.open("a") as f:
        f.write("\n")
    rows, at, _ = drained(place, at)
    assert [r[2] for r in rows] == ["6"]
    with log.open("a") as f:
        f.write("7\n8\n")
    assert [r[2] for r in drained(place, at)[0]] == ["7", "8"]
    log.unlink()
    (tmp_path / "rotated-away").unlink()
    with pytest.raises(FileNotFoundError):
        list(read_piece(planned[0]))


def test_old_files_are_passed_over_at_the_first_start_only(tmp_path):
    old, new = tmp_path / "old.log", tmp_path / "new.log"
    old.write_text("old\n"), new.write_text("new\n")
    os.utime(old, (1, 1))
    place = Intake(f"{tmp_path}/*.log", f"{tmp_path}/position", 1000, 1000, 3600)
    rows, at, _ = drained(place, 0)
    assert [r[2] for r in rows] == ["new"]
    with old.open("a") as f:
        f.write("fresh\n")
    assert [r[2] for r in drained(place, at)[0]] == ["fresh"]


def test_only_mounted_stores_can_be_followed():
    assert local_path("file:///a/b") == local_path("file:/a/b") == local_path("/a/b") == "/a/b"
    with pytest.raises(ValueError):
        local_path("hdfs://host/a")


def test_a_query_goes_on_where_it_was_stopped(spark, tmp_path):
    folder = tmp_path / "logs"
    folder.mkdir()
    for k in range(3):
        (folder / f"{k}.log").write_text("".join(f"{k}-{i}\n" for i in range(400)))

    def go():
        lines = follow_line_files(spark, f"{folder}/*.log", f"{tmp_path}/position", max_bytes=1500, split_bytes=400, max_age=0)
        writer = lines.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/checkpoint")
        return writer.start(f"{tmp_path}/out")

    first = go()
    while len(first.recentProgress) < 2 and first.isActive:
        first.processAllAvailable() if first.lastProgress and first.lastProgress["numInputRows"] == 0 else None
    first.stop()
    with (folder / "0.log").open("a") as f:
        f.write("0-400\n")
    second = go()
    second.processAllAvailable()
    second.stop()
    out = spark.read.parquet(f"{tmp_path}/out")
    want = sorted([f"{k}-{i}" for k in range(3) for i in range(400)] + ["0-400"])
    assert sorted(r.text for r in out.collect()) == want
    assert out.select("file", "pos").distinct().count() == len(want)
    assert max(int(n.split(".")[0]) for n in os.listdir(tmp_path / "position")) >= 5
    assert out.filter(F.col("pos") == 0).count() == 3
