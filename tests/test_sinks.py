"""Batches that are delivered once, whatever is replayed."""

import json
import os
import shutil

from linewise.sources.sinks import OnceFolder, deliver_once

SCHEMA = "k bigint, t string"


def rows(spark, *keys):
    return spark.createDataFrame([(k, f"t{k}") for k in keys], SCHEMA)


def test_a_batch_is_written_once(spark, tmp_path):
    folder = OnceFolder(spark, str(tmp_path), "out")
    assert folder.read(SCHEMA).count() == 0 and folder.batches() == {}
    assert folder.write(rows(spark, 1, 2), 0) and folder.write(rows(spark, 3), 7)
    assert not folder.write(rows(spark, 1, 2), 0) and not OnceFolder(spark, str(tmp_path), "out").write(rows(spark, 9), 7)
    assert sorted(r.k for r in folder.read(SCHEMA).collect()) == [1, 2, 3]
    assert len(os.listdir(tmp_path / "out" / "data")) == 2
    assert OnceFolder(spark, str(tmp_path), "other").read(SCHEMA).count() == 0


def test_of_two_attempts_at_a_time_one_stays(spark, tmp_path):
    folder = OnceFolder(spark, str(tmp_path), "out")
    for attempt in ("5-a", "5-b"):
        rows(spark, 5).write.parquet(f"{folder.path}/data/{attempt}")
    assert folder._commit(5, "5-a") and not folder._commit(5, "5-b")
    assert [d for d in os.listdir(f"{folder.path}/data")] == ["5-a"] and folder.read(SCHEMA).count() == 1


def test_what_was_never_committed_is_not_read(spark, tmp_path):
    folder = OnceFolder(spark, str(tmp_path), "out")
    rows(spark, 1).write.parquet(f"{folder.path}/data/1-lost")
    assert folder.read(SCHEMA).count() == 0
    assert folder.write(rows(spark, 1), 1, "json") and folder.read(SCHEMA, "json").count() == 1


def test_a_query_whose_commit_was_lost_replays_without_a_second_file(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        deliver_once(stream, str(tmp_path / "sink"), checkpoint, "lines", lambda df: df.selectExpr("k", "upper(t) AS t")).awaitTermination()

    for k in range(3):
        rows(spark, k).coalesce(1).write.mode("append").parquet(source)
    run()
    last = max(int(n) for n in os.listdir(f"{checkpoint}/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):  # the crash came between the sink and this
        shutil.move(f"{checkpoint}/commits/{name}", str(tmp_path / f"lost{name}"))
    run()
    rows(spark, 3).coalesce(1).write.mode("append").parquet(source)
    run()
    folder = OnceFolder(spark, str(tmp_path / "sink"), "lines")
    assert sorted(tuple(r) for r in folder.read(SCHEMA).collect()) == [(k, f"T{k}") for k in range(4)]
    markers = [json.loads((tmp_path / "sink/lines/commits" / n).read_text()) for n in os.listdir(tmp_path / "sink/lines/commits") if n.endswith(".json")]
    assert sorted(m["batch"] for m in markers) == [0, 1, 2, 3] and len(os.listdir(tmp_path / "sink/lines/data")) == 4
