"""Lines, export records and push batches as files.

Nothing written here holds an app key or a tenant token: rows are named by the partner
reference (``operators.leaks.leak_scan`` checks it).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def write_lines(df: DataFrame, path: str, mode: str = "append") -> None:
    """One line of text per row. JSON text holds no raw newline."""
    df.select("line").write.mode(mode).text(path)


def write_export_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """One export body per row, gzip."""
    records.select("record").write.mode(mode).option("compression", "gzip").text(path)


def write_push_batches(batches: DataFrame, path: str, mode: str = "append") -> None:
    """Delivery bodies beside the reference they are for. Rows of one partner lie
    together by range, which bounds the number of files however many partners there
    are; one folder per partner would not."""
    batches.select("partner_ref", "batch_no", "lines", "body").repartitionByRange("partner_ref", "batch_no").write.mode(
        mode
    ).parquet(path)


def write_series(points: DataFrame, path: str, mode: str = "append") -> None:
    """Metric points in long form, a folder per day."""
    points.withColumn("day", F.to_date("ts")).write.mode(mode).partitionBy("day").parquet(path)


def stream_to(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", **trigger) -> StreamingQuery:
    """Starts an append-only stream into files; the checkpoint keeps the read position,
    so a restarted query goes on where it stopped."""
    writer = df.writeStream.format(fmt).outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start(path)


class OnceFolder:
    """A folder to which each numbered batch is written at most once, in any store Spark writes to.

    An attempt writes its files to a folder of its own; then a marker named by the batch
    takes its place by a rename that fails where there is one already. What no marker names was
    never delivered, so readers see whole batches only, and a replayed one leaves no second file."""

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/{name}"

    def _at(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))

    def _files(self):
        return self._at().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def holds(self, batch: int) -> bool:
        return self._files().exists(self._at("commits", f"{batch}.json"))

    def write(self, df: DataFrame, batch: int, fmt: str = "parquet", **options) -> bool:
        """Whether this attempt's files are now the batch's."""
        if self.holds(batch):
            return False
        attempt = f"{batch}-{uuid.uuid4().hex}"
        df.write.format(fmt).options(**options).save(f"{self.path}/data/{attempt}")
        return self._commit(batch, attempt)

    def _commit(self, batch: int, attempt: str) -> bool:
        jvm, files, draft = self.spark._jvm, self._files(), self._at("drafts", f"{attempt}.json")
        out = files.create(draft, False)
        out.write(bytearray(json.dumps({"batch": batch, "data": attempt}).encode()))
        out.close()
        files.mkdirs(self._at("commits"))
        place = jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self.spark._jsc.hadoopConfiguration())
        never = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            place.rename(files.makeQualified(draft), files.makeQualified(self._at("commits", f"{batch}.json")), never)
        except Py4JJavaError as error:
            if not self.holds(batch):
                raise
            if "FileAlreadyExists" not in str(error.java_exception):
                raise
            files.delete(draft, False)
            files.delete(self._at("data", attempt), True)
            return False
        return True

    def batches(self) -> dict[int, str]:
        """The delivered batches and their folders: a short row for each batch."""
        if not self._files().exists(self._at("commits")):
            return {}
        rows = self.spark.read.schema("batch bigint, data string").json(f"{self.path}/commits").collect()
        return {r.batch: f"{self.path}/data/{r.data}" for r in rows}

    def read(self, schema: StructType | str, fmt: str = "parquet") -> DataFrame:
        folders = sorted(self.batches().values())
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).format(fmt).load(folders)


def deliver_once(
    df: DataFrame, path: str, checkpoint: str, name: str, prepare: Callable[[DataFrame], DataFrame] = lambda rows: rows, fmt: str = "parquet", options: dict | None = None, **trigger
) -> StreamingQuery:
    """Starts a stream whose micro-batches, after ``prepare``, are each written once to the
    ``OnceFolder`` of ``path`` and ``name``: Spark replays a batch that it had not yet marked as
    done, and the folder refuses what it already has. ``name`` and ``checkpoint`` belong together: a
    query that starts anew from an empty checkpoint needs a new name."""

    def batch(rows: DataFrame, number: int) -> None:
        OnceFolder(rows.sparkSession, path, name).write(prepare(rows), number, fmt, **(options or {}))

    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(batch)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
