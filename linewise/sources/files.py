"""Log files, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_line_files(spark: SparkSession, path: str, newer_than: str | None = None) -> DataFrame:
    """Every line as it was written: ``file, block_start, pos, text``.

    A file is split into blocks that are read in parallel; ``pos`` rises within a block
    and blocks within a file, so (file, block_start, pos) is the file's order and the
    block is the natural chunk for ``rejoin_parts(chunk=F.col("block_start"))``. A line
    belongs to the block it starts in. ``newer_than`` skips files untouched since then.
    Only ``\\n`` ends a line, so a carriage return stays on it."""
    reader = spark.read.option("lineSep", "\n")
    if newer_than is not None:
        reader = reader.option("modifiedAfter", newer_than)
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("pos"),
        F.col("value").alias("text"),
    )


def stream_line_files(
    spark: SparkSession, path: str, max_file_age: str = "1d", max_files: int = 1000, max_bytes: str | None = None
) -> DataFrame:
    """The same as a stream of closed (rotated) files: ``file, pos, text``.

    The file source reads a file once and does not follow appends. A file is read whole
    by one task, for its lines' positions, so files are rotated at a size a task can
    hold. Intake per trigger is bounded by files or by bytes."""
    reader = spark.readStream.format("text").option("wholetext", "true").option("maxFileAge", max_file_age)
    reader = reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader.option("maxFilesPerTrigger", max_files)
    whole = reader.load(path).select(F.col("_metadata.file_path").alias("file"), "value")
    whole = whole.filter(F.col("value") != "")
    text = F.regexp_replace("value", r"\n\z", "")
    rows = whole.select("file", F.posexplode(F.split(text, "\n")).alias("pos", "text"))
    return rows.withColumn("pos", F.col("pos").cast("bigint"))


def read_apps(spark: SparkSession, path: str) -> DataFrame:
    """The app registry: ``tenant_id, tenant_token, app_key, app_id, state``."""
    return spark.read.parquet(path).select("tenant_id", "tenant_token", "app_key", "app_id", "state")


def read_calls(spark: SparkSession, path: str) -> DataFrame:
    """Log calls kept as a table; columns are read as far as a query names them."""
    return spark.read.parquet(path)
