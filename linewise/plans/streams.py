"""The streaming operators over the driver's tables, read as streams to their end.

Each query runs with ``availableNow`` (everything there is, then stop), writes to a new
folder below the shared one, and gives back what was written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import wire
from ..functions.calls import call_json
from ..functions.jsontext import ascii_length
from ..functions.timestamps import epoch_micros
from ..operators import lines, recover, report, trail
from ..session import shared_folder
from ..sources import sinks
from ..sources.follow import follow_line_files
from ..sources.sinks import stream_to
from ..streaming.lines import stream_dedupe, stream_lines, stream_pair
from ..streaming.state import stream_rejoin, stream_reports, stream_trails
from . import views
from .queries import SMALL_TRAIL, _counter_row, big, query
from .views import NOW_SECONDS


def table_stream(spark: SparkSession, d: str, name: str) -> DataFrame:
    path = f"{d}/{name}.parquet"
    return spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1000).parquet(path + "*")


def finished(df: DataFrame) -> DataFrame:
    """The stream's whole output."""
    folder = f"{shared_folder(df.sparkSession)}/stream-{uuid.uuid4().hex}"
    stream_to(df, f"{folder}/out", f"{folder}/position").awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/out")


def _event_lines(spark: SparkSession, d: str) -> DataFrame:
    calls = views.event_calls(table_stream(spark, d, "events"))
    return lines.compose_lines(views.with_ref(calls, views.apps(spark, d)))


@query
def stream_classify(spark, d):
    broken = views.break_lines(_event_lines(spark, d)).select("event_id", "line")
    return finished(stream_lines(broken, F.lit(NOW_SECONDS)).select("event_id", "reason"))


@query
def stream_unique_lines(spark, d):
    """Every line delivered twice."""
    twice = _event_lines(spark, d).select("event_id", "line", F.explode(F.array(F.lit(1), F.lit(2))).alias("delivery"))
    checked = stream_lines(twice.select("event_id", "line"), F.lit(NOW_SECONDS))
    return finished(stream_dedupe(checked).select("event_id", F.md5("line").alias("line_md5")))


@query
def stream_rejoin_parts(spark, d):
    parts = recover.drop_stderr(recover.read_cri(views.document_cri_rows(table_stream(spark, d, "documents"))))
    rows = stream_rejoin(parts.select("file", "stream", "pos", "log", "is_last"))
    out = rows.select("file", big(F.col("pos") / 3).alias("line_start"), big(F.col("parts")).alias("parts"), F.md5("line").alias("line_md5"))
    return finished(out)


class _Arrivals:
    """Rows written to the shared folder part after part, and read back as a stream with a part in each
    trigger, oldest first. A part is as many files as the cluster has cores, so that all of them
    write it and read it."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{shared_folder(spark)}/arrivals-{uuid.uuid4().hex}"
        self.files = max(4, spark.sparkContext.defaultParallelism)

    def add(self, rows: DataFrame, then: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
        """``rows``, dealt out, after ``then``, as they were written, with all that was added before."""
        rows = then(rows.repartition(self.files))
        rows.write.mode("append").parquet(self.folder)
        return self.spark.read.schema(rows.schema).parquet(self.folder)

    def stream(self, schema: StructType) -> DataFrame:
        return self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files).parquet(self.folder)


@query
def stream_pair_exchanges(spark, d):
    """A request and a response from long after the others, of different exchanges, move the
    watermark past every unanswered request."""
    registry = views.customer_apps(spark, d)
    asked = lines.compose_lines(views.with_ref(lines.request_lines(views.order_requests(views.table(spark, d, "orders"))), registry))
    answered = lines.compose_lines(views.with_ref(lines.response_lines(views.order_responses(views.table(spark, d, "orders"))), registry))
    parsed = lines.parse_lines(asked.select("line").unionByName(answered.select("line")))
    timed = parsed.withColumn("ts", F.timestamp_micros((F.col("ts_ns").cast("decimal(38,0)") / 1000).cast("bigint")))
    timed = timed.select("partner_ref", "correlation_id", "message", "ts", "method", "path", "status_code", "duration_ms")
    arrivals = _Arrivals(spark)
    last = arrivals.add(timed).agg((F.max("ts") + F.expr("interval 60 days")).alias("ts"))
    later = last.select(F.explode(F.array(F.lit(wire.REQUEST_MESSAGE), F.lit(wire.RESPONSE_MESSAGE))).alias("message"), "ts")
    later = later.withColumns({"partner_ref": F.lit(""), "correlation_id": F.col("message")})
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in timed.schema.fields if f.name not in later.columns]
    arrivals.add(later.select("*", *blank).select(*timed.columns))
    pairs = stream_pair(arrivals.stream(timed.schema), delay="20 days")
    return finished(pairs.select("partner_ref", "correlation_id", "method", "path", big(F.col("status_code")).alias("status_code"), "duration_ms"))


def _by_time(rows: DataFrame, at: str, then: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> DataFrame:
    """``rows`` as a stream of three triggers in the order of ``at``. They are made once, as columns:
    their ends are read without the rest, and a trigger's share without what lies elsewhere. ``then``,
    row by row, makes the stream's rows of them: what it makes is written once, where it is made."""
    spark = rows.sparkSession
    made = f"{shared_folder(spark)}/made-{uuid.uuid4().hex}"
    rows.write.parquet(made)
    rows, arrivals = spark.read.schema(rows.schema).parquet(made), _Arrivals(spark)
    schema = then(rows).schema
    ends = rows.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
    if ends.a is None:
        arrivals.add(rows, then)
        return arrivals.stream(schema)
    step = (ends.b - ends.a) / 3 if not isinstance(ends.a, int) else (ends.b - ends.a) // 3
    cuts = [F.lit(ends.a + step), F.lit(ends.a + 2 * step)]
    for part in (F.col(at) < cuts[0], (F.col(at) >= cuts[0]) & (F.col(at) < cuts[1]), F.col(at) >= cuts[1]):
        arrivals.add(rows.filter(part), then)
    return arrivals.stream(schema)


def _item_rows(rows: DataFrame) -> DataFrame:
    """What ``stream_trails`` reads: the calls that are taken, and the answers, of which no column of an item is set."""
    calls = trail.normalise_calls(views.item_calls(rows, ("exchange_id", "seq", "kind", "ts")))
    sent = calls.filter((F.col("kind") != "call") | F.col("call").isNotNull()).select("exchange_id", "seq", "kind", call_json(F.col("call")).alias("call_json"), "ts")
    return sent.select("exchange_id", "seq", "kind", "call_json", ascii_length("call_json").alias("call_bytes"), "ts")


@query
def stream_collect_trails(spark, d):
    """Calls a minute apart and, but for open orders, an answer within the hour. An order that is
    silent for a day ends unanswered, by the watermark alone; the last day's still wait.
    Items meet their orders and are dealt out as columns; a call's text is made where it is written."""
    orders = views.table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_orderstatus")
    columns = ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_quantity")
    seq = F.col("l_linenumber") * 10**15 + F.col("l_partkey") * 10**6 + F.col("l_suppkey")
    items = views.table(spark, d, "lineitem").select("l_orderkey", *columns, seq.alias("seq"), F.lit("call").alias("kind"), (F.col("l_linenumber") * 60).alias("after"))
    ends = orders.filter("o_orderstatus <> 'O'").select("l_orderkey", F.lit(10**18).alias("seq"), F.lit("response").alias("kind"), F.lit(3600).alias("after"))
    rows = items.unionByName(ends, allowMissingColumns=True).join(orders, "l_orderkey").select(
        F.col("l_orderkey").cast("string").alias("exchange_id"), "seq", "kind", *columns,
        F.timestamp_micros(epoch_micros("o_orderdate") + F.col("after").cast("bigint") * 1_000_000).alias("ts"),
    )
    trails = stream_trails(_by_time(rows, "ts", _item_rows), **SMALL_TRAIL, wait="1 day", delay="1 hour")
    return finished(trails.select("exchange_id", "answered", big(F.col("n_calls")).alias("n_calls"), big(F.col("upstream_dropped")).alias("upstream_dropped")))


@query
def stream_drop_reports(spark, d):
    """What a logger holds is reported once it has been silent for three hours."""
    calls = views.event_calls(views.table(spark, d, "events")).filter(F.col("level") == "error")
    drops = calls.select(F.col("tenant_id").alias("logger"), F.floor(F.col("us") / 1000).cast("bigint").alias("ms"), F.lit(1).cast("bigint").alias("n"))
    return finished(stream_reports(_by_time(drops, "ms"), 3_600_000, flush_ms=10_800_000, delay="1 hour"))


@query
def stream_followed_lines(spark, d):
    """Broken and whole lines as text files that are followed, a quarter of their bytes a trigger; the
    query is stopped after its first batches and started again."""
    folder = f"{shared_folder(spark)}/followed-{uuid.uuid4().hex}"
    sinks.write_lines(views.break_lines(views.event_lines(spark, d)).select("line").repartition(6), f"{folder}/logs")
    size = spark.read.format("binaryFile").load(f"{folder}/logs").agg(F.sum("length")).first()[0] or 0

    def start():
        followed = follow_line_files(spark, f"{folder}/logs/*.txt", f"{folder}/plan", max_bytes=size // 4 + 1, split_bytes=size // 16 + 1, max_age=0)
        checked = stream_lines(followed.select(F.col("text").alias("line")), F.lit(NOW_SECONDS)).select(F.md5("line").alias("line_md5"), "reason")
        return checked, checked.writeStream.format("parquet").option("checkpointLocation", f"{folder}/position").start(f"{folder}/out")

    checked, running = start()
    while running.isActive and sum(p["numInputRows"] > 0 for p in running.recentProgress) < 2:
        running.awaitTermination(0.2)
    running.stop()
    _, running = start()
    running.processAllAvailable()
    running.stop()
    return spark.read.schema(checked.schema).parquet(f"{folder}/out")


@query
def stream_delivered_lines(spark, d):
    """Every micro-batch is delivered twice, as after a crash between the sink and its commit."""
    folder = f"{shared_folder(spark)}/delivered-{uuid.uuid4().hex}"
    rows = _event_lines(spark, d).select("event_id", F.md5("line").alias("line_md5"))
    once = sinks.OnceFolder(spark, folder, "lines")

    def twice(batch: DataFrame, number: int) -> None:
        for _ in range(2):
            once.write(batch, number)

    rows.writeStream.foreachBatch(twice).option("checkpointLocation", f"{folder}/position").trigger(availableNow=True).start().awaitTermination()
    return once.read(rows.schema)


@query
def stream_live_counters(spark, d):
    """Counted trigger by trigger while the lines are classified."""
    name = f"counters_{uuid.uuid4().hex}"
    calls = views.event_calls(views.table(spark, d, "events"))
    broken = views.break_lines(lines.compose_lines(views.with_ref(calls, views.apps(spark, d))))
    source = _by_time(broken.select("event_id", "line"), "event_id")
    checked = stream_lines(source, F.lit(NOW_SECONDS)).select("event_id", "reason").observe(name, *report.counters("reason"))
    listener = report.LiveCounters(name)
    spark.streams.addListener(listener)
    folder = f"{shared_folder(spark)}/counted-{uuid.uuid4().hex}"
    totals = listener.after(stream_to(checked, f"{folder}/out", f"{folder}/position"))
    spark.streams.removeListener(listener)
    return _counter_row(spark, totals)
