"""The driver's tables in the shapes the operators read. The oracle SQL builds the same
views (``oracle.py``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import wire
from ..functions.jsontext import entries_of
from ..functions.timestamps import epoch_micros, ms_to_ns
from ..operators.lines import compose_lines
from ..operators.partner import with_references

DAY_US = 86_400_000_000
NOW_SECONDS = 1_704_067_200 + 12 * 86_400
PIECE = 500
STEP = 10_000_000_000  # one step of the scope clock


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def text_of(*parts) -> Column:
    return F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])


def s(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


# --- log calls, from events ----------------------------------------------------------

def event_calls(events: DataFrame) -> DataFrame:
    us = epoch_micros("ts")
    outbound = F.col("event_id") % 6 == 0
    extra = F.when(
        F.col("event_id") % 9 == 0,
        F.replace("props", F.lit("}"), F.lit(f', "level": "mine", "{wire.ENVELOPE_PREFIX}x": 1}}')),
    ).otherwise(F.col("props"))
    service = text_of("svc-", s(F.col("event_id") % 5))
    return events.select(
        "event_id",
        "user_id",
        text_of("t", s(F.col("user_id") % 3)).alias("tenant_id"),
        text_of("app-", s("user_id")).alias("app_key"),
        F.when(F.col("event_type") == "error", "error")
        .when(F.col("event_type") == "purchase", "warn")
        .when(F.col("event_type") == "signup", "debug")
        .otherwise("info")
        .alias("level"),
        F.col("event_type").alias("message"),
        F.when(F.col("user_id") % 7 != 0, text_of("partner-", s("user_id"))).alias("partner_id"),
        F.when(outbound, "outbound").alias("direction"),
        F.when(outbound, service).alias("upstream_integration"),
        F.when(outbound, text_of("https://", service, ".test")).alias("upstream_base_url"),
        us.alias("us"),
        ms_to_ns(text_of(s(F.floor(us / 1000)), ".", F.lpad(s(us % 1000), 3, "0"))).alias("ts_ns"),
        extra.alias("j"),
        entries_of(extra).alias("data"),
        "value",
    )


def calls(spark: SparkSession, d: str) -> DataFrame:
    return event_calls(table(spark, d, "events"))


def _apps(users: DataFrame, key: str, prefix: str) -> DataFrame:
    return users.select(
        text_of("t", s(F.col(key) % 3)).alias("tenant_id"),
        text_of("tenant_live_", s(F.col(key) % 3)).alias("tenant_token"),
        text_of(prefix, s(key)).alias("app_key"),
        text_of("id-", s(key)).alias("app_id"),
        F.when(F.col(key) % 5 != 0, "approved").otherwise("pending").alias("state"),
    )


def apps(spark: SparkSession, d: str) -> DataFrame:
    return _apps(table(spark, d, "events").select("user_id").distinct(), "user_id", "app-")


def customer_apps(spark: SparkSession, d: str) -> DataFrame:
    return _apps(table(spark, d, "orders").select("o_custkey").distinct(), "o_custkey", "cust-")


def with_ref(rows: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows with their app's reference, computed once per app."""
    return rows.join(with_references(registry).select("app_key", "partner_ref"), "app_key")


def event_lines(spark: SparkSession, d: str) -> DataFrame:
    return compose_lines(with_ref(calls(spark, d), apps(spark, d)))


def break_lines(lines: DataFrame) -> DataFrame:
    """Most lines damaged in one of the ways a pipeline damages them."""
    line, kind = F.col("line"), F.col("event_id") % 13
    swap = lambda old, new: F.replace(line, old, F.lit(new))
    quoted = lambda key, value: text_of(f'"{key}":"', value, '"')
    broken = (
        F.when(kind == 0, F.left(line, F.length(line) - 3))
        .when(kind == 1, F.concat(line, line))
        .when(kind == 2, F.concat(line, F.lit("\r")))
        .when(kind == 3, text_of("[", line, "]"))
        .when(kind == 4, text_of(" ", line))
        .when(kind == 5, text_of("plain log ", F.col("message")))
        .when(kind == 6, swap(F.lit('"1.6.0"'), '"2.0.0"'))
        .when(kind == 7, swap(quoted(wire.PARTNER_REF_KEY, F.col("partner_ref")), f'"{wire.PARTNER_REF_KEY}":""'))
        .when(kind == 8, swap(quoted(wire.LEVEL_KEY, F.col("level")), f'"{wire.LEVEL_KEY}":7'))
        .when(kind == 9, swap(quoted(wire.TIMESTAMP_KEY, F.col("ts_ns")), f'"{wire.TIMESTAMP_KEY}":"soon"'))
        .when(kind == 10, swap(F.lit('"outbound"'), '"sideways"'))
        .when(kind == 11, swap(quoted(wire.UPSTREAM_BASE_URL_KEY, F.col("upstream_base_url")), f'"{wire.UPSTREAM_BASE_URL_KEY}":""'))
    )
    return lines.withColumn("line", F.coalesce(broken, line))


# --- container text, from documents ---------------------------------------------------

def _pieces(documents: DataFrame) -> DataFrame:
    """Cut into pieces; an empty text is one empty piece."""
    text = F.replace(F.coalesce("text", F.lit("")), F.lit("\n"), F.lit(" "))
    docs = documents.select(s("doc_id").alias("file"), "doc_id", text.alias("t"))
    found = F.when(F.col("t") == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all("t", F.lit(f"(?s).{{1,{PIECE}}}"), 0))
    cut = docs.select("file", "doc_id", found.alias("found"))  # a column, or it would be cut for each use
    return cut.select("file", "doc_id", F.size("found").alias("n"), F.posexplode("found").alias("k", "piece"))


def cri_rows(spark: SparkSession, d: str) -> DataFrame:
    return document_cri_rows(table(spark, d, "documents"))


def document_cri_rows(documents: DataFrame) -> DataFrame:
    """Each text as the parts a runtime would write, with stderr and broken rows mixed in."""
    last = F.col("k") == F.col("n") - 1
    tag = F.when(last, "F").otherwise("P")
    own = F.struct(
        (F.col("k") * 3).cast("bigint").alias("pos"), text_of("2024-01-01T00:00:00Z stdout ", tag, " ", F.col("piece")).alias("text")
    )
    noise = F.struct((F.col("k") * 3 + 1).cast("bigint").alias("pos"), F.lit("2024-01-01T00:00:01Z stderr P noise").alias("text"))
    broken = F.struct((F.col("k") * 3 + 2).cast("bigint").alias("pos"), F.lit("stdout F broken").alias("text"))
    rows = F.when(F.col("doc_id") % 3 == 0, F.array(own, noise, broken)).otherwise(F.array(own))
    return _pieces(documents).select("file", F.explode(rows).alias("r")).select("file", "r.pos", "r.text")


def docker_rows(spark: SparkSession, d: str) -> DataFrame:
    last = F.col("k") == F.col("n") - 1
    log = F.concat(F.col("piece"), F.when(last, "\n").otherwise(""))
    wrapped = F.to_json(F.struct(log.alias("log"), F.lit("stdout").alias("stream"), F.lit("2024-01-01T00:00:00Z").alias("time")))
    text = F.when((F.col("doc_id") % 4 == 0) & last, F.array(F.lit("{broken"), wrapped)).otherwise(F.array(wrapped))
    rows = _pieces(table(spark, d, "documents")).select("file", "k", F.posexplode(text).alias("i", "text"))
    return rows.select("file", (F.col("k") * 2 + F.col("i")).cast("bigint").alias("pos"), "text")


# --- exchanges, from orders -------------------------------------------------------------

def requests(spark: SparkSession, d: str) -> DataFrame:
    return order_requests(table(spark, d, "orders"))


def order_requests(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    body = (
        F.when(key % 4 == 1, F.lit('"text"'))
        .when(key % 4 > 1, text_of('{"total":', s(F.floor("o_totalprice").cast("bigint")), ',"priority":"', F.col("o_orderpriority"), '"}'))
    )
    return orders.select(
        "o_orderkey",
        "o_orderstatus",
        text_of("t", s(F.col("o_custkey") % 3)).alias("tenant_id"),
        text_of("cust-", s("o_custkey")).alias("app_key"),
        ms_to_ns(text_of(s(F.floor(epoch_micros("o_orderdate") / 1000)))).alias("ts_ns"),
        F.when(key % 3 == 0, "GET").when(key % 3 == 1, "POST").otherwise("PUT").alias("method"),
        text_of("/v1/orders/", s(key)).alias("path"),
        F.create_map(
            F.lit("Authorization"), text_of("Basic ", s(key)), F.lit("X-Key"), text_of("cust-", s("o_custkey")), F.lit("accept"), F.lit("json")
        ).alias("headers"),
        s(key).alias("correlation_id"),
        body.alias("body"),
    )


def responses(spark: SparkSession, d: str) -> DataFrame:
    return order_responses(table(spark, d, "orders"))


def order_responses(orders: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    answered = orders.filter(F.col("o_orderstatus") != "O")
    body = F.when(key % 5 == 0, F.lit("null")).when(key % 5 > 1, text_of('{"state":"', F.col("o_orderstatus"), '"}'))
    return answered.select(
        "o_orderkey",
        text_of("cust-", s("o_custkey")).alias("app_key"),
        ms_to_ns(text_of(s(F.floor(epoch_micros("o_orderdate") / 1000) + 5))).alias("ts_ns"),
        F.when(F.col("o_orderstatus") == "F", 200).otherwise(202).alias("status_code"),
        F.floor(F.col("o_totalprice") % 1000).cast("bigint").alias("duration"),
        F.when(key % 2 == 0, F.create_map(F.lit("Set-Cookie"), F.lit("a=b"))).alias("headers"),
        s(key).alias("correlation_id"),
        body.alias("body"),
    )


# --- upstream calls, from lineitem --------------------------------------------------------

CALL_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def upstream_calls(spark: SparkSession, d: str) -> DataFrame:
    return item_calls(table(spark, d, "lineitem"))


def item_calls(items: DataFrame, kept: tuple[str, ...] = ("l_orderkey", *CALL_ORDER)) -> DataFrame:
    status = F.when(F.col("l_returnflag") == "A", 200.0).when(F.col("l_returnflag") == "R", 500.0)
    failed = status.isNull()
    return items.select(
        *kept,
        text_of(" supplier-", s("l_suppkey"), " ").alias("name"),
        F.when(F.col("l_linenumber") == 7, "").when(F.col("l_linenumber") % 2 == 0, "POST").otherwise("GET").alias("method"),
        text_of("https://user:pw@api.test/parts/", s("l_partkey"), "?q=", s("l_suppkey")).alias("url"),
        status.alias("status"),
        F.col("l_quantity").alias("duration_ms"),
        F.when(F.col("l_suppkey") % 3 == 0, text_of("req-", s("l_suppkey"))).alias("request_id"),
        F.when(failed, "ETIMEDOUT").alias("error_code"),
        F.when(failed, text_of("timed out é", s("l_partkey"))).alias("call_message"),
        F.when(F.col("l_suppkey") % 2 == 0, F.col("l_linenumber").cast("double")).alias("attempt"),
    )


# --- scopes, from conversations -------------------------------------------------------------

def _turns(spark: SparkSession, d: str) -> DataFrame:
    depth = F.col("conv_id") % 5
    return table(spark, d, "conversations").select(
        "conv_id",
        "turn",
        "role",
        text_of("c", s("conv_id")).alias("scope_id"),
        ((F.col("turn") + depth) * STEP + F.col("conv_id") * 10).alias("seq"),
    )


def scopes(spark: SparkSession, d: str) -> DataFrame:
    """One scope per conversation, in chains of five; every other one ends."""
    depth = F.col("conv_id") % 5
    rows = _turns(spark, d).groupBy("conv_id").agg(F.max("seq").alias("last_seq"))
    found = rows.select(
        text_of("c", s("conv_id")).alias("scope_id"),
        F.when(depth == 0, "root").otherwise(text_of("c", s(F.col("conv_id") - 1))).alias("parent_id"),
        ((depth - 1) * STEP + F.col("conv_id") * 10 - 5).alias("open_seq"),
        F.when(F.col("conv_id") % 2 == 0, F.col("last_seq") + 7).alias("end_seq"),
    )
    root = spark.range(1).select(
        F.lit("root").alias("scope_id"), F.lit(None).cast("string").alias("parent_id"), F.lit(-STEP - 10).alias("open_seq"), F.lit(None).cast("bigint").alias("end_seq")
    )
    return found.unionByName(root)


def scope_events(spark: SparkSession, d: str) -> DataFrame:
    kind = F.when(F.col("role") == "user", "request").when(F.col("role") == "assistant", "response")
    return _turns(spark, d).select("scope_id", "seq", kind.alias("kind")).filter("kind is not null")


def scope_calls(spark: SparkSession, d: str) -> DataFrame:
    return _turns(spark, d).select("scope_id", (F.col("seq") + 1).alias("seq"), text_of("call-", s("conv_id"), "-", s("turn")).alias("name"))


def scope_sets(spark: SparkSession, d: str) -> DataFrame:
    fields = F.create_map(F.lit("partner_id"), text_of(F.col("role"), "-", s("turn")))
    odd = F.map_concat(fields, F.create_map(F.lit("path"), text_of("/", s("conv_id"))))
    return _turns(spark, d).select("scope_id", "seq", F.when(F.col("turn") % 2 == 1, odd).otherwise(fields).alias("set_context"))
