"""Operators against hand-worked cases and plain-Python brute force."""

import json
import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linewise.functions.jsontext import entries_of
from linewise.operators import batches, exchange, leaks, metrics, recover, report, trail
from linewise.operators.greedy import greedy_runs
from linewise.operators.lines import compose_lines, parse_lines, request_lines, response_lines, validate_calls
from linewise.wire import ENVELOPE_PREFIX
from linewise.operators.leaks import leak_scan
from linewise.operators.partner import matched_lines, resolve_partner, secret_forms, unmatched_lines


def plain_runs(rows, span, weight):
    out, start, load, no = [], None, 0, -1
    for pos, w in rows:
        if start is None or pos >= start + span or load + w > weight:
            start, load, no = pos, 0, no + 1
        load += w
        out.append((pos, no, start))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_greedy_runs_equal_the_plain_loop(spark, seed):
    rng = random.Random(seed)
    rows, want = [], set()
    for g in range(6):
        step = rng.choice([1, 1, 3, 40])
        pos, data = 0, []
        for _ in range(rng.randint(1, 400)):
            data.append((pos, rng.choice([1, 5, 20, 120])))
            pos += rng.randint(1, step)
        rows += [(g, *d) for d in data]
        want |= {(g, *r) for r in plain_runs(data, 10, 100)}
    df = spark.createDataFrame(rows, "g int, p bigint, w bigint").repartition(3)
    got = greedy_runs(df, ["g"], "p", "w", 10, 100, rng.choice([10, 16, 64, 1000]))
    assert {tuple(r) for r in got.select("g", "p", "run_no", "run_start").collect()} == want



def test_greedy_chunks_stay_whole_in_many_tasks(spark):
    """Adaptive execution deals out anew what it takes for a join's exchange; a chunk must stay one task's."""
    rows = spark.range(60_000).select((F.col("id") % 12).alias("g"), F.floor(F.col("id") / 12).alias("p"), (7 + F.col("id") * 7919 % 13).alias("w"))
    size = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(size)
    spark.conf.set(size, "-1")
    try:
        runs = greedy_runs(rows.repartition(6), ["g"], "p", "w", 10, 100, 64)
        plan = runs._jdf.queryExecution().executedPlan().toString()
        got = {(r.g, r.p): r.run_no for r in runs.collect()}
    finally:
        spark.conf.set(size, before)
    cut = plan[plan.index("MapInPandas cut(") :]
    assert "Join" not in cut[: cut.index("Exchange hashpartitioning")]
    want = {}
    for g in range(12):
        run, size, n = 0, 0, 0
        for p in range(5000):
            w = 7 + (p * 12 + g) * 7919 % 13
            if n == 10 or size + w > 100:
                run, size, n = run + 1, 0, 0
            size, n = size + w, n + 1
            want[g, p] = run
    assert got == want


def test_pack_batches(spark):
    df = spark.range(1500).select(F.lit("a").alias("k"), F.lit(None).cast("string").alias("n"), F.col("id").alias("seq"), F.lit("x").alias("line"))
    big = spark.createDataFrame([("b", None, i, "y" * 400) for i in range(3)] + [("c", "n", 0, "z" * 2000), ("c", "n", 1, "z")],
                                "k string, n string, seq bigint, line string")
    packed = batches.pack_batches(df.unionByName(big), ["k", "n"], "seq", F.octet_length("line"), (1000, 1000), 1000, F.floor(F.col("seq") / 64))
    got = {(r.k, r.batch_no): r["count"] for r in packed.groupBy("k", "batch_no").count().collect()}
    assert got == {("a", 0): 1000, ("a", 1): 500, ("b", 0): 2, ("b", 1): 1, ("c", 0): 1, ("c", 1): 1}
    record = batches.export_records(packed.filter("k = 'b'"), ["k"], "seq").orderBy("batch_no").first()
    body = json.loads(record.record)
    assert [r["body"]["stringValue"] for r in body["resourceLogs"][0]["scopeLogs"][0]["logRecords"]] == ["y" * 400] * 2


def test_rate_limited_reports(spark):
    times = [0, 10, 59_999, 60_000, 60_001, 125_000, 500_000]
    df = spark.createDataFrame([("l", t, 1) for t in times] + [("m", 5, 2), ("m", 5, 1)], "logger string, ms bigint, n int")
    got = report.rate_limited_reports(df, ["logger"], "ms", F.col("n"), chunk_ms=60_000)
    rows = sorted([tuple(r) for r in got.collect()], key=lambda r: (r[0], r[3]))
    assert rows == [("l", 0, 1, 1), ("l", 60_000, 3, 4), ("l", 125_000, 2, 6), ("l", 500_000, 1, 7), ("m", 5, 3, 3)]
    held = spark.createDataFrame([("l", 0, 1), ("l", 5, 1), ("l", 6, 1)], "logger string, ms bigint, n int")
    rows = report.rate_limited_reports(held, ["logger"], "ms", F.col("n")).orderBy("total").collect()
    assert [tuple(r) for r in rows] == [("l", 0, 1, 1), ("l", None, 2, 3)]


def plain_rejoin(parts, cap=64):
    out, run = [], []
    for text, last in parts:
        run.append(text)
        if last or len(run) == cap:
            out.append("".join(run))
            run = []
    return out + (["".join(run)] if run else [])


def test_rejoin_parts(spark):
    rng = random.Random(1)
    rows, want = [], []
    for f in range(3):
        parts = [(rng.choice(["a", "bb ", " c"]), rng.random() < (0.3, 0.02, 1.0)[f]) for _ in range(300)]
        rows += [(f"f{f}", "stdout", i, t, e) for i, (t, e) in enumerate(parts)]
        want += [(f"f{f}", line) for line in plain_rejoin(parts)]
    df = spark.createDataFrame(rows, "file string, stream string, pos bigint, log string, is_last boolean")
    got = recover.rejoin_parts(df, chunk=F.floor(F.col("pos") / 17))
    assert [(r.file, r.line) for r in got.orderBy("file", "line_start").collect()] == want


def test_container_wrappers(spark):
    cri = spark.createDataFrame([("2024 stdout F a  ",), ("2024 stderr P b",), ("2024 stdout X c",), ("nonsense",)], "text string")
    assert [tuple(r) for r in recover.drop_stderr(recover.read_cri(cri)).select("log", "tag", "is_last").collect()] == [("a  ", "F", True)]
    docker = spark.createDataFrame([('{"log":"x\\n","stream":"stdout","time":"t"}',), ('{"log":"y","stream":"stdout"}',), ("{bad",), ('{"stream":"stdout"}',)], "text string")
    assert [tuple(r) for r in recover.read_docker_json(docker).select("log", "is_last").collect()] == [("x\n", True), ("y", False)]


def call(name, message=None):
    return (name, "POST", "https://api/x", 200.0, 5.0, None, None, message, None)


def trails(spark, calls, **caps):
    df = spark.createDataFrame([("e", i, *c) for i, c in enumerate(calls)],
                               "e string, seq int, name string, method string, url string, status double, duration_ms double,"
                               " request_id string, error_code string, call_message string, attempt double")
    return trail.assemble_trails(trail.normalise_calls(df).filter("call is not null"), ["e"], **caps).first()


def test_trail_caps(spark):
    row = trails(spark, [call(f"c{i}") for i in range(23)])
    assert [c["name"] for c in row.calls] == [f"c{i}" for i in range(3, 23)] and (row.upstream_dropped, row.truncated) == (3, True)
    row = trails(spark, [call(f"c{i}") for i in range(20)])
    assert (row.upstream_dropped, row.truncated, row.n_calls) == (0, False, 20)
    row = trails(spark, [call(f"c{i}", "m" * 1000) for i in range(25)])
    assert [c["name"] for c in row.calls] == [f"c{i}" for i in range(18, 25)] and row.upstream_dropped == 18
    one = len(json.dumps([json.loads(trails(spark, [call("n")]).trail_json)[0]], separators=(",", ":")))
    pad = lambda size: [call("n", "m" * k) for k in (1000,) * 7] + [call("n", "é" * ((size - used) // 6) + "m" * ((size - used) % 6))]
    used = 1 + 7 * (one - 2 + len(',"message":""') + 1000 + 1) + (one - 2) + len(',"message":""') + 1
    exact = trails(spark, pad(8192))
    assert exact.upstream_dropped == 0 and len(json.dumps(json.loads(exact.trail_json), separators=(",", ":"))) == 8192
    assert trails(spark, pad(8193)).upstream_dropped == 1


def test_exchanges_from_lines(spark):
    ref = "v1:" + "0" * 64
    rows = spark.createDataFrame(
        [("k", ref, "1", "GET", "/a", {"cookie": "x", "z": "k"}, "c1", '{"n":1}')],
        "app_key string, partner_ref string, ts_ns string, method string, path string, headers map<string,string>, correlation_id string, body string")
    answers = spark.createDataFrame(
        [("k", ref, "2", 201, 3150.0, None, "c1", None), ("k", ref, "3", 422, 8.0, None, "c2", "null")],
        "app_key string, partner_ref string, ts_ns string, status_code int, duration double, headers map<string,string>, correlation_id string, body string")
    request = compose_lines(request_lines(rows)).select("line")
    response = compose_lines(response_lines(answers)).select("line")
    first = request.first()[0]
    assert '"headers":{"cookie":"[REDACTED]","z":"[REDACTED]"}' in first and first.endswith('"body":{"n":1}}')
    texts = [r[0] for r in response.collect()]
    assert '"body"' not in texts[0] and '"headers"' not in texts[0] and texts[1].endswith('"body":null}')
    pushed = compose_lines(response_lines(answers, push=True)).first().line
    assert '"headers":null,"body":null' in pushed
    parsed = parse_lines(request.unionByName(response))
    pairs = exchange.pair_exchanges(parsed, ["ts_ns"])
    assert {(r.correlation_id, r.method, r.status_code, r.duration_ms, r.state) for r in pairs.collect()} == {
        ("c1", "GET", 201, 3150.0, "complete"), ("c2", None, 422, 8.0, "orphan")}


def test_reserved_and_overridden_fields(spark):
    df = spark.createDataFrame([("r", "1", "info", "m", "p", f'{{"level":"mine","{ENVELOPE_PREFIX}level":"no","2026":"season"}}')],
                               "partner_ref string, ts_ns string, level string, message string, partner_id string, j string")
    line = compose_lines(df.withColumn("data", entries_of("j"))).first().line
    assert line.endswith(ENVELOPE_PREFIX + 'level":"info","level":"mine","message":"m","partnerId":"p","2026":"season"}')


def test_partner_resolution(spark):
    apps = spark.createDataFrame([("t", "tenant_live_test123", "test-api-key", "a1", "approved"), ("t", "tenant_live_test123", "second-partner-key", "a2", "pending")],
                                 "tenant_id string, tenant_token string, app_key string, app_id string, state string")
    ref = "v1:716768d2853ca9bc0568918e2d3b99e80f0929fb4ccd6c0ca6a2d7558077c676"
    other = "v1:616f2ec28c141eb71b291c31d63fa28c8852bf9f0a4b07888b80985cca280765"
    old = "v1:1682cb9ec15cf22b2b216dd76b4ecc3cb90c80dbc72dc0b459ffe1a18975ed32"
    lines = spark.createDataFrame([("t", ref, 5), ("t", ref.upper(), 5), ("t", other, 5), ("u", ref, 5), ("t", old, 5), ("t", old, 50)],
                                  "tenant_id string, partner_ref string, seen_s bigint")
    assert [r.app_id for r in resolve_partner(lines, apps).collect() if r.app_id] == ["a1"]
    assert matched_lines(lines, apps).count() == 1 and unmatched_lines(lines, apps).count() == 5
    previous = spark.createDataFrame([("t", "tenant_live_test456", 10)], "tenant_id string, tenant_token string, valid_to_s bigint")
    graced = resolve_partner(lines, apps, previous).filter("app_id is not null").collect()
    assert {(r.partner_ref, r.seen_s) for r in graced} == {(ref, 5), (old, 5)}


def test_leak_scan_equals_contains(spark):
    apps = spark.createDataFrame([("t", "tok-en-long-é", "k1"), ("t", "tok-en-long-é", "longer-app-key"), ("u", "zz", "k1")],
                                 "tenant_id string, tenant_token string, app_key string")
    secrets = secret_forms(apps)
    forms = [tuple(r) for r in secrets.collect()]
    rng = random.Random(3)
    lines = []
    for i in range(200):
        tenant = rng.choice("tu")
        text = "".join(rng.choice("abk1 zé\n") for _ in range(rng.randint(0, 30)))
        if rng.random() < 0.6:
            at = rng.randint(0, len(text))
            secret = rng.choice(forms)[2]
            text = text[:at] + secret[: rng.choice([len(secret), len(secret) - 1])] + text[at:]
        lines.append((i, tenant, text))
    got = {tuple(r) for r in leak_scan(spark.createDataFrame(lines, "line_id int, tenant_id string, line string"), secrets).collect()}
    assert got == {(i, t, f) for i, t, x in lines for ft, f, s in forms if ft == t and s in x}


def test_few_chance_finds_among_many_secrets():
    rng, size = random.Random(5), 1 << 20
    known = [rng.randbytes(8) for _ in range(20_000)]
    held = pa.RecordBatch.from_arrays([pa.array(known, pa.binary()), pa.array([1] * len(known), pa.int64())], ["anchor", "tenant"])
    words = np.zeros(size // 64, np.uint64)
    for found in leaks._words(size)([held]):
        words[found.column("word").to_numpy()] |= found.column("bits").to_numpy().view(np.uint64)
    text = rng.randbytes(50_000) + known[7]
    line = pa.RecordBatch.from_arrays([pa.array([1]), pa.array(["t"]), pa.array([1], pa.int64()), pa.array([text], pa.binary())], ["line", "tenant_id", "tenant", "text"])
    near = [a for b in leaks._candidates(SimpleNamespace(value=words), [8], 0, 8)([line]) for a in b.column("anchor").to_pylist()]
    assert known[7] in near and len(near) < 10


def test_classify_reasons_in_order(spark):
    def line(**over):
        env = {"line": "1.6.0", "partner_ref": "r", "timestamp": str(1000 * 10**9), "level": "info", **over}
        return json.dumps({ENVELOPE_PREFIX + k: v for k, v in env.items() if v is not ...}, separators=(",", ":"))
    cases = {
        line(): None, "hello": "no_marker", "x" + line(): "unparseable_line", line()[:-1]: "unparseable_line",
        line(line="2.0"): "unsupported_marker", line(line=1.6): "unsupported_marker",
        line(partner_ref=""): "missing_partner_ref", line(partner_ref=...): "missing_partner_ref",
        line(level=5): "bad_level", line(timestamp="soon"): "bad_timestamp",
        line(timestamp=str(10 * 10**9)): "timestamp_out_of_range", line(timestamp=str(9000 * 10**9)): "timestamp_out_of_range",
        line(direction="up"): "bad_direction", line(direction="outbound"): None,
        line(upstream_integration=""): "bad_upstream_attribution", line(upstream_base_url="é" * 513): "bad_upstream_attribution",
    }
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, line string")
    got = recover.classify_lines(df, F.lit(1000), max_age=600)
    assert [r.reason for r in got.orderBy("i").collect()] == list(cases.values())
    summary = report.rejection_summary(got.withColumn("reason", F.when(F.col("i") == 0, "unmatched").otherwise(F.col("reason"))), []).first()
    assert summary.rejected == 15 and summary.message.startswith("15 log records rejected: 1 unmatched (partner reference resolves to no approved app); 14 invalid: no_marker")


def test_long_bodies_and_duplicates(spark):
    df = spark.createDataFrame([("a", '{"x":1,"body":"' + "b" * 100 + '"}'), ("a", '{"x":2}'), ("a", '{"x":2}')], "partner_ref string, line string")
    got = sorted(r.line for r in recover.dedupe_lines(recover.strip_long_bodies(df, 50)).collect())
    assert got == ['{"x":1,"_bodyDropped":true}', '{"x":2}']


def test_other_fields_of_long_lines_stay_as_written(spark):
    body = "b" * 100
    cases = {
        '{"z":1.50,"a":2, "n" : {"b":1,"a":[1e400, "}"]} ,"body":"%s"}': '{"z":1.50,"a":2,"n" : {"b":1,"a":[1e400, "}"]},"_bodyDropped":true}',
        ' { "body" : {"x":"%s"} , "é\\"":null } ': '{"é\\"":null,"_bodyDropped":true}',
        '{"body":"%s","body":1}': '{"_bodyDropped":true}', '[1,"%s"]': None, '{"a":1,"b%s': None, '{"a":"%s"}': '{"a":"%s","_bodyDropped":true}',
    }
    rows = [(i, text % body) for i, text in enumerate(cases)]
    got = recover.strip_long_bodies(spark.createDataFrame(rows, "i int, line string"), 50).orderBy("i").collect()
    assert [r.line for r in got] == [(want.replace("%s", body) if want else text) for (_, text), want in zip(rows, cases.values())]


def test_call_validation(spark):
    df = spark.createDataFrame([("k", "1", "request", "GET", "/", None), ("0", "1", "info", None, None, None), (None, "1", "info", None, None, None),
                                ("k", None, "info", None, None, None), ("k", "1", "request", None, "/", None), ("k", "1", "info", None, None, "{bad")],
                               "app_key string, ts_ns string, kind string, method string, path string, data_json string")
    got = [r.drop_reason for r in validate_calls(df).collect()]
    assert got[0] is None and got[1] == got[2] == "API key is required for logging" and got[3] == "timestamp is not epoch milliseconds"
    assert got[4] == "Failed to send log: request could not be described: method" and got[5] == "log entry could not be serialised"


def test_metrics(spark):
    def batch(slug="bookings", points=1, series=None, key="k"):
        return (key, json.dumps({"slug": slug, "points": [{"timestamp": "2024-01-01T00:00:00Z", "value": 1, "period": "day", **({"series": series} if series is not None else {})}] * points}))
    cases = [(batch(), None), (batch(key=""), "API key"), (batch(key="0"), "API key"), (batch(slug=""), "non-empty string"), (batch(slug="0"), "non-empty string"),
             (batch(slug="a b"), "lowercase letters"), (batch(slug=" Up-1 "), None), (batch(points=0), "non-empty array"), (batch(points=1001), "Maximum 1000"),
             (batch(points=1000), None), (batch(series=" "), "series must be a non"), (batch(series="0"), "series must be a non"), (batch(series="é" * 26), "at most 50"), (batch(series="é" * 25), None)]
    df = spark.createDataFrame([(i, *c[0]) for i, c in enumerate(cases)], "i int, app_key string, body string")
    checked = metrics.validate_metrics(metrics.read_metric_points(df))
    for row, (_, want) in zip(checked.orderBy("i").collect(), cases):
        assert (row.reason is None) if want is None else want in row.reason
    assert metrics.explode_points(checked).count() == 1 + 1 + 1000 + 1
    single = spark.createDataFrame([("k", '{"slug":"s","timestamp":"2024-01-01","value":2,"period":"day"}')], "app_key string, body string")
    assert [tuple(r)[:5] for r in metrics.explode_points(metrics.read_metric_points(single)).collect()] == [("k", "s", 0, "2024-01-01", 2.0)]


def _optimised(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_calls_are_trimmed_once(spark):
    """A filter on the call goes below the step that made it; it must not trim every text again."""
    from linewise.functions.calls import TRIM_SPACE

    texts = ["GET", " GET ", " GET　", "\tGET", "GET\x1c", "\x85GET", "   ", "", None, "G-T_", "é", "　" + "A" * 16 + " ", "A" * 17, "₡"]
    rows = [(k, t, t, t, 200.0, 1.0, t, t, "m", None) for k, t in enumerate(texts)]
    schema = "k int, name string, method string, url string, status double, duration_ms double, request_id string, error_code string, call_message string, attempt double"
    df = spark.createDataFrame(rows, schema)
    calls = trail.normalise_calls(df)
    assert calls.columns == [*df.columns, "reject_reason", "call"]
    for row in calls.collect():
        text = (texts[row.k] or "").strip(TRIM_SPACE)
        good = text.isascii() and text.replace("-", "a").replace("_", "a").isalpha() and len(text) <= 16
        assert (row.reject_reason is None) == good, (texts[row.k], row.reject_reason)
        if not text:
            assert row.reject_reason == "`name` must be a non-empty string"
        if good:
            assert (row.call.name, row.call.method, row.call.url, row.call.requestId, row.call.errorCode) == (text,) * 5
    plan = _optimised(calls.filter("call is not null").select("call"))
    assert plan.count(TRIM_SPACE + ")") <= 16


def test_container_rows_are_split_once(spark):
    rows = ["t stdout F a b  c", "t stdout P ", "t stderr F x", "stdout F broken", " stdout F x", "t  stdout F x", "t\t stdout F x", "t stdout F", "t stdout FF x", "", None, "t stdout F \nx"]
    df = spark.createDataFrame([(t,) for t in rows], "text string")
    parts = recover.drop_stderr(recover.read_cri(df))
    assert [(r.time, r.tag, r.log, r.is_last) for r in parts.collect()] == [
        ("t", "F", "a b  c", True), ("t", "P", "", False), ("t ", "F", "x", True), ("t", "F", "\nx", True)
    ]
    assert _optimised(parts.select("log", "is_last")).count("split(") == 1


def test_the_fields_of_a_line_are_written_once(spark):
    calls = spark.createDataFrame([("r", "1", "info", "m", "p", '{"a":1,"level":"mine"}')], "partner_ref string, ts_ns string, level string, message string, partner_id string, j string")
    made = compose_lines(calls.withColumn("data", entries_of("j"))).select("line")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("map_from_entries") == 3 and plan.count("startswith(") + plan.count("StartsWith(") == 1
    assert made.first().line.endswith('"level":"mine","message":"m","partnerId":"p","a":1}')
