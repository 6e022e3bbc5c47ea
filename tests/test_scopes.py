"""Scope attribution scenarios, each checked against the documented outcome."""

from pyspark.sql import functions as F

from linewise.operators.context import context_fill, inherited_context
from linewise.operators.scopes import ancestors, assign_calls, host_of_scope


def build(spark, script):
    """script: list of (kind, scope, extra) in time order -> (scopes, events, calls)."""
    scopes, events, calls = {"root": [None, 0, None]}, [], []
    for seq, (kind, scope, extra) in enumerate(script, start=1):
        if kind == "open":
            scopes[scope] = [extra, seq, None]
        elif kind == "end":
            scopes[scope][2] = seq
        elif kind == "call":
            calls.append((extra, scope, seq))
        else:
            events.append((scope, seq, kind))
    return (
        spark.createDataFrame([(k, *v) for k, v in scopes.items()],
                              "scope_id string, parent_id string, open_seq bigint, end_seq bigint"),
        spark.createDataFrame(events, "scope_id string, seq bigint, kind string"),
        spark.createDataFrame(calls, "name string, scope_id string, seq bigint"),
    )


def shipped(spark, script, width=2):
    """{(scope, nth response): [calls]} and {fate: [calls]} with tiny chunks."""
    scopes, events, calls = build(spark, script)
    chunk = F.floor(F.col("seq") / width)
    rows = assign_calls(calls, scopes, events, chunk).orderBy("seq").collect()
    lines, fates = {}, {}
    for r in rows:
        if r.fate == "shipped":
            lines.setdefault((r.ship_scope, r.ship_seq), []).append(r["name"])
        else:
            fates.setdefault(r.fate, []).append(r["name"])
    return list(lines.values()), fates


def test_preflight_and_own_calls(spark):
    assert shipped(spark, [
        ("open", "a", "root"), ("call", "a", "auth"), ("request", "a", None), ("call", "a", "in"), ("response", "a", None),
    ]) == ([["auth", "in"]], {})


def test_nested_scope_joins_in_start_order(spark):
    lines, fates = shipped(spark, [
        ("open", "a", "root"), ("request", "a", None), ("call", "a", "outer-1"), ("open", "n", "a"), ("call", "n", "nested-1"),
        ("call", "n", "nested-2"), ("end", "n", None), ("call", "a", "outer-2"), ("call", "n", "late"), ("response", "a", None),
    ])
    assert lines == [["outer-1", "nested-1", "nested-2", "outer-2", "late"]] and fates == {}


def test_child_is_pulled_without_ending(spark):
    assert shipped(spark, [
        ("open", "r", "root"), ("request", "r", None), ("open", "h", "r"), ("call", "h", "helper"), ("response", "r", None),
        ("call", "h", "after"),
    ]) == ([["helper"]], {"pending": ["after"]})


def test_nested_request_keeps_its_own(spark):
    lines, _ = shipped(spark, [
        ("open", "o", "root"), ("request", "o", None), ("open", "n", "o"), ("call", "n", "pre"), ("request", "n", None),
        ("call", "n", "own"), ("response", "n", None), ("end", "n", None), ("call", "o", "outer"), ("response", "o", None),
    ])
    assert lines == [["pre", "own"], ["outer"]]


def test_between_exchanges_is_top_level(spark):
    lines, fates = shipped(spark, [
        ("open", "app", "root"), ("request", "app", None), ("response", "app", None),
        ("open", "between", "app"), ("call", "between", "child-between"),
        ("open", "run", "app"), ("call", "run", "nested-between"), ("end", "run", None),
        ("request", "app", None), ("open", "during", "app"), ("call", "during", "child-during"),
        ("call", "between", "later"), ("response", "app", None), ("end", "app", None),
    ])
    assert lines == [["child-during"]]
    assert fates == {"pending": ["child-between", "later"], "lost": ["nested-between"]}


def test_root_calls_ride_root_responses(spark):
    assert shipped(spark, [
        ("call", "root", "wide"), ("open", "s", "root"), ("request", "s", None), ("call", "s", "scoped"), ("response", "s", None),
        ("request", "root", None), ("response", "root", None),
    ]) == ([["wide"], ["scoped"]], {})


def test_a_request_between_takes_the_calls(spark):
    lines, fates = shipped(spark, [
        ("open", "host", "root"), ("request", "host", None), ("open", "mid", "host"), ("open", "leaf", "mid"),
        ("call", "leaf", "c"), ("request", "mid", None), ("response", "host", None), ("response", "mid", None),
    ])
    assert lines == [["c"]] and fates == {}


def test_unanswered_request_hands_to_its_host_when_it_ends(spark):
    assert shipped(spark, [
        ("open", "o", "root"), ("request", "o", None), ("open", "n", "o"), ("request", "n", None), ("call", "n", "c"),
        ("end", "n", None), ("response", "o", None),
    ]) == ([["c"]], {})


def test_scope_ended_without_response_loses_calls(spark):
    assert shipped(spark, [
        ("open", "a", "root"), ("request", "a", None), ("call", "a", "x"), ("open", "n", "a"), ("call", "n", "y"),
        ("end", "n", None), ("end", "a", None), ("call", "n", "z"),
    ]) == ([], {"lost": ["x", "y", "z"]})


def test_many_responses_use_the_timeline(spark):
    script = [("open", "a", "root")]
    for i in range(80):
        script += [("request", "a", None), ("call", "a", f"c{i}"), ("response", "a", None)]
    lines, fates = shipped(spark, script, width=7)
    assert lines == [[f"c{i}"] for i in range(80)] and fates == {}


def test_ancestors_of_a_chain(spark):
    n = 11
    scopes = spark.createDataFrame([(str(i), str(i - 1) if i else None, i, None) for i in range(n)],
                                   "scope_id string, parent_id string, open_seq bigint, end_seq bigint")
    rows = {(int(r.scope_id), int(r.ancestor_id), r.depth, r.cut_seq) for r in ancestors(scopes).collect()}
    assert rows == {(s, a, s - a, a + 1) for s in range(n) for a in range(s)}


def test_host_is_decided_at_open(spark):
    scopes, events, _ = build(spark, [
        ("open", "a", "root"), ("open", "early", "a"), ("request", "a", None), ("open", "mid", "a"), ("open", "deep", "mid"),
        ("response", "a", None), ("open", "late", "a"), ("call", "a", "x"),
    ])
    hosts = {r.scope_id: r.host_id for r in host_of_scope(scopes, events, F.floor(F.col("seq") / 2)).collect()}
    assert hosts == {"root": None, "a": None, "early": None, "mid": "a", "deep": "a", "late": None}


def test_context_fill_and_inheritance(spark):
    rows = [("s", 1, {"partner_id": "p"}), ("s", 2, None), ("s", 3, {"status_code": "1", "path": "/a"}),
            ("s", 4, {"status_code": None}), ("s", 5, None), ("t", 1, None)]
    df = spark.createDataFrame(rows, "scope_id string, seq bigint, set_context map<string,string>")
    got = context_fill(df, fields=["partner_id", "status_code", "path"], chunk=F.floor(F.col("seq") / 2))
    assert [tuple(r)[2:] for r in got.orderBy("scope_id", "seq").collect()] == [
        ("p", None, None), ("p", None, None), ("p", "1", "/a"), ("p", None, "/a"), ("p", None, "/a"), (None, None, None)]
    scopes = spark.createDataFrame([("root", None, 0, None), ("c", "root", 5, None), ("g", "c", 8, None)],
                                   "scope_id string, parent_id string, open_seq bigint, end_seq bigint")
    sets = spark.createDataFrame([("root", 1, {"path": "/1", "method": "A"}), ("root", 6, {"path": "/6"}),
                                  ("c", 7, {"method": None}), ("c", 9, {"method": "late"})],
                                 "scope_id string, seq bigint, set_context map<string,string>")
    got = inherited_context(scopes, sets, ["path", "method"], F.floor(F.col("seq") / 2))
    assert {r.scope_id: (r.path, r.method) for r in got.collect()} == {
        "root": (None, None), "c": ("/1", "A"), "g": ("/1", None)}
