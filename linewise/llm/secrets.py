"""Secret scans with ownership frequency, in DataFrame functions only.

Each rule's matches come from one ``regexp_extract_all`` and the pieces between them from one
``split``; the lengths of both, added up by a window over a text's matches, give code point spans, so
the work grows as the text, however many matches it has. A candidate's hash is counted
over the whole corpus by distinct repositories and owners: one that many owners in many repositories hold
is a copied example; one that looks live, and that few repositories of a single owner hold, is that
owner's. What lies between (say a token that one owner has in many repositories) stays unclear.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linewise.llm.stored import stored

# The base rules, in their order, then the rule whose spans the method adds.
_NAME = r"(?i:password|passwd|secret|token|api_?key)"
RULES = (
    ("assign", _NAME + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
    (
        "issued",
        r"gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,}|AIza[A-Za-z0-9_-]{35}"
        r"|eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
        0,
        0,
    ),
)
BASE_RULES = 3
_EXAMPLE = r"(?i)example|sample|dummy|changeme|placeholder|your|xxxx|1234567|abcdef"
#: What a match adds to its rule's running offset, and what is known of it.
MATCH = "struct<kind:int,gap:int,size:int,hash:bigint,live:boolean,wide:boolean>"
BLOCK = 1000


def _looks_live(value: Column) -> Column:
    """Long enough, of letters and digits, of many different characters, and no placeholder."""
    distinct = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= 12) & value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (distinct >= 7) & ~value.rlike(_EXAMPLE)


def _match(kind: int, least: int) -> Callable[[Column], Column]:
    return lambda r: F.struct(
        F.lit(kind).alias("kind"), F.length(r["part"]).alias("gap"), F.length(r["hit"]).alias("size"), F.xxhash64(r["value"]).alias("hash"),
        _looks_live(r["value"]).alias("live"), (F.length(r["value"]) >= least).alias("wide"),
    )


def with_matches(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with an array column of all rules' matches in its ``text`` column, each rule's in order."""
    made, none = [], F.array().cast(f"array<{MATCH}>")
    for kind, (_, pattern, group, least) in enumerate(RULES):
        hits, parts, values = f"{name}_h{kind}", f"{name}_p{kind}", f"{name}_v{kind}"
        df = df.withColumn(hits, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0)))
        df = df.withColumn(parts, F.when(F.size(hits) > 0, F.split(F.col(text), pattern, -1)))
        df = df.withColumn(values, F.when(F.size(hits) > 0, F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(group))) if group else F.col(hits))
        rows = F.arrays_zip(F.slice(parts, 1, F.size(hits)).alias("part"), F.col(hits).alias("hit"), F.col(values).alias("value"))
        made.append(F.when(F.size(hits) > 0, F.transform(rows, _match(kind, least))).otherwise(none))
    df = df.withColumn(name, F.concat(*made))
    return df.drop(*(c for c in df.columns if c.startswith(f"{name}_")))


def spans_of(rows: DataFrame, name: str) -> DataFrame:
    """``rid, owner, repo, kind, start, end, hash, live`` of all matches that are long enough."""
    each = rows.filter(F.size(name) > 0).select("rid", "owner", "repo", F.posexplode(name).alias("place", "m")).select("rid", "owner", "repo", "place", "m.*")
    so_far = F.sum((F.col("gap") + F.col("size")).cast("long")).over(Window.partitionBy("rid", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    each = each.withColumn("end", so_far).filter("wide")
    return each.select("rid", "owner", "repo", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "hash", "live")


def ownership(candidates: DataFrame) -> DataFrame:
    """``hash, n_repos, n_owners`` over all ``candidates (hash, owner, repo)``. Repetitions
    fall away where they are found, so a hash held by a third of all rows moves a row for
    each owner and repository."""
    pairs = candidates.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    return pairs.groupBy("hash").agg(F.count("one").alias("n_repos"), F.countDistinct("owner").alias("n_owners"))


def _text_of(spans: Column) -> Column:
    names = F.array(*(F.lit(r[0]) for r in RULES))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _known(each: DataFrame, few: int, many: int, few_repos: int, many_repos: int) -> DataFrame:
    """Each hash's counts, and whether it is ``copied`` or its owner's ``own``."""
    counts = ownership(each.select("hash", "owner", "repo"))
    copied = (F.col("n_owners") >= many) & (F.col("n_repos") >= many_repos)
    return stored(counts.withColumn("copied", copied).withColumn("own", ~copied & (F.col("n_owners") <= few) & (F.col("n_repos") <= few_repos)), "ownership")


def _own(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def scan(
    docs: DataFrame, owner: str = "source", repo: tuple[str, ...] = ("source", "lang"), few: int = 1, many: int = 3, few_repos: int = 2, many_repos: int = 3,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Every row's secrets: ``doc_id, n_assign, n_access, n_hex, base, base_sha256, spans,
    n_live, n_copied, spread``.

    ``base`` and ``spans`` are ``kind:start:end`` by start, then by the rules' order. Base spans
    always stay; an issued token is added where it is live: it looks so, and has at most ``few`` owners and
    ``few_repos`` repositories. ``n_live`` counts such spans of all kinds, ``n_copied`` those with at least
    ``many`` owners and ``many_repos`` repositories; ``spread`` has ``owners/repositories`` of each of ``spans``.
    ``repo`` names the columns that make up a repository; null owners are one owner. A
    null or empty text has no span. Rows that share an id, or have none, are each scanned."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        _own(owner).alias("owner"), F.to_json(F.array(*(_own(c) for c in repo))).alias("repo"),
    )
    rows = stored(with_matches(rows, "text", "matches").drop("text").withColumn("rid", F.monotonically_increasing_id()), "matches")
    each = stored(spans_of(rows, "matches"), "spans")
    known = _known(each, few, many, few_repos, many_repos)
    verdict = F.when(F.col("copied"), F.lit("copied")).when(F.col("own") & F.col("live"), F.lit("live")).otherwise(F.lit("unclear"))
    judged = each.join(known, "hash").select("rid", F.struct("start", "kind", "end", verdict.alias("verdict"), "n_owners", "n_repos").alias("s"))
    judged = judged.groupBy("rid").agg(F.sort_array(F.collect_list("s")).alias("judged"))
    out = rows.select("rid", "doc_id").join(judged, "rid", "left")
    spans = F.coalesce("judged", F.array().cast("array<struct<start:bigint,kind:int,end:bigint,verdict:string,n_owners:bigint,n_repos:bigint>>"))
    out = out.select("doc_id", spans.alias("all"), F.filter(spans, lambda s: s["kind"] < BASE_RULES).alias("base"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counted = lambda word: F.size(F.filter("all", lambda s: s["verdict"] == word)).cast("long")
    added = F.filter("all", lambda s: (s["kind"] < BASE_RULES) | (s["verdict"] == "live"))
    spread = F.array_join(F.transform(added, lambda s: F.concat_ws("/", s["n_owners"].cast("string"), s["n_repos"].cast("string"))), ",")
    return out.select(
        "doc_id", *(count(k).alias(f"n_{RULES[k][0]}") for k in range(BASE_RULES)), _text_of(F.col("base")).alias("base"),
        F.sha2(_text_of(F.col("base")), 256).alias("base_sha256"), _text_of(added).alias("spans"), counted("live").alias("n_live"), counted("copied").alias("n_copied"), spread.alias("spread"),
    )


def _cuts(spans: DataFrame) -> DataFrame:
    """``rid, _llm_cut``: for each text the stretches that ``spans (rid, start, end)`` cover or touch, in order."""
    order = Window.partitionBy("rid").orderBy("start", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.withColumn("fresh", (before.isNull() | (F.col("start") > before)).cast("int"))
    numbered = fresh.withColumn("stretch", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("rid", "stretch").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("_llm_cut"))


def _without(text: str, put: str) -> Column:
    """``text`` with the stretches ``_llm_cut`` replaced. It is read in ``_llm_blocks``, so that a piece costs its own length."""

    def piece(a: Column, b: Column) -> Column:
        first = F.floor(a / BLOCK).cast("int")
        count = F.floor(b / BLOCK).cast("int") - first + 1
        return F.substring(F.array_join(F.slice("_llm_blocks", first + 1, count), ""), (a % BLOCK).cast("int") + 1, (b - a).cast("int"))

    start = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("_llm_cut", i - 1)["end"])
    pieces = F.transform("_llm_cut", lambda c, i: piece(start(i), c["start"]))
    tail = piece(F.element_at("_llm_cut", -1)["end"], F.length(text).cast("long"))
    return F.array_join(F.concat(pieces, F.array(tail)), put)


def mask(
    docs: DataFrame, owner: str = "source", repo: tuple[str, ...] = ("source", "lang"), few: int = 1, many: int = 3, few_repos: int = 2, many_repos: int = 3, text_col: str = "text",
    put: str = "[SECRET]",
) -> DataFrame:
    """``docs`` with each reported span of ``text_col`` replaced by ``put``; a base span that
    is a copied example (see ``scan``) stays, unless it looks live: a key that
    was copied is a key still. Spans that touch or overlap are replaced once.
    Rows without candidates pass unchanged, and are not moved."""
    kept = docs.columns
    found = with_matches(docs, text_col, "_llm_matches")
    some = found.filter(F.size("_llm_matches") > 0).withColumn("_llm_own", _own(owner)).withColumn("_llm_repo", F.to_json(F.array(*(_own(c) for c in repo))))
    some = stored(some.withColumn("_llm_rid", F.monotonically_increasing_id()), "candidates")
    matches = some.select(F.col("_llm_rid").alias("rid"), F.col("_llm_own").alias("owner"), F.col("_llm_repo").alias("repo"), "_llm_matches")
    each = stored(spans_of(matches, "_llm_matches"), "spans")
    spans = each.join(_known(each, few, many, few_repos, many_repos), "hash")
    spans = spans.filter(F.when(F.col("kind") < BASE_RULES, ~F.col("copied") | F.col("live")).otherwise(F.col("own") & F.col("live")))
    joined = some.join(_cuts(spans.select("rid", "start", "end")).withColumnRenamed("rid", "_llm_rid"), "_llm_rid", "left")
    joined = joined.withColumn("_llm_blocks", F.when(F.col("_llm_cut").isNotNull(), F.regexp_extract_all(F.col(text_col), F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))))
    text = F.when(F.col("_llm_cut").isNull(), F.col(text_col)).otherwise(_without(text_col, put))
    clean = found.filter((F.size("_llm_matches") == 0) | F.col("_llm_matches").isNull()).select(*kept)
    return clean.unionByName(joined.withColumn(text_col, text).select(*kept))
