"""URL filters: host rules first, then a tree of path templates with labelled purity.

Segments that are a number, date or hash by their look are wildcards everywhere. All others are
values of their host until its labels say more. A tree grows over the paths of labelled pages, and at
each node every child whose share of bad pages cannot be told from that of its siblings
(Hoeffding's bound), and within which no name can be told from the rest either, becomes a wildcard,
however many or few its pages are. So names that vary are wildcards on every host, as each has
too few labels to stand apart, and a name with a number in it that holds a branch of its own is
not. Children that stand apart are merged with those like them: the same names further down must
deviate in the same way, and the shares, put in order, must follow each other within the bound. So
branches that are alike share their evidence, and unlike ones never do. Pages without a label
take the way of the same names; a name that is not in the tree is a wildcard. A template is
rejected when its share of bad pages, smoothed towards that of all labelled pages, is too high.

A stretch of segments that all labelled pages of a node share is passed in one step, and a node with too few
labels for any comparison ends its branch, so the steps follow the branching, not the length of paths.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linewise.llm.stored import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Numbers, hashes and dates: segments taken for values by their look, before any counting.
VARIABLE = r"^(\d+|(?=[^.]*\d)[0-9a-fA-F]{8,}|(?=[^.]*\d)[0-9a-fA-F-]{32,36}|\d{4}-\d{2}(-\d{2})?)(\.[A-Za-z0-9]{1,5})?$"
#: Shares are put in order by this many steps; what is closer is alike.
BINS = 256
Level = tuple[DataFrame | None, DataFrame | None]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) after the first ``://`` up to ``/``, ``?``, ``#`` or the end, and the
    path from there up to ``?``, ``#`` or the end; both empty without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of ``(verdict, host + path)`` rules that fits, and its verdict, else nulls. A
    rule fits its host and all subdomains where the path starts with its own."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(word)).otherwise(verdict)
    return name, verdict


def _shape(path: Column) -> Column:
    """A path's segments with the evident values as ``*``."""
    parts = F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), lambda s: F.regexp_replace(s, VARIABLE, "*"))
    return F.when(path == "", F.array().cast("array<string>")).otherwise(parts)


def _sums(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))


def _apart(bound: float) -> tuple[Column, Column]:
    """Whether ``bad / labelled`` is outside the bound of the rest of ``all_bad / all_labelled``, and above it."""
    others, other_bad = F.col("all_labelled") - F.col("labelled"), F.col("all_bad") - F.col("bad")
    slack = bound * (1 / F.sqrt(F.col("labelled")) + 1 / F.sqrt(others))
    differs = F.abs(F.col("bad") / F.col("labelled") - other_bad / F.nullif(others, F.lit(0))) > slack
    return F.coalesce(differs & (others > 0), F.lit(False)), F.col("bad") * others > other_bad * F.col("labelled")


def _deviations(deeper: DataFrame, children: DataFrame, bound: float) -> DataFrame:
    """``host, template, part, inner``: of each child in which a name stands apart from the child's other
    pages, a number for all such names with the place at which and the direction in which they do."""
    names = deeper.select("host", "template", "part", "labelled", "bad", F.posexplode("rest").alias("place", "name"))
    names = _sums(names, "host", "template", "part", "place", "name").filter(F.col("labelled") > bound**2)
    whole = children.select("host", "template", "part", F.col("labelled").alias("all_labelled"), F.col("bad").alias("all_bad"))
    apart, worse = _apart(bound)
    odd = names.join(whole, ["host", "template", "part"]).filter(apart)
    return odd.groupBy("host", "template", "part").agg(F.bit_xor(F.xxhash64("place", "name", worse)).alias("inner"))


def _named(strong: DataFrame, bound: float) -> DataFrame:
    """Names for ``strong`` children: ``*+`` (worse than the node's others, the worst first) or ``*-``
    (better, the best first), a number from the second group on, and what deviates within."""
    share = F.least(F.floor(BINS * F.col("bad") / F.col("labelled")), F.lit(BINS)).cast("int")
    binned = strong.withColumn("bin", share)
    keys = ["host", "template", "inner"]
    bins = binned.groupBy(*keys, "bin").agg(F.sum("labelled").alias("n"), F.sum("bad").alias("b"), F.first("all_labelled").alias("all_n"), F.first("all_bad").alias("all_b"))
    rows = bins.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("bin", "n", "b"))).alias("bins"), F.first("all_n").alias("all_n"), F.first("all_b").alias("all_b"))  # BINS + 1 each at most
    group = "struct<n:bigint,b:bigint,bins:array<int>>"
    near = f"abs(x.b / x.n - g[size(g) - 1].b / g[size(g) - 1].n) <= {bound!r} * (1 / sqrt(x.n) + 1 / sqrt(g[size(g) - 1].n))"
    last = "g[size(g) - 1]"
    joined = f"concat(slice(g, 1, size(g) - 1), array(named_struct('n', {last}.n + x.n, 'b', {last}.b + x.b, 'bins', concat({last}.bins, array(x.bin)))))"
    groups = F.expr(f"aggregate(bins, cast(array() as array<{group}>), (g, x) -> if(size(g) > 0 and {near}, {joined}, concat(g, array(named_struct('n', x.n, 'b', x.b, 'bins', array(x.bin))))))")
    rows = rows.withColumn("g", groups).withColumn("worse", F.expr("filter(sequence(1, size(g)), i -> g[i - 1].b * (all_n - g[i - 1].n) > (all_b - g[i - 1].b) * g[i - 1].n)"))
    each = rows.select(*keys, "g", "worse", F.posexplode("g").alias("i", "own")).withColumn("i", F.col("i") + 1)
    up = F.array_contains("worse", F.col("i"))
    rank = F.when(up, F.size(F.filter("worse", lambda k: k >= F.col("i")))).otherwise(F.col("i") - F.size(F.filter("worse", lambda k: k < F.col("i"))))
    name = F.concat(F.when(up, "*+").otherwise("*-"), F.when(rank > 1, rank.cast("string")).otherwise(""), F.when(F.col("inner") != 0, F.concat(F.lit("~"), F.lower(F.hex("inner")))).otherwise(""))
    names = each.select(*keys, name.alias("name"), F.explode("own.bins").alias("bin"))
    return binned.join(names, [*keys, "bin"]).select("host", "template", "part", "name")


def branches(shapes: DataFrame, delta: float = 0.05) -> list[Level]:
    """For each level what its nodes pass in one step, ``host, template, skip``, and the names of
    the children that stand apart, ``host, template, part, name`` (None where there are none),
    from the labelled ``shapes (host, shape, labelled, bad)``.

    ``delta`` is the chance of a share outside the bound; for names further down a tenth of it, as there are more."""
    bound, inner_bound = (math.sqrt(math.log(2 / d) / 2) for d in (delta, delta / 10))
    rows = stored(shapes.withColumn("template", F.lit("")), "shapes")
    levels: list[Level] = []
    while True:
        rows = rows.filter(F.size("shape") > 0)
        nodes = rows.groupBy("host", "template").agg(F.sum("labelled").alias("n"), F.min("shape").alias("lo"), F.max("shape").alias("hi")).filter(F.col("n") > bound**2)
        alike = F.array_position(F.zip_with("lo", "hi", lambda a, b: a.eqNullSafe(b)), False)
        nodes = stored(nodes.select("host", "template", F.when(alike > 0, alike - 1).otherwise(F.size("lo")).cast("int").alias("skip")), "nodes")
        if nodes.isEmpty():
            return levels
        active = rows.join(nodes, ["host", "template"]).withColumn("template", F.concat("template", F.expr("repeat('/*', skip)")))
        deeper = active.filter(F.size("shape") > F.col("skip")).withColumn("part", F.get("shape", F.col("skip"))).withColumn("rest", F.expr("slice(shape, skip + 2, size(shape))"))
        deeper = stored(deeper.select("host", "template", "part", "rest", "labelled", "bad"), "branches")
        children = _sums(deeper, "host", "template", "part")
        totals = _sums(children, "host", "template").select("host", "template", F.col("labelled").alias("all_labelled"), F.col("bad").alias("all_bad"))
        both = children.filter(F.col("labelled") > bound**2).join(totals, ["host", "template"])
        both = both.join(_deviations(deeper, children, inner_bound), ["host", "template", "part"], "left").fillna(0, ["inner"])
        strong = stored(both.filter(_apart(bound)[0] | (F.col("inner") != 0)), "strong")
        names = None if strong.isEmpty() else stored(_named(strong, bound), "names")
        skips = nodes.filter("skip > 0")
        levels.append((None if skips.isEmpty() else skips, names))
        deeper = _follow(deeper.withColumnRenamed("rest", "shape"), names, F.col("part"))
        rows = stored(_sums(deeper, "host", "template", "shape"), "shapes")


def _follow(rows: DataFrame, chosen: DataFrame | None, part: Column) -> DataFrame:
    """``rows`` with ``template`` one level longer where they have a ``part`` there."""
    kept = [c for c in rows.columns if c != "part"]
    name = F.lit("*")
    if chosen is not None:
        rows = rows.withColumn("part", part).join(chosen, ["host", "template", "part"], "left")
        part, name = F.col("part"), F.coalesce("name", F.lit("*"))
    longer = F.when(part.isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), name))
    return rows.withColumn("template", longer).select(*kept)


def templates(rows: DataFrame, levels: list[Level]) -> DataFrame:
    """``rows (host, shape)`` with their ``template``, by the names of ``branches``."""
    kept = rows.columns
    rows = rows.withColumn("template", F.lit("")).withColumn("at", F.lit(0))
    last = max((k + 1 for k, (_, names) in enumerate(levels) if names is not None), default=0)
    for skips, names in levels[:last]:
        if skips is not None:
            step = F.least(F.coalesce("skip", F.lit(0)), F.size("shape") - F.col("at"))
            rows = rows.join(skips, ["host", "template"], "left").withColumn("skip", step)
            rows = rows.withColumn("template", F.concat("template", F.expr("repeat('/*', skip)"))).withColumn("at", F.col("at") + F.col("skip")).drop("skip")
        rows = _follow(rows, names, F.get("shape", F.col("at"))).withColumn("at", F.least(F.col("at") + 1, F.size("shape")))
    rest = F.expr("repeat('/*', size(shape) - at)")
    return rows.select(*kept, F.concat("template", rest).alias("template"))


def judge_urls(
    pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]], limit: float = 0.5, weight: float = 5.0, id_col: str = "page_id", url_col: str = "url",
    label_id: str = "doc_id", bad: Column | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template`` of every row of ``pages``.

    The rule that fits decides; else the row's template: block where (bad + ``weight`` * p) /
    (labelled + ``weight``) exceeds ``limit``, p being the share of all labelled pages. ``labels``
    name pages by ``label_id``; of several for a page one bad one makes it bad. A null url, or
    one without ``://``, has an empty host and path and is judged like any other. Rows that share
    an id, or have none, are each judged. Only the named columns are read."""
    condition = bad if bad is not None else (F.col("quality") == 0) | (F.col("toxic") == 1)
    known = labels.select(F.col(label_id).cast("long").alias("id"), F.coalesce(condition, F.lit(False)).cast("int").alias("b"))
    known = known.filter("id is not null").groupBy("id").agg(F.max("b").alias("b"))
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("shape", _shape(F.col("path")))
    shapes = rows.join(known, "id").groupBy("host", "shape").agg(F.count("b").alias("labelled"), F.sum("b").alias("bad"))
    shapes = stored(shapes, "urls")
    levels = branches(shapes)
    total, wrong = shapes.agg(F.sum("labelled"), F.sum("bad")).first()
    prior = (wrong or 0) / total if total else 0.0
    sums = templates(shapes, levels).groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    smooth = (F.col("bad") + weight * prior) / (F.col("labelled") + weight)
    judged = stored(sums.select("host", "template", F.when(smooth > limit, "block").otherwise("allow").alias("own")), "verdicts")
    name, word = matching_rule(F.col("host"), F.col("path"), rules)
    out = templates(rows, levels).join(judged, ["host", "template"], "left")
    verdict = F.coalesce(word, F.col("own"), F.lit("block" if prior > limit else "allow"))
    return out.select(F.col("id").alias("page_id"), "host", "path", name.alias("rule"), verdict.alias("verdict"), "template")
