"""The scope tree: ancestors, hosts, and which response a call ships on.

``scopes``        (scope_id, parent_id, open_seq, end_seq)  end_seq null while open
``scope_events``  (scope_id, seq, kind)                     kind: request | response
The root scope has no parent; it is never a request. ``seq`` orders everything of one
logger, and scope ids are unique over all loggers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .ordered import by_position, running_last


def ancestors(scopes: DataFrame) -> DataFrame:
    """(scope_id, ancestor_id, depth, cut_seq): every ancestor of every scope, and the
    open time of the scope just below it on the way. For those who want the pairs
    themselves; no operator needs them.

    Paths double in length each round, so a tree of depth d takes log2(d) joins; each
    round is written to the checkpoint folder."""
    jumps(scopes)  # a cycle has no end of pairs
    known = cut_lineage(
        scopes.filter(F.col("parent_id").isNotNull()).select(
            "scope_id", F.col("parent_id").alias("ancestor_id"), F.lit(1).alias("depth"), F.col("open_seq").alias("cut_seq")
        )
    )
    reach = 1
    while True:
        ends = known.filter(F.col("depth") == reach).select("scope_id", F.col("ancestor_id").alias("_via"), "depth")
        onward = known.select(
            F.col("scope_id").alias("_via"), "ancestor_id", F.col("depth").alias("_more"), "cut_seq"
        )
        longer = cut_lineage(
            ends.join(onward, "_via").select("scope_id", "ancestor_id", (F.col("depth") + F.col("_more")).alias("depth"), "cut_seq")
        )
        if longer.isEmpty():
            return known
        known = known.unionByName(longer)
        reach *= 2


def _check_cycles(level: DataFrame, reach: int, n: int) -> None:
    """A scope with a pointer longer than there are scopes is on a cycle of parents, or below one."""
    if reach > n:
        names = sorted(str(r[0]) for r in level.filter(F.col("up").isNotNull()).select("scope_id").limit(10).collect())
        raise ValueError(f"scopes on or below a cycle of parents: {', '.join(names)}")


def jumps(scopes: DataFrame, first_events: DataFrame | None = None) -> list[DataFrame]:
    """Jump pointers (scope_id, up, least): at level k ``up`` is the 2^k-th ancestor, and
    ``least`` the earliest first event among the ancestors on the way, the root aside. One
    row per scope and level; log2(depth) joins. ``first_events`` has scope_id and ``q``.

    A cycle of parents is an error that names the scopes concerned."""
    parents = scopes.select("scope_id", F.col("parent_id").alias("up"))
    if first_events is None:
        level = parents.withColumn("least", F.lit(None).cast("bigint"))
    else:
        below_root = first_events.join(scopes.filter(F.col("parent_id").isNotNull()).select("scope_id"), "scope_id", "left_semi")
        level = parents.join(below_root.select(F.col("scope_id").alias("up"), F.col("q").alias("least")), "up", "left").select("scope_id", "up", "least")
    level = cut_lineage(level)
    n, levels = level.count(), [level]
    while not level.filter(F.col("up").isNotNull()).isEmpty():
        _check_cycles(level, 1 << (len(levels) - 1), n)
        above = level.select(F.col("scope_id").alias("up"), F.col("up").alias("_up"), F.col("least").alias("_least"))
        level = cut_lineage(level.join(above, "up", "left").select("scope_id", F.col("_up").alias("up"), F.least("least", "_least").alias("least")))
        levels.append(level)
    return levels


def nearest_above(rows: DataFrame, levels: list[DataFrame], scope: str, before: str, out: str) -> DataFrame:
    """Adds ``out``: the nearest ancestor of ``scope`` that had an event before ``before``.
    From the longest jump down, a jump is taken when nothing on its way qualifies; the
    next ancestor is then the one looked for. One join per level, one row per row."""
    rows = rows.withColumn("_at_scope", F.col(scope))
    for level in reversed(levels):
        step = level.select(F.col("scope_id").alias("_at_scope"), "up", "least")
        passes = F.coalesce(F.col("least") >= F.col(before), F.lit(True))
        rows = rows.join(step, "_at_scope", "left").withColumn("_at_scope", F.when(passes, F.col("up")).otherwise(F.col("_at_scope"))).drop("up", "least")
    last = levels[0].select(F.col("scope_id").alias("_at_scope"), F.col("up").alias("_found"), F.col("least").alias("_when"))
    found = F.when(F.col("_when") < F.col(before), F.col("_found"))
    return rows.join(last, "_at_scope", "left").withColumn(out, found).drop("_at_scope", "_found", "_when")


def latest_before(
    rows: DataFrame, line: str, at: str, events: DataFrame, values: list[str], chunk: Column | None = None, later: bool = False
) -> DataFrame:
    """Adds the latest non-null ``values`` of the events of scope ``line`` before ``at``; with
    ``later`` the first ones after it. Rows and events lie on one timeline per scope that is
    filled chunk by chunk. ``events`` has scope_id, seq and the values."""
    kinds = {f.name: f.dataType for f in events.schema.fields}
    columns = rows.columns
    probes = rows.select(
        F.col(line).alias("_line"), F.col(at).alias("seq"), F.lit(0).alias("_event"), F.struct(*columns).alias("_row"),
        *[F.lit(None).cast(kinds[v]).alias(f"_v_{v}") for v in values],
    )
    marks = events.select(
        F.col("scope_id").alias("_line"), "seq", F.lit(1).alias("_event"), F.lit(None).cast(probes.schema["_row"].dataType).alias("_row"),
        *[F.col(v).alias(f"_v_{v}") for v in values],
    )
    chunk = chunk if chunk is not None else by_position("seq")
    timeline = probes.unionByName(marks).withColumn("_time", -F.col("seq") if later else F.col("seq"))
    filled = running_last(
        timeline,
        ["_line"],
        ["_time", "_event"],  # an event at the same time is neither before nor after
        -chunk if later else chunk,
        {v: F.col(f"_v_{v}") for v in values},
        before=True,
    )
    return filled.filter(F.col("_event") == 0).select("_row.*", *values)


def _first_events(scope_events: DataFrame) -> DataFrame:
    return scope_events.groupBy("scope_id").agg(F.min("seq").alias("q"))


def host_of_scope(
    scopes: DataFrame, scope_events: DataFrame, chunk: Column | None = None, levels: list[DataFrame] | None = None
) -> DataFrame:
    """(scope_id, host_id): the nearest ancestor that was a request when the scope
    opened, if it was between its request and its response then; else null."""
    levels = levels if levels is not None else jumps(scopes, _first_events(scope_events))
    near = nearest_above(scopes.select("scope_id", "open_seq"), levels, "scope_id", "open_seq", "_near")
    states = scope_events.select("scope_id", "seq", (F.col("kind") == "request").alias("_mid"))
    seen = latest_before(near, "_near", "open_seq", states, ["_mid"], chunk)
    return seen.select("scope_id", F.when(F.col("_mid"), F.col("_near")).alias("host_id"))


def inherited(scopes: DataFrame, own: DataFrame, values: list[str]) -> DataFrame:
    """``own`` (scope_id, values) with every null value taken from the nearest ancestor that has
    it. Pointers double in length each round and carry what was found on their way."""
    level = scopes.select("scope_id", F.col("parent_id").alias("up")).join(own, "scope_id", "left").select("scope_id", "up", *values)
    level, reach = cut_lineage(level), 1
    n = level.count()
    while not level.filter(F.col("up").isNotNull()).isEmpty():
        _check_cycles(level, reach, n)
        above = level.select(F.col("scope_id").alias("up"), F.col("up").alias("_up"), *[F.col(v).alias(f"_a_{v}") for v in values])
        joined = level.join(above, "up", "left")
        level = cut_lineage(joined.select("scope_id", F.col("_up").alias("up"), *[F.coalesce(v, f"_a_{v}").alias(v) for v in values]))
        reach *= 2
    return level.drop("up")


def assign_calls(
    calls: DataFrame, scopes: DataFrame, scope_events: DataFrame, chunk: Column | None = None
) -> DataFrame:
    """(call columns, ship_scope, ship_seq, fate): the response a call ships on.

    A call starts in the scope it was made in and moves up while the rules say so: out
    of an ended scope to its host; out of a non-request scope to the host when the host
    responds or ends (or to a scope between them that has become a request). ``fate`` is
    ``shipped``, ``lost`` (no line left) or ``pending`` (a scope that never answers).
    ``calls`` has scope_id and seq, the start order."""
    first = _first_events(scope_events)
    levels = jumps(scopes, first)
    hosts = host_of_scope(scopes, scope_events, chunk, levels)
    facts = cut_lineage(
        scopes.select("scope_id", "end_seq", F.col("parent_id").isNull().alias("is_root"))
        .join(first.withColumnRenamed("q", "request_seq"), "scope_id", "left")
        .join(hosts, "scope_id", "left")
    )
    answers = scope_events.filter(F.col("kind") == "response").select("scope_id", "seq", F.col("seq").alias("_next"))
    moving = calls.select(F.struct(*calls.columns).alias("_call"), F.col("scope_id").alias("_at"), F.col("seq").alias("_tau"))
    done = None
    for _ in range((1 << len(levels)) + 1):  # every hop is to an ancestor
        step = cut_lineage(_hop(moving, facts, answers, levels, chunk))
        final = step.filter(F.col("fate") != "moves").select("_call.*", "ship_scope", "ship_seq", "fate")
        done = final if done is None else done.unionByName(final)
        moving = step.filter(F.col("fate") == "moves").select("_call", "_at", "_tau")
        if moving.isEmpty():
            break
    return done


def _hop(moving: DataFrame, facts: DataFrame, answers: DataFrame, levels: list[DataFrame], chunk: Column | None) -> DataFrame:
    own = facts.select(*[F.col(c).alias(f"x_{c}") for c in facts.columns])
    host = facts.select(F.col("scope_id").alias("h_scope_id"), F.col("end_seq").alias("h_end_seq"))
    rows = moving.join(own, F.col("_at") == F.col("x_scope_id")).join(
        host, F.col("x_host_id") == F.col("h_scope_id"), "left"
    )
    rows = latest_before(rows, "_at", "_tau", answers, ["_next"], chunk, later=True).withColumnRenamed("_next", "own_next")
    rows = latest_before(rows, "x_host_id", "_tau", answers, ["_next"], chunk, later=True).withColumnRenamed("_next", "host_next")

    tau, end, request = F.col("_tau"), F.col("x_end_seq"), F.col("x_request_seq")
    hosted = F.col("x_host_id").isNotNull()
    ended = F.coalesce(end <= tau, F.lit(False))
    pull = F.least("host_next", "h_end_seq")  # least() skips nulls
    is_request = F.coalesce(request <= tau, F.lit(False)) | F.coalesce(request < pull, F.lit(False)) | (
        pull.isNull() & request.isNotNull()
    )
    keeps = F.col("x_is_root") | ~hosted | is_request
    rows = rows.select(
        "*",
        (~ended & keeps & F.col("own_next").isNotNull()).alias("_ships"),
        F.when(ended, tau).when(keeps, end).otherwise(F.least(pull, end)).alias("_leaves"),
        (~ended & ~keeps & F.coalesce(pull <= F.coalesce(end, pull), F.lit(False))).alias("_pulled"),
        ended.alias("_ended"),
    )
    leaves_at, pulled = F.col("_leaves"), F.col("_pulled")
    between = nearest_above(rows.filter(pulled), levels, "_at", "_leaves", "_between")
    rows = between.unionByName(rows.filter(~pulled), allowMissingColumns=True)
    target = F.coalesce("_between", "x_host_id")
    # pulled by a response: arrive just before it; otherwise at the time of leaving
    arrives = F.when(
        pulled & F.coalesce(F.col("host_next") == leaves_at, F.lit(False)) & (target == F.col("x_host_id")), leaves_at - 1
    ).otherwise(F.greatest(tau, leaves_at))
    moves = ~F.col("_ships") & hosted & leaves_at.isNotNull()
    fate = (
        F.when(F.col("_ships"), "shipped")
        .when(moves, "moves")
        .when(~hosted & (F.col("_ended") | (~F.col("x_is_root") & end.isNotNull())), "lost")
        .otherwise("pending")
    )
    return rows.select(
        "_call",
        F.when(moves, target).otherwise(F.col("_at")).alias("_at"),
        F.when(moves, arrives).otherwise(tau).alias("_tau"),
        F.when(F.col("_ships"), F.col("_at")).alias("ship_scope"),
        F.when(F.col("_ships"), F.col("own_next")).alias("ship_seq"),
        fate.alias("fate"),
    )
