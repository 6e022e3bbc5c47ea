"""Request context that follows log calls, within a scope and from parent to child."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordered import by_position, running_last
from .scopes import inherited, latest_before

FIELDS = (
    "partner_id",
    "request_id",
    "path",
    "method",
    "status_code",
    "duration",
    "correlation_id",
    "direction",
    "upstream_integration",
    "upstream_base_url",
)


def set_by_row(kind: Column, given: Column, request: dict[str, Column], response: dict[str, Column]) -> Column:
    """The context a row sets, as a map whose present keys count even when null: what
    was ``given`` on a set row; a request sets its fields and resets the answer's; a
    response sets the answer's."""
    none = F.lit(None).cast("string")

    def as_map(values: dict[str, Column]) -> Column:
        return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])

    return (
        F.when(kind == "request", as_map({**request, "status_code": none, "duration": none}))
        .when(kind == "response", as_map(response))
        .otherwise(given)
    )


def _set_values(fields: Sequence[str]) -> dict[str, Column]:
    # the struct keeps an explicit null apart from "not set here"
    return {
        f: F.when(F.map_contains_key("set_context", F.lit(f)), F.struct(F.try_element_at("set_context", F.lit(f)).alias("v")))
        for f in fields
    }


def context_fill(
    calls: DataFrame,
    by: Sequence[str] = ("scope_id",),
    order: str = "seq",
    fields: Sequence[str] = FIELDS,
    chunk: Column | None = None,
) -> DataFrame:
    """Each row with the latest value of every context field set in its scope up to and
    including itself. Reads ``set_context`` (map, null when the row sets nothing)."""
    filled = running_last(
        calls, by, [order], chunk if chunk is not None else by_position(order), _set_values(fields), before=False
    )
    return filled.withColumns({f: F.col(f)["v"] for f in fields}).drop("set_context")


def inherited_context(
    scopes: DataFrame, sets: DataFrame, fields: Sequence[str] = FIELDS, chunk: Column | None = None
) -> DataFrame:
    """The context each scope starts with: for every field the latest set in its
    parent before it opened, else in the grandparent before the parent opened, and so
    on. One as-of lookup per scope on its parent's timeline; what a parent lacks comes by
    pointer jumping, so a chain of scopes costs a row per scope and round."""
    values = _set_values(fields)
    events = sets.select(F.col("scope_id"), F.col("seq"), *[c.alias(f) for f, c in values.items()])
    own = latest_before(scopes.select("scope_id", "parent_id", "open_seq"), "parent_id", "open_seq", events, list(fields), chunk)
    found = inherited(scopes, own.select("scope_id", *fields), list(fields))
    return found.select("scope_id", *[F.col(f)["v"].alias(f) for f in fields])
