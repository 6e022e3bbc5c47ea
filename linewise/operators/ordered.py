"""Running values over long ordered groups, without one task per group.

A window over (file) or (scope) puts a whole group into one task; one file or scope may
hold a third of all rows. Here a group is cut into chunks by position. Each chunk is
windowed on its own, the chunks' totals (one row per chunk) are accumulated over the
group, and what came before a chunk is joined back to its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHUNK = "_chunk"
DEFAULT_CHUNK_ROWS = 1_000_000


def by_position(position: str, width: int = DEFAULT_CHUNK_ROWS) -> Column:
    """The chunk of a row whose position is an integer that is unique in its group."""
    return F.floor(F.col(position) / F.lit(width)).cast("bigint")


def local_window(keys: Sequence[str], order: Sequence[str]):
    return W.partitionBy(*keys, CHUNK).orderBy(*order)


def join_carry(rows: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with their chunk's carried values; null in a group's first chunk. No
    broadcast hint: the carry table grows with the data, AQE picks by its real size."""
    renamed = carry.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col(CHUNK).alias("_kc"),
        *[c for c in carry.columns if c not in (*keys, CHUNK)],
    )
    match = F.col(CHUNK) == F.col("_kc")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return rows.join(renamed, match, "left").drop("_kc", *[f"_k{i}" for i in range(len(keys))])


def running_sum(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, sums: dict[str, Column], *, before: bool
) -> DataFrame:
    """Adds for each name the sum of its column over the group's rows up to this one
    (``before``: without this one)."""
    rows = df.withColumn(CHUNK, chunk)
    window = local_window(keys, order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    local = rows.select("*", *[F.coalesce(F.sum(c).over(window), F.lit(0)).alias(n) for n, c in sums.items()])
    totals = rows.groupBy(*keys, CHUNK).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"_c_{n}") for n, c in sums.items()])
    earlier = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(*keys, CHUNK, *[F.sum(f"_c_{n}").over(earlier).alias(f"_c_{n}") for n in sums])
    carry = carry.filter(F.coalesce(*[F.col(f"_c_{n}") for n in sums]).isNotNull())
    joined = join_carry(local, carry, keys)
    for n in sums:
        joined = joined.withColumn(n, F.col(n) + F.coalesce(F.col(f"_c_{n}"), F.lit(0)))
    return joined.drop(CHUNK, *[f"_c_{n}" for n in sums])


def running_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], chunk: Column, values: dict[str, Column], *, before: bool
) -> DataFrame:
    """Adds for each name the latest non-null value of its column in the group up to
    this row (``before``: without this one)."""
    rows = df.withColumn(CHUNK, chunk)
    window = local_window(keys, order).rowsBetween(W.unboundedPreceding, -1 if before else 0)
    local = rows.select("*", *[F.last(c, ignorenulls=True).over(window).alias(n) for n, c in values.items()])
    at = F.struct(*[F.col(o) for o in order])
    totals = rows.groupBy(*keys, CHUNK).agg(
        *[F.max_by(c, F.when(c.isNotNull(), at)).alias(f"_c_{n}") for n, c in values.items()]
    )
    earlier = W.partitionBy(*keys).orderBy(CHUNK).rowsBetween(W.unboundedPreceding, -1)
    carry = totals.select(
        *keys, CHUNK, *[F.last(f"_c_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in values]
    )
    carry = carry.filter(reduce(or_, [F.col(f"_c_{n}").isNotNull() for n in values]))
    joined = join_carry(local, carry, keys)
    for n in values:
        joined = joined.withColumn(n, F.coalesce(F.col(n), F.col(f"_c_{n}")))
    return joined.drop(CHUNK, *[f"_c_{n}" for n in values])
