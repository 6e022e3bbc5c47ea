"""Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
