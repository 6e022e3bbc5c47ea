"""Text that came in as bytes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import col


def substitute_bad_utf8(value: Column | str) -> Column:
    """Bytes as text; every invalid sequence becomes U+FFFD and the row stays."""
    return F.make_valid_utf8(col(value).cast("string"))
