"""Epoch milliseconds, nanosecond digit strings and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import bind, col

# Optional sign, digits, optional fraction; nothing else, at least one digit.
_DECIMAL = r"^[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)\z"
_WHOLE = r"^[1-9][0-9]*\z"


def ms_to_ns(value: Column | str) -> Column:
    """Milliseconds written as text -> nanoseconds as a digit string, else null.

    The point moves six places and the rest is cut off, so no precision is lost
    however long the number is.
    """

    def shift(text: Column) -> Column:
        body = F.regexp_replace(text, r"^[+-]", "")
        whole = F.substring_index(body, ".", 1)
        fraction = F.when(F.contains(body, F.lit(".")), F.substring_index(body, ".", -1)).otherwise(F.lit(""))
        digits = F.regexp_replace(F.concat(whole, F.rpad(fraction, 6, "0")), r"^0+", "")
        sign = F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit(""))
        number = F.when(digits == "", F.lit("0")).otherwise(F.concat(sign, digits))
        return F.when(text.rlike(_DECIMAL), number)

    text = col(value).cast("string")
    return F.when(text.rlike(_WHOLE), F.concat(text, F.lit("000000"))).otherwise(bind(text, shift))


def ms_number_to_ns(value: Column | str, kind: T.DataType) -> Column:
    """The same for a numeric column: integers stay exact; a double keeps the 14
    significant digits its text form has, and anything needing an exponent is null."""
    column = col(value)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        # 14 significant digits; numbers too large or small for that keep an exponent,
        # which the decimal grammar then turns away
        shown = F.regexp_replace(F.format_string("%.14g", column.cast("double")), r"(\.[0-9]*?)0+$", "$1")
        return F.when(column.isNotNull(), ms_to_ns(shown))
    return F.when(column == 0, F.lit("0")).when(column.isNotNull(), F.concat(column.cast("string"), F.lit("000000")))


def ns_to_seconds(value: Column | str) -> Column:
    """Nanosecond digits -> whole seconds as DECIMAL(38,0); null when not a time."""
    text = col(value)
    return F.when(
        text.rlike(r"^-?[0-9]{1,38}\z"),
        F.floor(text.try_cast("decimal(38,0)") / F.lit(1_000_000_000).cast("decimal(10,0)")).cast("decimal(38,0)"),
    )


def epoch_micros(value: Column | str) -> Column:
    """Microseconds since 1970 of a zone-less timestamp, whatever the session zone."""
    column = col(value)
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), column)
