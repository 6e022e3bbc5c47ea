"""One upstream call: its URL, its checked and capped fields, its JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import wire
from . import bind, col
from .jsontext import number, quoted, record_text

# --- fixed value: the white space a call's text fields are trimmed of ----------
TRIM_SPACE = (
    "\u0009\u000A\u000B\u000C\u000D\u0020\u00A0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200A"
    "\u2028\u2029\u202F\u205F\u3000\uFEFF"
)

CALL_FIELDS = ("name", "method", "url", "status", "durationMs", "requestId", "errorCode", "message", "attempt")


def without_space(text: Column) -> Column:
    """Text whose blanks are off already without other surrounding white space; null when nothing is left.
    Text that begins and ends with a visible ASCII character is not searched for it."""
    done = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
    return F.when(done, text).otherwise(F.nullif(F.btrim(text, F.lit(TRIM_SPACE)), F.lit("")))


def trimmed(value: Column | str) -> Column:
    """Text without surrounding white space; null when nothing is left."""
    return bind(F.trim(col(value)), without_space)


def cut(value: Column | str, limit: int) -> Column:
    """At most ``limit`` UTF-16 units, never half of a pair.

    Text with no character outside the basic plane is a plain ``left``; only other
    text is measured character by character, and only its first ``limit``.
    """

    def shorten(text: Column) -> Column:
        head = F.left(text, F.lit(limit))
        wide = F.regexp_count(head, F.lit(r"[\x{10000}-\x{10FFFF}]"))
        chars = F.filter(F.split(head, ""), lambda c: c != "")
        kept = F.aggregate(
            chars,
            F.struct(F.lit("").alias("out"), F.lit(0).alias("units"), F.lit(True).alias("open")),
            lambda acc, c: bind(
                acc["units"] + F.when(F.octet_length(c) == 4, 2).otherwise(1),
                lambda units: F.when(
                    acc["open"] & (units <= limit),
                    F.struct(F.concat(acc["out"], c).alias("out"), units.alias("units"), F.lit(True).alias("open")),
                ).otherwise(F.struct(acc["out"].alias("out"), acc["units"].alias("units"), F.lit(False).alias("open"))),
            ),
        )["out"]
        return F.when(wide == 0, head).otherwise(kept)

    # no more bytes than the limit means no more units
    return F.when(F.octet_length(col(value)) <= limit, col(value)).otherwise(bind(col(value), shorten))


def strip_url(value: Column | str) -> Column:
    """The URL without query, fragment and userinfo, otherwise as written."""
    base = F.substring_index(F.substring_index(col(value), "?", 1), "#", 1)
    # the userinfo ends at the last @ before the first slash after the first ://
    bare = F.regexp_replace(base, r"(?s)^((?>.*?://))(?>[^/]*@)", "$1")
    return F.when(F.contains(base, F.lit("@")), bare).otherwise(base)


def scrub_message(message: Column | str, url: Column | str) -> Column:
    """A transport message with the full URL replaced by the stripped one."""
    text, address = col(message), col(url)
    return F.when(F.coalesce(address, F.lit("")) != "", F.replace(text, address, strip_url(address))).otherwise(text)


def pick_request_id(headers: Column | str, extra: tuple[str, ...] = ()) -> Column:
    """The first header that is not blank, in order of preference, any case."""

    def chosen(lower: Column) -> Column:
        names = [*(n.lower() for n in extra), *wire.REQUEST_ID_HEADERS]
        return F.coalesce(*(F.nullif(F.btrim(F.try_element_at(lower, F.lit(n))), F.lit("")) for n in names))

    pairs = F.transform(
        F.map_entries(col(headers)), lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )
    # two spellings of one name: the first given stays
    first = F.filter(
        F.transform(pairs, lambda e, i: F.struct(e["key"].alias("key"), e["value"].alias("value"), i.alias("at"))),
        lambda e: F.array_position(F.transform(pairs, lambda p: p["key"]), e["key"]) == e["at"] + 1,
    )
    as_map = F.map_from_entries(F.transform(first, lambda e: F.struct(e["key"], e["value"])))
    return bind(as_map, chosen)


def error_code(errno: Column | str, error_class: Column | str) -> Column:
    """A known transport error's name, else the short class name."""
    known = F.create_map(*[F.lit(x) for pair in wire.CURL_ERROR_NAMES.items() for x in pair])
    short = F.nullif(F.substring_index(col(error_class), "\\", -1), F.lit(""))
    return F.coalesce(F.try_element_at(known, col(errno).cast("int")), short, F.lit("UnknownError"))


def outcome(
    status: Column, errno: Column, error_class: Column, message: Column, url: Column
) -> tuple[Column, Column, Column]:
    """(status, errorCode, message) of a finished call: an HTTP answer keeps only its
    status, a transport failure only its code and scrubbed message."""
    answered = status.isNotNull()
    return (
        status,
        F.when(~answered, error_code(errno, error_class)),
        F.when(~answered, scrub_message(message, url)),
    )


def duration_ms(started: Column | str, ended: Column | str) -> Column:
    """Whole milliseconds between two clock readings, never negative."""
    return F.round(F.greatest(F.lit(0.0), col(ended) - col(started)))


def reject_reason(
    name: Column | str, method: Column | str, url: Column | str, status: Column | str, duration: Column | str
) -> Column:
    """Why a call is not recorded; null for a good one. ``status`` is a double, null
    for a call without an answer."""
    n, m, u = col(name), col(method), col(url)
    s, d = col(status), col(duration)
    # by patterns that pass over the white space: trimmed text would be made again for each use of it
    blank = lambda text: ~F.coalesce(text.rlike(rf"[!-~]|[^{TRIM_SPACE}]"), F.lit(False))
    word = "[A-Za-z][A-Za-z_-]*+"
    longest = wire.CALL_LIMITS["method"]
    low, high = 100, 599
    bad_status = (s != 0) & (F.isnan(s) | (s != F.floor(s)) | (s < low) | (s > high))
    bad_duration = d.isNull() | F.isnan(d) | (d < 0) | (d == float("inf"))
    return (
        F.when(blank(n), "`name` must be a non-empty string")
        .when(blank(m), "`method` must be a non-empty string")
        .when((F.octet_length(m) > longest) & (F.octet_length(trimmed(m)) > longest), "`method` must be at most 16 characters")
        .when(~m.rlike(rf"\A(?:{word}\z|[{TRIM_SPACE}]*+{word}[{TRIM_SPACE}]*+\z)"), "`method` must be an HTTP method (letters, `-`, `_`)")
        .when(blank(u), "`url` must be a non-empty string")
        .when(
            F.coalesce(bad_status, F.lit(False)),
            "`status` must be an HTTP status (100–599), or omitted for a network error",
        )
        .when(bad_duration, "`durationMs` must be a finite, non-negative number")
    )


def normalised(
    name: Column | str,
    method: Column | str,
    url: Column | str,
    status: Column | str,
    duration: Column | str,
    request_id: Column | str,
    code: Column | str,
    message: Column | str,
    attempt: Column | str,
) -> Column:
    """The call as it is shipped: trimmed, capped, URL stripped; optional fields that
    cannot be used are null."""
    texts = (trimmed(name), trimmed(method), strip_url(trimmed(url)), trimmed(request_id), trimmed(code))
    return normalised_of_trimmed(*texts, status, duration, message, attempt)


def normalised_of_trimmed(
    name: Column, method: Column, bare_url: Column, rid: Column, code: Column,
    status: Column | str, duration: Column | str, message: Column | str, attempt: Column | str,
) -> Column:
    """``normalised`` of texts that are ``trimmed`` already, the URL also stripped."""
    limits = wire.CALL_LIMITS
    s, a = col(status), col(attempt)
    usable_id = (F.octet_length(rid) <= limits["requestId"]) & rid.rlike(r"^[\x21-\x7E]+\z")
    return F.struct(
        cut(name, limits["name"]).alias("name"),
        method.alias("method"),
        cut(bare_url, limits["url"]).alias("url"),
        F.when(s != 0, s.cast("int")).alias("status"),
        col(duration).cast("double").alias("durationMs"),
        F.when(usable_id, rid).alias("requestId"),
        cut(code, limits["errorCode"]).alias("errorCode"),
        cut(F.nullif(col(message), F.lit("")), limits["message"]).alias("message"),
        F.when((a == F.floor(a)) & a.between(0, wire.MAX_ATTEMPT), a.cast("int")).alias("attempt"),
    )


def call_json(call: Column) -> Column:
    """One call as JSON, keys in shipping order, absent fields left out."""
    text = record_text(
        [
            ("name", quoted(call["name"])),
            ("method", quoted(call["method"])),
            ("url", quoted(call["url"])),
            ("status", call["status"]),
            ("durationMs", number(call["durationMs"])),
            ("requestId", quoted(call["requestId"])),
            ("errorCode", quoted(call["errorCode"])),
            ("message", quoted(call["message"])),
            ("attempt", call["attempt"]),
        ]
    )
    return F.when(call.isNotNull(), text)
