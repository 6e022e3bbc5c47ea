"""Keyed partner references."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..wire import REFERENCE_SCHEME
from . import bind, col

_BLOCK_BYTES = 64
_WORD = 14  # hex digits of seven bytes, which a bigint holds


def _masked(hex_key: Column, byte: int) -> Column:
    """Every byte of a hex key XORed with one constant, as hex, seven bytes at a time. Most of
    a key is its padding, whose result is known."""

    def word(at: int, digits: int) -> Column:
        part, mask = F.substring(hex_key, at, digits), f"{byte:02x}" * (digits // 2)
        value = F.conv(part, 16, 10).cast("bigint").bitwiseXOR(F.lit(int(mask, 16)))
        return F.when(part == "0" * digits, mask).otherwise(F.lpad(F.hex(value), digits, "0"))

    return F.concat(*[word(at + 1, min(_WORD, 2 * _BLOCK_BYTES - at)) for at in range(0, 2 * _BLOCK_BYTES, _WORD)])


def hmac_sha256_hex(token: Column | str, message: Column | str) -> Column:
    """HMAC-SHA256 as lower-case hex. The key is a column, so no form of it is ever a
    literal of the plan."""
    key_text = col(token)
    text = col(message)
    utf8 = F.encode(key_text, "UTF-8")
    short = F.when(F.octet_length(key_text) > _BLOCK_BYTES, F.sha2(utf8, 256)).otherwise(F.lower(F.hex(utf8)))

    def digest(key: Column) -> Column:
        inner = F.sha2(F.unhex(F.concat(_masked(key, 0x36), F.hex(F.encode(text, "UTF-8")))), 256)
        return F.sha2(F.unhex(F.concat(_masked(key, 0x5C), inner)), 256)

    return bind(F.rpad(short, 2 * _BLOCK_BYTES, "0"), digest)


def partner_ref(token: Column | str, app_key: Column | str) -> Column:
    """The reference a line names its partner by; token and key are used as given."""
    app = col(app_key)
    return F.concat(F.lit(REFERENCE_SCHEME), hmac_sha256_hex(token, F.sha2(F.encode(app, "UTF-8"), 256)))
