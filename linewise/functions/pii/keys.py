"""Field names: which hold secrets, and the marker that replaces their value."""

from __future__ import annotations

from functools import lru_cache

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import bind, col

# --- fixed values: sensitive words -------------------------------------------------
# a word of a name, or its plural, anywhere
TERMS = (
    "password", "passwd", "pwd", "secret", "apikey", "accesstoken", "refreshtoken", "privatekey", "publickey",
    "certificate", "ssn", "creditcard", "cvv", "cvc", "bearer", "sessionid",
)
# neighbouring words; the last one may go on
RUNS = (
    "api_key", "access_token", "refresh_token", "private_key", "public_key", "session_key", "session_id",
    "social_security", "credit_card", "x_auth_token",
)
# the last word of a name, or its plural
HEAD_NOUNS = ("token", "session", "cookie", "cert", "pin")
# what the value becomes: the first entry whose word occurs in the name
KEY_MARKERS = (
    (("email",), "[EMAIL_REDACTED]"),
    (("password", "pwd"), "[PASSWORD_REDACTED]"),
    (("token",), "[TOKEN_REDACTED]"),
    (("key",), "[KEY_REDACTED]"),
    (("secret",), "[SECRET_REDACTED]"),
    (("phone",), "[PHONE_REDACTED]"),
    (("card", "cvv"), "[CARD_REDACTED]"),
    (("session",), "[SESSION_REDACTED]"),
    (("cookie",), "[COOKIE_REDACTED]"),
)
OTHER_KEY_MARKER = "[SENSITIVE_DATA_REDACTED]"
DROPPED_NAME = "__proto__"

# A name is read as _word_word_: camel humps, acronyms and anything not a letter or
# digit part words.
_HUMP = r"([a-z0-9])([A-Z])"
_ACRONYM = r"([A-Z])(?=[A-Z][a-z])"
_SENSITIVE = rf"_(?:{'|'.join(TERMS)})s?_|_(?:{'|'.join(RUNS)})|_(?:{'|'.join(HEAD_NOUNS)})s?_$"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ\u212A"  # and the two signs whose lower case is ASCII
_LOWER = "abcdefghijklmnopqrstuvwxyzk"
_DOTTED_I = ("\u0130", "i\u0307")


def _lower_column(name: Column) -> Column:
    return F.replace(F.translate(name, _UPPER, _LOWER), F.lit(_DOTTED_I[0]), F.lit(_DOTTED_I[1]))


def is_sensitive_key(name: Column | str) -> Column:
    humps = F.regexp_replace(F.regexp_replace(col(name), _HUMP, "$1_$2"), _ACRONYM, "$1_")
    words = F.regexp_replace(F.concat(F.lit("_"), _lower_column(humps), F.lit("_")), r"[^a-z0-9]++", "_")
    return words.rlike(_SENSITIVE)


def key_marker(name: Column | str) -> Column:
    def marker(lower: Column) -> Column:
        out = None
        for words, text in KEY_MARKERS:
            hit = F.contains(lower, F.lit(words[0]))
            for word in words[1:]:
                hit = hit | F.contains(lower, F.lit(word))
            out = F.when(hit, text) if out is None else out.when(hit, text)
        return out.otherwise(OTHER_KEY_MARKER)

    return bind(_lower_column(col(name)), marker)


# the same two answers for names known on the driver (struct fields) or met in JSON
_TO_LOWER = {ord(u): l for u, l in zip(_UPPER, _LOWER)} | {ord(_DOTTED_I[0]): _DOTTED_I[1]}
_hump, _acronym = regex.compile(_HUMP), regex.compile(_ACRONYM)
_parting, _sensitive = regex.compile(r"[^a-z0-9]++"), regex.compile(_SENSITIVE)


@lru_cache(maxsize=65536)
def name_is_sensitive(name: str) -> bool:
    humps = _acronym.sub(r"\1_", _hump.sub(r"\1_\2", name))
    return _sensitive.search(_parting.sub("_", f"_{humps.translate(_TO_LOWER)}_")) is not None


def name_marker(name: str) -> str:
    lower = name.translate(_TO_LOWER)
    return next((text for words, text in KEY_MARKERS if any(w in lower for w in words)), OTHER_KEY_MARKER)
