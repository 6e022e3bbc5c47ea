"""Redaction of a string column."""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from ...session import ship_package
from .. import bind, col
from .leaf import redact_string
from .options import DEFAULT, Options
from .rules import ENCODED_SCREEN, FOLDABLE, LONG_RUN, MIN_NUMBERISH, NBSP_ENTITY, NUMBERISH, PHONE_MARKER, PHONE_SCREEN, RULES


def native_chain(value: Column, options: Options, names: bool = False, share: bool = True) -> Column:
    """The rules as one JVM expression. Each is a regular expression behind a search for
    a text it needs, which is far cheaper and usually fails. Only the phone rule is left
    out, and encoded runs count as whole: ``needs_python`` finds the texts where that
    would differ.

    ``share`` makes the two costly tests once for all rules. Inside another lambda, where
    the texts are short, that is left off: a Python function whose argument holds lambdas
    that refer to outer lambdas is not planned right."""

    rules = [r for r in RULES if r.special != "phone" and getattr(options, r.group) and (r.in_names or not names)]

    def has_any(text: Column, needs) -> Column:
        return reduce(or_, [F.contains(text, F.lit(n)) for n in needs])

    def run(text: Column, any_case: Column, long_run: Column) -> Column:
        def step(rule):
            def apply(v: Column) -> Column:
                worth = []
                if rule.screen == LONG_RUN:
                    there = v.rlike(LONG_RUN) if long_run is None else long_run
                    return F.when(there, F.regexp_replace(v, rule.pattern, rule.replacement)).otherwise(v)
                if rule.needs:
                    worth.append(any_case & has_any(F.lower(v), rule.needs) if rule.caseless else has_any(v, rule.needs))
                if rule.screen:
                    worth.append(v.rlike(rule.screen))
                replaced = F.regexp_replace(v, rule.pattern, rule.replacement)
                return F.when(reduce(and_, worth), replaced).otherwise(v) if worth else replaced

            return apply

        for rule in rules:
            text = bind(text, step(rule))
        return text

    # one lower-case pass tells whether any rule that ignores case has a chance; no
    # replacement brings in a word that was not there
    caseless = sorted({n for r in rules if r.caseless for n in r.needs})
    any_case = has_any(F.lower(value), caseless) if caseless else F.lit(False)
    if not share:
        return run(value, F.lit(True), None)
    # a run of 32 needs a word that long; markers bring in none
    long_word = F.exists(F.split(value, " "), lambda w: F.octet_length(w) >= 32) if any(r.screen == LONG_RUN for r in rules) else F.lit(False)
    long_run = long_word & value.rlike(LONG_RUN)
    return bind(any_case, lambda a: bind(long_run, lambda b: run(value, a, b)))


def needs_python(value: Column, options: Options, names: bool = False) -> Column:
    """Whether the text may hold a phone number, or an encoded run with a slash, or is so long
    that a rule needs a time limit. The cheap tests come first; most texts stop at the count of digits."""
    out = F.octet_length(value) >= options.long_bytes if options.phones or options.api_keys else F.lit(False)
    if options.phones:
        accented = (F.octet_length(value) != F.char_length(value)) & value.rlike(FOLDABLE)
        entity = F.contains(value, F.lit("&")) & value.rlike(f"(?i){NBSP_ENTITY}")
        soft = F.contains(value, F.lit("=\n")) | F.contains(value, F.lit("=\r\n"))
        digits = F.regexp_count(value, F.lit(NUMBERISH)) >= MIN_NUMBERISH
        out = out | F.contains(value, F.lit(PHONE_MARKER)) | (digits & (value.rlike(PHONE_SCREEN) | accented | soft | entity))
    if options.api_keys and not names:
        out = out | (F.contains(value, F.lit("/")) & value.rlike(ENCODED_SCREEN))
    return F.coalesce(out, F.lit(False))


def _text_udf(options: Options, names: bool):
    ship_package()

    @F.pandas_udf("string")
    def redact_some(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None or t is pd.NA or t != t else redact_string(t, options, names) for t in texts], dtype=object)

    return redact_some


def redact_text(value: Column | str, options: Options = DEFAULT, names: bool = False) -> Column:
    """A string column redacted. Rows whose text needs it cross to Python, Arrow batch by
    batch, and run every rule there; all others stay in the JVM (a null crosses for
    them, since Spark runs a Python function on every row it is asked for)."""
    text = col(value)
    if not (options.phones or (options.api_keys and not names)):
        return native_chain(text, options, names)
    gate = needs_python(text, options, names)
    return F.when(gate, _text_udf(options, names)(F.when(gate, text))).otherwise(native_chain(text, options, names))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def chain_sql(value: str, options: Options, names: bool = False) -> str:
    """``native_chain`` as SQL text: each rule binds the text once, so the text of the
    function grows by a rule's length for each rule."""
    any_of = lambda text, needs: "(" + " OR ".join(f"contains({text}, {_quoted(n)})" for n in needs) + ")"
    for rule in RULES:
        if rule.special == "phone" or not getattr(options, rule.group) or (names and not rule.in_names):
            continue
        worth = []
        if rule.needs:
            worth.append(any_of("lower(x)" if rule.caseless else "x", rule.needs))
        if rule.screen:
            worth.append(f"x RLIKE {_quoted(rule.screen)}")
        replaced = f"regexp_replace(x, {_quoted(rule.pattern)}, {_quoted(rule.replacement)})"
        step = f"CASE WHEN {' AND '.join(worth)} THEN {replaced} ELSE x END" if worth else replaced
        value = f"transform(array({value}), x -> {step})[0]"
    return value


def needs_python_sql(value: str, options: Options) -> str:
    """``needs_python`` as SQL text."""
    tests = [f"octet_length(x) >= {options.long_bytes}"] if options.phones or options.api_keys else []
    if options.phones:
        numberish = f"regexp_count(x, {_quoted(NUMBERISH)}) >= {MIN_NUMBERISH}"
        accented = f"octet_length(x) <> char_length(x) AND x RLIKE {_quoted(FOLDABLE)}"
        entity = f"contains(x, '&') AND x RLIKE {_quoted(f'(?i){NBSP_ENTITY}')}"
        soft = "contains(x, '=\\n') OR contains(x, '=\\r\\n')"
        tests += [f"contains(x, {_quoted(PHONE_MARKER)})", f"({numberish}) AND (x RLIKE {_quoted(PHONE_SCREEN)} OR ({accented}) OR ({soft}) OR ({entity}))"]
    if options.api_keys:
        tests.append(f"contains(x, '/') AND x RLIKE {_quoted(ENCODED_SCREEN)}")
    body = " OR ".join(f"({t})" for t in tests) or "false"
    return f"transform(array({value}), x -> coalesce({body}, false))[0]"


def register_sql(spark: SparkSession, name: str = "redact_text", options: Options = DEFAULT) -> None:
    """Makes ``name(text)`` callable from ``spark.sql``: a SQL function whose body is the rules, so
    that they are planned, and run in the JVM, like any expression. Texts that need Python cross to
    it alone; with options that need none there is no Python in the plan."""
    body = chain_sql("text", options)
    if options.phones or options.api_keys:
        leaf = f"{name}_by_python"
        spark.udf.register(leaf, _text_udf(options, False))
        gate = needs_python_sql("text", options)
        body = f"CASE WHEN {gate} THEN {leaf}(CASE WHEN {gate} THEN text END) ELSE {body} END"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(text STRING) RETURNS STRING RETURN {body}")
