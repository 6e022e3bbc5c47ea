"""Redaction vectors, run through the JVM chain, the column function and the walker."""

import json
import time
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linewise.functions.pii import Options, is_sensitive_key, key_marker, redact, redact_column, redact_json, redact_text
from linewise.functions.pii.keys import name_is_sensitive, name_marker
from linewise.functions.pii.leaf import redact_string
from linewise.functions.pii.options import DEFAULT
from linewise.functions.pii.rules import FAILED_MARKER
from linewise.functions.pii.text import native_chain, needs_python, register_sql

UUID = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"
STRINGS = {
    "contact alice@example.com for details": "contact [EMAIL_REDACTED] for details",
    "Authorization: Bearer abc.def.ghi": "Authorization: Bearer [TOKEN_REDACTED]",
    "card 4111-1111-1111-1111": "card [CARD_REDACTED]",
    "call me on +44 20 7946 0000 today": "call me on [PHONE_REDACTED] today",
    "client 192.168.1.42 connected": "client [IP_REDACTED] connected",
    "see https://example.com/path?token=abc&u=1": "see https://example.com/path?[QUERY_REDACTED]",
    "Bearer\u00a0abc.def": "Bearer [TOKEN_REDACTED]",
    "Bearer\u2028abc.def": "Bearer [TOKEN_REDACTED]",
    "password=hunter2\u00a0rest": "password=[PASSWORD_REDACTED]\u00a0rest",
    "card 4111\u00a01111\u00a01111\u00a01111": "card [CARD_REDACTED]",
    "https://h.test/p?q=1\u3000next": "https://h.test/p?[QUERY_REDACTED]\u3000next",
    "tel +44 \U0001d7d0\U0001d7ce 7946 0000 end": "tel [PHONE_REDACTED] end",
    "tel +44\u200b20\u00ad7946 0000 end": "tel [PHONE_REDACTED] end",
    "tel +44\u221220\u22127946\u22120000 end": "tel [PHONE_REDACTED] end",
    "\u2121 4155550132": "\u2121 [PHONE_REDACTED]",
    "line=\nphone +44 20 7946 0000": "line=\nphone [PHONE_REDACTED]",
    "phone" + "\u4e2d" * 9 + " 4155550132": "phone" + "\u4e2d" * 9 + " [PHONE_REDACTED]",
    "phone" + "\u4e2d" * 10 + " 4155550132": "phone" + "\u4e2d" * 10 + " 4155550132",
    "phone" + "\U0001f600" * 4 + " 4155550132": "phone" + "\U0001f600" * 4 + " [PHONE_REDACTED]",
    "phone" + "\U0001f600" * 5 + " 4155550132": "phone" + "\U0001f600" * 5 + " 4155550132",
    f"id={UUID}": f"id={UUID}",
    "": "",
    "hello world": "hello world",
    "see https://h.test/p?#frag": "see https://h.test/p?#frag",
    "see https://h.test/p?": "see https://h.test/p?",
    "see https://user@/p?q=1": "see https://user@/p?[QUERY_REDACTED]",
    "see https://h.test:99999/p?q=1": "see https://h.test:99999/p?[QUERY_REDACTED]",
    "[PHONE_REDACTED] 7946 0000 end": "[PHONE_REDACTED] end",
    "+44 20 7946 0000 200 ok": "[PHONE_REDACTED] 200 ok",
    "+1 415 555 0132 2024-01-02": "[PHONE_REDACTED] 2024-01-02",
    "tel +123456": "tel +123456",
    "0&nbsp;call +44&nbsp;20&nbsp;7946&nbsp;0000": "0&nbsp;call [PHONE_REDACTED]",
    '{"password": "x y", "a":1}': '{"password": "[PASSWORD_REDACTED]", "a":1}',
    "pwd:abc&next": "password=[PASSWORD_REDACTED]&next",
    "cvv = 123": "cvv=[CVV_REDACTED]",
    "x\\n4111 1111 1111 1111": "x\\n[CARD_REDACTED]",
    "x\\nfoo@bar.com": "x\\n[EMAIL_REDACTED]",
    "x\\\\nfoo@bar.com": "x\\\\[EMAIL_REDACTED]",
    "a@b.com_x@c.com": "[EMAIL_REDACTED][EMAIL_REDACTED]",
    "eyJabc.def.ghi": "[JWT_TOKEN_REDACTED]",
    "xeyJabc.def.ghi -eyJq.r.s": "xeyJabc.def.ghi -[JWT_TOKEN_REDACTED]",
    "ghp_" + "a" * 24: "[API_KEY_REDACTED]",
    "x_AKIA" + "A" * 16: "x_[API_KEY_REDACTED]",
    "key_0123456789ab": "[API_KEY_REDACTED]",
    "q" * 32: "[POTENTIAL_KEY_REDACTED]",
    "a+" * 20 + "b": "[ENCODED_KEY_REDACTED]",
    "2001:db8:0:0:0:0:0:1 up": "[IPV6_REDACTED] up",
    "https://u:p@h.test/a?x=1#f": "https://u:[EMAIL_REDACTED]/a?[QUERY_REDACTED]",
    "access_token=abc": "access_token=[TOKEN_REDACTED]",
    "https://api.example.com/v1/customers/orders/invoices/Zx9Qw8Er7Ty6Ui5Op4As/payments":
        "https://api.example.com/v1/customers/orders/invoices/[ENCODED_KEY_REDACTED]/payments",
}

SENSITIVE = """clientSecret SECRET|sessionKey KEY|session_key KEY|userPassword PASSWORD|refreshToken TOKEN|privateKey KEY|xApiKey KEY
accessToken TOKEN|secrets SECRET|passwords PASSWORD|apikeys KEY|tokens TOKEN|cookies COOKIE|socialSecurity SENSITIVE_DATA
creditCardNumber CARD|sessionId SESSION|session_id SESSION|api_key KEY|user_token TOKEN|x-api-key KEY|x-auth-token TOKEN|cvv CARD
cookie COOKIE|secretKey KEY|passwordHash PASSWORD|api_key_id KEY|api_keys KEY|accessTokens TOKEN|session_ids SESSION|creditCards CARD
private_keys KEY|credit_cardholder CARD|userPin SENSITIVE_DATA|serverCert SENSITIVE_DATA|tlsCertificate SENSITIVE_DATA|passwd SENSITIVE_DATA
oauthPwd PASSWORD|authBearer SENSITIVE_DATA|userSsn SENSITIVE_DATA|cardCvc CARD|publickey KEY|APIKeyId KEY|HTTPCookie COOKIE|session.id SESSION
auth.clientSecret SECRET|_sessionId SESSION|token_ TOKEN|SESSIONID SESSION|cvc SENSITIVE_DATA|access_tokens TOKEN|userSessions SESSION
serverCerts SENSITIVE_DATA|userPins SENSITIVE_DATA|api\u212aey KEY|coo\u212aie COOKIE|AP\u0130_KEY KEY|ap\u0130Keys KEY"""
READABLE = """sessionDuration tokenCount tokenExpiresAt sessionStartedAt keyboardLayout pinned certainty secretary cacheKey sortKey partitionKey
idempotencyKey reservationId cardId bookingReference certExpiryDays pinPosition session.duration ___ xapi_key secretsauce cookieValue tokensCount
foo\u212aPassword foo\u212aToken api\uff2bey \u017fecret AP\u0130_X_KEY""".split()


def test_strings_in_python():
    for text, want in STRINGS.items():
        assert redact_string(text, DEFAULT) == want, text


def test_strings_in_columns(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(STRINGS)], "i int, t string").repartition(2)
    rows = df.select("i", "t", redact_text("t").alias("out"), native_chain(F.col("t"), DEFAULT).alias("native"),
                     needs_python(F.col("t"), DEFAULT).alias("gate")).orderBy("i").collect()
    for row, want in zip(rows, STRINGS.values()):
        assert row.out == want, row.t
        assert row.gate or row.native == want, row.t


def test_redaction_in_sql(spark):
    register_sql(spark)
    spark.createDataFrame([(t,) for t in STRINGS] + [(None,)], "t string").createOrReplaceTempView("strings")
    assert {r.t: r.o for r in spark.sql("SELECT t, redact_text(t) AS o FROM strings").collect()} == {**STRINGS, None: None}


def test_rule_switches(spark):
    df = spark.createDataFrame([("a alice@example.com",), (f"id={UUID}",), (None,)], "t string")
    assert [r[0] for r in df.select(redact_text("t", Options(emails=False))).collect()] == ["a alice@example.com", f"id={UUID}", None]
    assert [r[0] for r in df.select(redact_text("t", Options(uuids=True))).collect()] == ["a [EMAIL_REDACTED]", "id=[ID]", None]


def test_names(spark):
    sensitive = [tuple(x.rsplit(" ", 1)) for line in SENSITIVE.split("\n") for x in line.split("|")]
    # the two non-ASCII letters part humps, so only some spellings count
    for name, marker in sensitive:
        if "\u212a" not in name and "\u0130" not in name:
            assert name_is_sensitive(name) and name_marker(name) == f"[{marker}_REDACTED]", name
    for name in READABLE + [""]:
        assert not name_is_sensitive(name), name
    names = [n for n, _ in sensitive] + READABLE + ["", "A" * 5000 + "_HTTPCookie"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string").orderBy("i")
    for row in df.select("n", is_sensitive_key("n"), key_marker("n")).collect():
        assert (row[1], row[2]) == (name_is_sensitive(row[0]), name_marker(row[0])), row[0]


def test_folded_names():
    for name in ("coo\u212aie", "AP\u0130_KEY", "coo\u212aies"):
        assert name_is_sensitive(name), name


def test_json_documents(spark):
    nested = {"auth": {"clientSecret": {"n": "v"}, "sessionKey": None, "passwordHash": False, "tokenCount": 7, "notes": "a@example.com"},
              "l": [1, "b@example.com", True, None], "+44 20 7946 0000": "sent", "+44 20 7946 0001": "failed", "__proto__": 1, "4111111111111111": "c"}
    df = spark.createDataFrame([(json.dumps(nested),), ("{broken",), (None,)], "j string")
    out = [r[0] for r in df.select(redact_json("j")).collect()]
    assert json.loads(out[0]) == {
        "auth": {"clientSecret": "[SECRET_REDACTED]", "sessionKey": "[KEY_REDACTED]", "passwordHash": "[PASSWORD_REDACTED]", "tokenCount": 7, "notes": "[EMAIL_REDACTED]"},
        "l": [1, "[EMAIL_REDACTED]", True, None], "[PHONE_REDACTED]": "sent", "[PHONE_REDACTED]#2": "failed", "[CARD_REDACTED]": "c"}
    assert out[1:] == ['"[REDACTION_FAILED]"', None]
    dropped = json.loads(df.select(redact_json("j", Options(preserve_structure=False, emails=False))).first()[0])
    assert dropped["auth"] == {"tokenCount": 7, "notes": "a@example.com"}


def test_nested_columns(spark):
    schema = """id int, apiKey string, s struct<email:string,password:int,inner:struct<token:string,note:string>>, a array<string>,
                m map<string,string>, list array<struct<pin:string,text:string>>"""
    rows = [(1, "k", ("a@b.com", 5, ("t", "cvv=123")), ["x@y.org", None, "+44 20 7946 0000"], {"apiKey": "q", "note": "a@b.com"}, [("1", "z@z.org")]),
            (2, None, None, None, {"+44 20 7946 0000": "sent", "+44 20 7946 0001": "failed"}, [("1", "call +44 20 7946 0000")])]
    out = redact(spark.createDataFrame(rows, schema)).orderBy("id").collect()
    assert out[0].asDict(True) == {
        "id": 1, "apiKey": "[KEY_REDACTED]", "s": {"email": "[EMAIL_REDACTED]", "password": "[PASSWORD_REDACTED]", "inner": {"token": "[TOKEN_REDACTED]", "note": "cvv=[CVV_REDACTED]"}},
        "a": ["[EMAIL_REDACTED]", None, "[PHONE_REDACTED]"], "m": {"apiKey": "[KEY_REDACTED]", "note": "[EMAIL_REDACTED]"},
        "list": [{"pin": "[SENSITIVE_DATA_REDACTED]", "text": "[EMAIL_REDACTED]"}]}
    assert out[1].m == {"[PHONE_REDACTED]": "sent", "[PHONE_REDACTED]#2": "failed"} and out[1].list[0].text == "call [PHONE_REDACTED]"
    dropped = redact(spark.createDataFrame(rows, schema), options=Options(preserve_structure=False))
    assert dropped.columns == ["id", "s", "a", "m", "list"] and "password" not in dropped.schema["s"].dataType.fieldNames()


def test_sensitive_names_hide_values_of_any_type(spark):
    """Half of the rows hold a phone number; nothing else may differ between the halves."""
    schema = """id int, m map<string,int>, b map<string,boolean>, a map<string,array<string>>, s map<string,struct<x:string,y:double>>, mm map<string,map<string,int>>,
                l array<map<string,array<string>>>, k map<int,string>, t struct<note:string,at:timestamp,d:decimal(20,6),n:map<string,int>,i:map<int,double>>"""
    at = datetime(2024, 1, 2, 3, 4, 5, 123456)

    def row(key, note):
        return (key, {"pin": 1234, "n": 7}, {"token": True, "ok": False}, {"password": ["hunter2"], "x": ["a@b.com", None]}, {"accessToken": ("opaque", 1.5), "o": ("a@b.com", 2.5)},
                {"secret": {"q": 1}, "z": {"pin": 2, "q": 3}}, [{"apiKey": ["k"], "w": ["v"]}, None], {5: "a@b.com", 6: None}, (note, at, Decimal("1.500000"), {"pin": 9, "n": 1}, {1: 2.0}))

    df = spark.createDataFrame([row(1, "fine"), row(2, "call +44 20 7946 0000"), (3, *[None] * 8)], schema)
    first, second, none = redact(df).orderBy("id").collect()
    assert first.asDict(True) | {"id": 0, "t": 0} == second.asDict(True) | {"id": 0, "t": 0}
    assert first.m == {"pin": "[SENSITIVE_DATA_REDACTED]", "n": "7"} and first.b == {"token": "[TOKEN_REDACTED]", "ok": "false"}
    assert first.a == {"password": "[PASSWORD_REDACTED]", "x": '["[EMAIL_REDACTED]",null]'}
    assert first.s == {"accessToken": "[TOKEN_REDACTED]", "o": '{"x":"[EMAIL_REDACTED]","y":2.5}'}
    assert first.mm == {"secret": "[SECRET_REDACTED]", "z": '{"pin":"[SENSITIVE_DATA_REDACTED]","q":"3"}'}
    assert first.l == [{"apiKey": "[KEY_REDACTED]", "w": '["v"]'}, None] and first.k == {5: "[EMAIL_REDACTED]", 6: None}
    for got, note in ((first, "fine"), (second, "call [PHONE_REDACTED]")):
        assert got.t.asDict(True) == {"note": note, "at": at, "d": Decimal("1.500000"), "n": {"pin": "[SENSITIVE_DATA_REDACTED]", "n": "1"}, "i": {1: 2.0}}
    assert all(v is None for k, v in none.asDict().items() if k != "id")
    kept = redact(df, options=Options(preserve_structure=False))
    assert kept.schema["m"].dataType == df.schema["m"].dataType and kept.orderBy("id").first().m == {"n": 7}


def test_json_numbers_and_repeated_names(spark):
    df = spark.createDataFrame([('{"a":1.50,"b":1e400,"a":2,"l":[-0.0,1E+2]}',), ('{"a":NaN}',), ("[Infinity]",), (' {"x" : true} ',)], "j string")
    assert [r[0] for r in df.select(redact_json("j")).collect()] == ['{"a":1.50,"b":1e400,"a#2":2,"l":[-0.0,1E+2]}', '"[REDACTION_FAILED]"', '"[REDACTION_FAILED]"', '{"x":true}']


# shapes that have made rules like these slow elsewhere
SHAPES = ["a.", "1.2.", "password=", "0000-", "eyJ-", "eyJa.", "eyJa.b-", "_", "-", "_-", "a", "a/", "1 ", "+1 ", "7", "[PHONE_REDACTED] 1 ",
          "\uff10 ", "0\u00a0", "0&nbsp;", "@ ", "Bearer ", "access_token=", "key_", "x_ghp_", "AKIA", "4111 ", "1.1.1.", "3f2b8c1e-", "https://a",
          '"password":"', "call ", "\\n4111 ", "\\neyJa.", "+44 20 7946 0000 200 ", "\\u00e9", ' 0a@.-+%\\" _eyJ', "a." * 100 + "@", "&", "a=1&",
          "://", "x://a@", "\u00a0", "\u200b", "AaAaAaAaAaAaAaAaAaAaAaAaAaAaXbc/", "api/v1/customers/orders/", "pwd:", '{"id":1,"name":"item1"},']


def _timed(action):
    began = time.perf_counter()
    action()
    return time.perf_counter() - began


def _texts(size):
    return [(u * (size // len(u) + 1))[:size] for u in SHAPES] + ["a." * (size // 2) + "@", "a." * (size // 4) + "@" + "a." * (size // 4)]


def test_growth_is_linear_in_python():
    for small, large in zip(_texts(60_000), _texts(480_000)):
        base = _timed(lambda: redact_string(small, DEFAULT))
        spent = _timed(lambda: redact_string(large, DEFAULT))
        assert spent <= max(24 * max(base, 0.008), 2.0), (small[:20], base, spent)


def test_megabyte_shapes_in_the_jvm(spark):
    df = spark.createDataFrame([(t,) for t in _texts(1_000_000)], "t string").repartition(4).cache()
    assert df.count() == len(SHAPES) + 2
    spent = _timed(lambda: df.select(F.length(native_chain(F.col("t"), DEFAULT)), needs_python(F.col("t"), DEFAULT)).collect())
    df.unpersist()
    assert spent < 2.0 * len(SHAPES)


def test_sql_function_is_planned_in_the_jvm(spark):
    register_sql(spark, "redact_plain", Options(phones=False, api_keys=False))
    register_sql(spark, "redact_whole")
    texts = ["mail a@b.co now", "call (415) 555-2671", "it's a \\ 'quote' 10.0.0.1", None, "", "Bearer abcdefghijklmnopqrstuvwxyz0123456789", "a/b " * 20 + "é" * 3]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    df.createOrReplaceTempView("sql_texts")
    plain = spark.sql("SELECT k, redact_plain(t) AS t FROM sql_texts")
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()
    want = {r.k: r.t for r in df.select("k", redact_text("t", Options(phones=False, api_keys=False)).alias("t")).collect()}
    assert {r.k: r.t for r in plain.collect()} == want
    want = {k: None if t is None else redact_string(t, DEFAULT) for k, t in enumerate(texts)}
    assert {r.k: r.t for r in spark.sql("SELECT k, redact_whole(t) AS t FROM sql_texts").collect()} == want


def test_a_text_a_rule_cannot_finish_is_given_up_alone(spark):
    hurried = Options(long_bytes=50_000, rule_seconds=1e-9)
    long, texts = "a@b.co " * 20_000, ["a@b.co", "plain", "call (415) 555-2671"]
    rows = spark.createDataFrame([(0, long), *enumerate(texts, 1), (9, None)], "k int, t string")
    got = {r.k: r.t for r in rows.select("k", redact_text("t", hurried).alias("t")).collect()}
    assert got[0] == FAILED_MARKER and got[1] == "[EMAIL_REDACTED]" and got[2] == "plain" and got[9] is None
    nested = rows.select("k", redact_column(F.array("t"), T.ArrayType(T.StringType()), hurried)[0].alias("t"))
    assert {r.k: r.t for r in nested.filter("k < 3").collect()} == {0: FAILED_MARKER, 1: "[EMAIL_REDACTED]", 2: "plain"}
    patient = rows.filter("k = 0").select(redact_text("t", Options(long_bytes=50_000)).alias("t")).first().t
    assert patient == "[EMAIL_REDACTED] " * 20_000
