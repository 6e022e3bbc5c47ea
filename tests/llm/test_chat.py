import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from linewise.llm.chat import Expansion, Flattener, digests, escape, escape_role, format_turns, read_turn, text_parts, unescape, unescape_role

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def make(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["<", "|", "\\", "<|im_end|>", "<|im_start|>", "a", "é😀", "\n", ">", "<|image:0|>"]) for _ in range(rng.randint(0, 8)))
    return [(rng.randint(0, 40), rng.choice([0, 1, 1, 2, None]), rng.choice(["user", "assistant", "assistant", "system", None, "a\nb", "<|x|>\\"]), rng.choice([word(), word(), None]), "x") for _ in range(300)]


def brute(rows):
    held = defaultdict(list)
    for conv, turn, role, text, _ in rows:
        said = f"<|im_start|>{escape_role(role or '')}\n{escape(text or '')}<|im_end|>\n"
        held[conv].append(((turn is not None, turn or 0), said, role or "", text or ""))
    out = {}
    for conv, turns in held.items():
        turns.sort(key=lambda t: (t[0], t[1].encode()))
        loss = "".join(text for _, _, role, text in turns if role == "assistant")
        every = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        out[conv] = (len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(len(t[1]) for t in turns))
    return out


def test_against_brute_force(spark):
    rows = make(3) + [(None, 1, "user", "no id", "x"), (77, 0, "assistant", "long " * 50_000, "x")]
    turns = spark.createDataFrame(rows, SCHEMA)
    got = digests(format_turns(turns, text_parts(F.col("text")))).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == brute(rows)
    assert digests(format_turns(turns.limit(0), text_parts(F.col("text")))).count() == 0


def test_escapes_are_reversible_and_hide_control_strings():
    rng = random.Random(1)
    for _ in range(3000):
        text = "".join(rng.choices("<|\\a\nn", k=rng.randint(0, 12)))
        assert unescape(escape(text)) == text and "<|" not in escape(text)
        assert unescape_role(escape_role(text)) == text and "\n" not in escape_role(text)


def test_parts_in_order_with_attachments(spark):
    part = lambda kind, **own: {"kind": kind, "text": None, "ref": None, "width": None, "height": None, "seconds": None, "pages": None, **own}
    parts = [part("text", text="see <"), part(None, text="|image:0|>"), part("image", ref="i.png", width=600, height=100), part("audio", ref="a.wav", seconds=2.0), part("text", text="and"), part("document", ref=None, pages=3), None]
    visitor = Flattener(Expansion())
    for p in parts:
        visitor.visit(p)
    content = visitor.content()
    assert content == "see <\\|image:0|><|image:0|><|audio:1|>and<|document:2|>"
    assert visitor.attachments == [(0, "image", "i.png", 85 + 2 * 170), (1, "audio", "a.wav", 50), (2, "document", None, 2250)]
    role, read = read_turn(f"<|im_start|>user\n{content}<|im_end|>\n")
    assert (role, read) == ("user", ["see <|image:0|>", ("image", 0), "", ("audio", 1), "and", ("document", 2), ""])
    from linewise.llm.chat import PARTS

    df = spark.createDataFrame([(1, 0, "assistant", parts), (1, 1, "user", None)], f"conv_id long, turn long, role string, parts {PARTS}")
    first, second = sorted(format_turns(df, F.col("parts")).collect(), key=lambda r: r.turn)
    assert first.n_expanded == 85 + 340 + 50 + 2250 and [a.kind for a in first.attachments] == ["image", "audio", "document"]
    assert first.formatted[first.loss_start : first.loss_end] == content
    assert second.formatted == "<|im_start|>user\n<|im_end|>\n" and second.loss_start is None and second.n_expanded == 0


def test_an_unknown_kind_is_an_error():
    with pytest.raises(ValueError):
        Flattener(Expansion()).visit({"kind": "video"})
