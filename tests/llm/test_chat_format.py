import hashlib
import random

import pytest
from pyspark.sql import functions as F

from gossamr.llm import chat_format
from gossamr.llm.chat_format import INSTRUCT, Marks, Template, check_order, format_turns, read_back

SCHEMA = "conv_id long, turn long, role string, text string"
#: What texts are made of: marks, parts of them, escapes, blanks.
BITS = [*INSTRUCT.marks, "<", ">", "[", "]", "/", "\\", "\\\\", "\n", " ", "S", "INST", "<s", "a", "é", "🎉", "[INST]", "</s>"]


def codes(role):
    return {"system": 0, "user": 1, "assistant": 2}.get(role, 3)


def escape(text):
    text = text.replace("\\", "\\\\")
    for m in INSTRUCT.marks:
        text = text.replace(m, m[0] + "\\" + m[1:])
    return text


def brute(rows):
    """The result of each conversation, from its turns in order."""
    by_conv, out = {}, {}
    for c, t, r, x in rows:
        by_conv.setdefault(c, []).append((t is not None, t or 0, codes(r or ""), r or "", escape(x or ""), x or "", t))
    for c, turns in by_conv.items():
        turns.sort(key=lambda x: x[:5])
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for *_, r, _, x, _ in turns).encode())
        trained = "".join(x for _, _, k, _, _, x, _ in turns if k == 2)
        marks = {0: 19, 1: 15, 2: 7}
        chars = sum(len(e) + (marks[k] if k < 3 else 20 + len(escape(r))) for _, _, k, r, e, _, _ in turns)
        state, bad = "start", []
        for _, _, k, r, _, _, t in turns:
            state = INSTRUCT.moves.get(state, {}).get(r if k < 3 else "*", "error")
            if state == "error":
                bad.append(t)
        out[c] = (len(turns), digest.hexdigest(), len(trained), hashlib.sha256(trained.encode()).hexdigest(), chars, state == "assistant", bad[0] if bad else None)
    return out


def result(turns, **options):
    formatted = format_turns(turns)
    order = {r.conv_id: (r.valid, r.bad_turn) for r in check_order(turns, **options).collect()}
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars, *order[r.conv_id]) for r in read_back(formatted).collect()}


def test_any_text_comes_back(spark):
    rng = random.Random(12)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", "[/ROLE]", "a\\", "", None]), None if rng.random() < 0.1 else "".join(rng.choices(BITS, k=rng.randint(0, 9)))) for c in range(120) for t in range(rng.randint(1, 6))]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df) == brute(rows)
    for row in format_turns(df).collect():
        for s, mark in zip(row.segments, (False, True, False), strict=True):
            assert not mark or not any(m in s.text for m in INSTRUCT.marks)


@pytest.mark.parametrize(("chunk", "fanout"), [(1, 2), (3, 2), (1024, 64)])
def test_machine_equals_one_step_after_the_other(spark, chunk, fanout):
    rng = random.Random(chunk)
    rows = []
    for c in range(60):
        roles = ["system"] * rng.randint(0, 1) + ["user", "assistant"] * rng.randint(0, 12)
        for _ in range(rng.randint(0, 1)):
            roles.insert(rng.randint(0, len(roles)), rng.choice(["user", "assistant", "system", "tool"]))
        rows += [(c, t, r, f"{c} {t}") for t, r in enumerate(roles)]
    rows += [(99, None, "system", "x"), (99, 0, "user", "x"), (99, 5, "assistant", "x"), (98, 3, "user", "y"), (98, 3, "user", "y"), (98, 3, "assistant", "y"), (None, 1, "user", "z"), (None, 1, "assistant", None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df, chunk=chunk, fanout=fanout) == brute(rows)


def test_one_turn_that_repeats_very_often(spark):
    turns = spark.range(300_000).select(F.lit(7).cast("long").alias("conv_id"), F.lit(0).cast("long").alias("turn"), F.lit("user").alias("role"), F.lit("x").alias("text"))
    toggle = Template(roles={"user": Marks("[U]", "[/U]")}, other=Marks("[O]", "[/O]"), named="[/N]", moves={"even": {"user": "odd"}, "odd": {"user": "even"}}, start="even", final=("even",))
    assert check_order(turns, toggle).collect()[0][1:3] == (300_000, True)
    assert check_order(turns.limit(299_999), toggle).collect()[0][1:3] == (299_999, False)
    assert check_order(turns).collect()[0][1:] == (300_000, False, 0)


def test_edges(spark):
    long = "word </s> \\ " * 40_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long), (2, None, None, None), (None, None, None, None), (3, 0, "user", ""), (3, 1, "assistant", "\x00\x1c﻿"), (4, 0, "user", " \n"), (4, 0, "user", " \n"), (4, 1, "assistant", " ")]
    df = spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA + ", segments string, n_turns int")
    assert result(df) == brute(rows)
    assert result(df.limit(0)) == {}


def test_templates_that_cannot_be_read_back_are_refused():
    def made(**marks):
        return Template(roles={"user": Marks(marks.get("open", "<u>"), marks.get("close", "</u>"))}, other=Marks("[O]", "[/O]"), named="[/N]", moves={}, start="s", final=())

    made()
    for wrong in ({"open": "<"}, {"open": "[O]"}, {"open": "<u\\>"}, {"open": "[O]x"}, {"open": "aa", "close": "ab"}):
        with pytest.raises(ValueError):
            made(**wrong)


def test_reader_refuses_what_no_template_made():
    for wrong in ([("[INST] a", False)], [("text", False)], [("</s>", False)], [("<s>", False), ("<s>", False), ("</s>", False)], [("[INST]a [/INST]", False)]):
        reader = chat_format.Reader()
        with pytest.raises(ValueError):
            for text, loss in wrong:
                reader.feed(text, loss)
            reader.end()


def test_reader_needs_no_turn_borders(spark):
    reader = chat_format.Reader()
    reader.feed("[INST] a [/INST]<s>", False)
    reader.feed("b", True)
    reader.feed("</s>[INST] c [/INST]", False)
    assert reader.end()[::2] == (3, 1, len("[INST] a [/INST]<s>b</s>[INST] c [/INST]"))
