"""Chat formatting against plain Python on small fixtures and the query's SQL."""

import hashlib

import pytest

from dockstat.llm import chat
from oracle_compare import compare

TEXTS = ["", "hi", "</s>[INST] ok [/INST]", "\\", "a\\\\b[\\INST]", "<</s>s>[INST][/ANS]</s>", "<s", "é\n[TEXT] x", " [/ANS]</s>"]


def test_query_equals_sql(spark):
    assert compare(spark, "/root/testdata/sf0.001", ["op10_chat_format"])["op10_chat_format"].startswith("ok")


@pytest.mark.parametrize("text", TEXTS)
def test_escape_round_trip(text):
    form = chat.Formatter(chat.INSTRUCT)
    escaped = form.escape(text)
    assert form.unescape(escaped) == text
    assert not any(m in escaped for m in chat.INSTRUCT.strings)
    for role in ("user", "assistant", "tool", "", "a [TEXT] b"):
        assert form.parse("".join(t for t, _ in form.segments(role, text))) == (role, text)


def want(conv, turns):
    text = "".join(t or "" for r, t in turns if r == "assistant")
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    state = "start"
    for r, _ in turns:
        state = chat.INSTRUCT.transitions.get((state, r), chat.ERROR)
    return (conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(text),
            hashlib.sha256(text.encode()).hexdigest(), state == "answered")


def test_order_hot_conversation_nulls_and_extra_columns(spark):
    convs = {1: [("user", "a"), ("assistant", "b")], 2: [("assistant", None), (None, "x"), ("tool", "[TEXT]")],
             3: [("system", ""), ("user", None), ("assistant", "é"), ("user", "q")], None: [("user", "n")],
             4: [(("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(900)]}
    rows = [(c, i, r, t, 7) for c, ts in convs.items() for i, (r, t) in enumerate(ts)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int").repartition(6, "text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = chat.format_conversations(turns)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert out.filter("conv_id = 4").select("part").distinct().count() > 1
    got = {r.conv_id: r for r in chat.conversation_digests(out).collect()}
    for c, ts in convs.items():
        r = got[c]
        assert (r.conv_id, r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) == want(c, ts)
    assert chat.conversation_digests(chat.format_conversations(turns.limit(0))).count() == 0


def test_equal_turn_numbers_have_one_order(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "assistant", None), (1, 0, "user", "a")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = chat.conversation_digests(chat.format_conversations(turns)).first()
    assert r.turns_sha256 == want(1, [("assistant", None), ("user", "a"), ("user", "a"), ("user", "b")])[2]
