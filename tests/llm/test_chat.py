"""Chat formatting: exact round trips, turn order, loss flags."""

import hashlib

from hypothesis import given
from hypothesis import strategies as st

from farebox.llm.chat import TEMPLATE, escape, format_chat, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = st.sampled_from([*TEMPLATE.controls, "\\", "<", "[", "]", ">", "/", " ", "\n", "x", "é", "s>", "INST]", "[/"])


@given(st.lists(PARTS, max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control(text):
    assert unescape(escape(text)) == text
    bare = escape(text).replace("\\\\", "")
    assert all(bare.replace("\\" + c, "").count(c) == 0 or "\\" in bare for c in TEMPLATE.controls)


def expected(turns):
    sha, loss = hashlib.sha256(), hashlib.sha256()
    chars = 0
    for role, text in turns:
        sha.update(f"{role}\n{text}\n".encode())
        if role == "assistant":
            loss.update(text.encode())
            chars += len(text)
    return len(turns), sha.hexdigest(), chars, loss.hexdigest()


CASES = {
    1: [("system", "be kind"), ("user", "hi"), ("assistant", "yes\n")],
    2: [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")],
    3: [("user", ""), ("assistant", "")],
    4: [("assistant", "first"), ("assistant", " again ")],
    5: [("tool", "[ROLE]\\"), ("[TEXT] odd", "é漢 [/ROLE]"), ("", "x")],
    6: [("user", "\\"), ("assistant", "<"), ("user", "<s>\\[OUT]"), ("assistant", "  \\\\ ")],
    7: [("user", "no answer")],
    8: [("user", f"q{i}") if i % 2 == 0 else ("assistant", f"a{i}") for i in range(500)],
}


def test_what_is_read_back_equals_what_was_written(spark):
    rows = [(c, i, r, t) for c, turns in CASES.items() for i, (r, t) in enumerate(turns)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS loss", "1 AS valid").repartition(5)
    segments = format_chat(df)
    got = {r.conv_id: r for r in read_back(segments).collect()}
    for conv, turns in CASES.items():
        r = got[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == expected(turns), conv
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: True, 3: True, 4: False, 5: False, 6: True, 7: False, 8: True}
    texts = {}
    for s in segments.collect():
        texts[s.conv_id] = texts.get(s.conv_id, "") + s.text
    assert texts[1] == "<s>[SYS] be kind [/SYS][INST] hi [/INST][OUT] yes\n</s>"
    assert all(len(t) == got[c].formatted_chars for c, t in texts.items())


def test_loss_covers_assistant_texts_alone(spark):
    rows = [(1, i, r, t) for i, (r, t) in enumerate(CASES[1])]
    segments = format_chat(spark.createDataFrame(rows, SCHEMA)).collect()
    assert [s.text for s in segments if s.loss] == ["yes\n"]
    assert [s.last for s in segments] == [False] * (len(segments) - 1) + [True]


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, None, "x"), (1, 1, "assistant", "b"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"),
            (None, 0, "user", "n"), (None, None, "user", "m")]
    got = {r.conv_id: r for r in read_back(format_chat(spark.createDataFrame(rows, SCHEMA))).collect()}
    first = [("user", ""), ("", "x"), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")]
    assert (got[1].n_turns, got[1].turns_sha256) == expected(first)[:2]
    assert got[None].turns_sha256 == expected([("user", "m"), ("user", "n")])[1]


def test_no_rows(spark):
    assert read_back(format_chat(spark.createDataFrame([], SCHEMA))).collect() == []
