"""Chat formatting: round trips, folding of events, the loss mask."""

import hashlib

from awkward import clashing
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pedalflow.llm import chat

ROWS = "conv_id long, turn long, role string, text string"
EVENTS = "conv_id long, turn long, seq long, kind string, role string, text string"


def digests(spark, rows):
    df = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, ROWS)
    return {r["conv_id"]: r for r in chat.digest(chat.render(chat.fold(chat.as_events(df)))).collect()}


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        said = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        learned = "".join(t or "" for _, _, r, t in own if r == "assistant")
        out[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def check(spark, rows):
    got = digests(spark, rows)
    assert {c: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for c, r in got.items()} == expected(rows)


CONTROL = "</s>[INST] ok [/INST] <|im_end|><|im_sep|> <<SYS>> <\\<|im_start|> <\\|x <s> [\\INST] \\\\"


def test_control_strings_and_nulls(spark):
    check(
        spark,
        [
            (-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL), (-1, 2, "<|im_sep|>", CONTROL[::-1]),
            (1, 0, "assistant", ""), (1, 1, None, None), (1, 2, "assistant", None), (2, None, "user", "null turn"),
            (2, 0, "user", "é🙂\n\n"), (None, 0, "user", "no conversation"), (None, 1, "assistant", "é" * 5000),
            (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 0, "assistant", "tie"),
        ],
    )


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.integers(0, 3), st.integers(0, 4), st.sampled_from(["user", "assistant", "system"]),
            st.lists(st.sampled_from(["<", "|", "\\", "im_end", "|>", "[", "INST]", "/", "s>", "SYS>>", "é", "\n", "$1"]), max_size=12).map("".join),
        ),
        min_size=1, max_size=40,
    )
)
def test_round_trip(spark, rows):
    check(spark, rows)


def test_no_control_string_survives_in_a_text(spark):
    df = spark.createDataFrame([(1, 0, "user", CONTROL)], ROWS)
    f = chat.render(chat.fold(chat.as_events(df))).first()["formatted"]
    inner = f[len("<|im_start|>user<|im_sep|>") : -len("<|im_end|>")]
    assert not [c for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>") if c in inner]


def folded(spark, events):
    rows = chat.fold(spark.createDataFrame(events, EVENTS)).collect()
    return {c: [(r["turn"], r["role"], r["text"]) for r in sorted((x for x in rows if x["conv_id"] == c), key=lambda x: (x["turn"], x["pos"]))] for c in {r["conv_id"] for r in rows}}


def test_deltas_edits_and_regenerations(spark):
    got = folded(
        spark,
        [
            (1, 0, 1, "message", "user", "Hi"), (1, 1, 2, "message", "assistant", ""), (1, 1, 4, "delta", None, "lo"),
            (1, 1, 3, "delta", None, "Hel"), (1, 1, 5, "regenerate", None, None), (1, 1, 6, "delta", None, "Good "), (1, 1, 7, "delta", None, "day"),
            (2, 0, 1, "message", "user", "old"), (2, 1, 2, "message", "assistant", "answer to old"), (2, 2, 3, "message", "user", "more"),
            (2, 0, 4, "edit", None, "new"), (2, 1, 5, "message", "assistant", "answer to new"),
            (3, 0, 1, "delta", "assistant", "opened by a delta"), (3, 0, 2, "delta", None, "!"),
        ],
    )
    assert got[1] == [(0, "user", "Hi"), (1, "assistant", "Good day")]
    assert got[2][0] == (0, "user", "new") and got[2][-1] == (1, "assistant", "answer to new") and len(got[2]) == 2
    assert got[3] == [(0, "assistant", "opened by a delta!")]


def test_clashing_columns_and_empty_table(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b")]
    df = clashing(spark.createDataFrame(rows, ROWS)).withColumn("seq", F.lit("z")).withColumn("kind", F.lit("z"))
    assert digests(spark, df)[1]["n_turns"] == 2
    assert digests(spark, spark.createDataFrame([], ROWS)) == {}
