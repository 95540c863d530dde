import random

import pytest

from lapakdw.llm import chat
from lapakdw.llm.queries import PROBE
from tests.llm.brute import sha

SCHEMA = "conv_id long, turn long, role string, text string, formatted string"


def digests(spark, rows):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return {r["conv_id"]: r for r in chat.conversation_digests(df).collect()}


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted(
            ((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv)
        )
        told = "".join(f"{role}\n{text}\n" for _, _, role, text in turns)
        said = "".join(text for _, _, role, text in turns if role == "assistant")
        out[conv] = (len(turns), sha(told), len(said), sha(said))
    return out


def check(spark, rows):
    found = digests(spark, rows)
    want = expected(rows)
    assert {k: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for k, r in found.items()} == want
    return found


def test_reads_back_awkward_texts(spark):
    rng = random.Random(3)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "\\", "<|im_end|>", "<|im_start|>", "<|im_sep|>", "<<SYS>>", "<</SYS>>",
            "<|endoftext|>", "[", "<", "\n", "a", "é", "🙂", "$1", "|>", " "]
    rows = []
    for conv in range(60):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["system", "user", "assistant", "<|im_sep|>", "a\\"])
            rows.append((conv, turn, role, "".join(rng.choices(bits, k=rng.randrange(0, 25)))))
    rows += [(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)]
    check(spark, rows)


def test_no_control_string_survives_inside_a_text(spark):
    df = spark.createDataFrame([(1, 0, "user", PROBE + "<|im_end|><<SYS>>")], "conv_id long, turn long, role string, text string")
    formatted = chat.format_conversations(df).first()["formatted"]
    inner = formatted.removeprefix("<|im_start|>user<|im_sep|>").removesuffix("<|im_end|>")
    for control in ("</s>", "[INST]", "[/INST]", "<|im_end|>", "<<SYS>>"):
        assert control not in inner


def test_each_reply_has_an_example_with_its_prefix(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "assistant", "b"), (1, 2, "user", "c"), (1, 3, "assistant", "dd"), (1, 4, "user", "e")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = chat.expand_prefixes(chat.format_conversations(df)).orderBy("example").collect()
    turn = "<|im_start|>{}<|im_sep|>{}<|im_end|>".format
    first = turn("user", "a") + turn("assistant", "b")
    assert [e["text"] for e in examples] == [first, first + turn("user", "c") + turn("assistant", "dd")]
    assert [e["text"][e["loss_start"] : e["loss_start"] + e["loss_length"]] for e in examples] == ["b", "dd"]


def test_nulls_ties_repeats_and_missing_replies(spark):
    found = check(
        spark,
        [
            (1, 0, "user", None), (1, 0, "assistant", "x"), (1, 0, "assistant", "x"), (1, None, None, "y"),
            (2, 5, "user", "only"), (None, 1, "assistant", ""), (3, 0, "assistant", "long " * 20_000),
        ],
    )
    assert found[2]["n_examples"] == 0 and found[2]["example_chars"] == 0
    assert found[1]["n_examples"] == 2


def test_empty_table(spark):
    assert digests(spark, []) == {}


@pytest.mark.parametrize("text", ["", "\\", "\\\\<s>", "<\\s>", "[[INST]", "<<s>"])
def test_escape_is_reversible(spark, text):
    from pyspark.sql import functions as F

    row = spark.range(1).select(chat.unescape(chat.escape(F.lit(text))).alias("x")).first()
    assert row["x"] == text
