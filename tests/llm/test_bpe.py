import random

import numpy as np
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import PATTERN

from lapakdw.llm import bpe
from lapakdw.llm.queries import VOCABULARY

VOCAB = bpe.vocabulary(VOCABULARY)
OWN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=VOCAB.rank, special_tokens={})


def encode(texts):
    ids, ends, _, _ = VOCAB.encode_texts(texts)
    return [x.tolist() for x in np.split(ids, ends[:-1])]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'strevmld  \n\t.!12é日𝒳\x1c\x85　 ’"), max_size=30), min_size=1, max_size=6))
def test_like_the_tokenizer_library(texts):
    assert encode(texts) == [OWN.encode_ordinary(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80).filter(lambda t: not any(0xD800 <= ord(c) < 0xE000 for c in t)))
def test_any_text(text):
    (ids,) = encode([text])
    assert ids == OWN.encode_ordinary(text)
    assert VOCAB.decode(ids).decode() == text


def test_every_code_point():
    every = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    texts = ["".join(f"a{c} {c}1" for c in every[i : i + 5000]) for i in range(0, len(every), 20_000)]
    assert encode(texts) == [OWN.encode_ordinary(t) for t in texts]


def test_long_pieces_and_cache_turnover(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    rng = random.Random(1)
    texts = ["x" * 5000, "".join(rng.choices("abcdefgh", k=3000)), " " * 4000 + "x", "é" * 700, *(f"w{i} don't" for i in range(30))]
    for text in texts:
        assert encode([text]) == [OWN.encode_ordinary(text)]


def test_scan_is_the_composition_of_all_before():
    m = bpe.monoid()
    rng = np.random.default_rng(1)
    elements = m.of_kind[rng.integers(0, len(m.of_kind), 1000)]
    total, acc = [], 0
    for e in elements.tolist():
        acc = int(m.product[acc * m.size + e])
        total.append(acc)
    for block in (2, 7, 128):
        assert m.scan(elements, block).tolist() == total


def test_encode_and_decode_frames(spark):
    texts = ["Hello world, don't!", None, "", "é" * 300 + " x" * 500, "Hello world, don't!"]
    df = spark.createDataFrame([(i, t, "e") for i, t in enumerate(texts)] + [(None, "z", None)], "doc_id long, text string, extra string")
    coded = bpe.encode(df, VOCABULARY)
    assert coded.columns == ["doc_id", "extra", "ids", "piece_chars", "piece_tokens"]
    rows = {r["doc_id"]: r for r in bpe.decode(coded, VOCABULARY).collect()}
    assert len(rows) == 6
    for i, text in enumerate(texts):
        assert list(rows[i]["ids"]) == OWN.encode_ordinary(text or "")
        assert bytes(rows[i]["decoded"]).decode() == (text or "")
    long = rows[3]
    for a, b in ((0, 5), (299, 303), (310, 400), (700, 1300), (5, 5)):
        assert VOCAB.decode_from(long["ids"], long["piece_chars"], long["piece_tokens"], a, b) == texts[3][a:b]
    assert bpe.encode(df.limit(0), VOCABULARY).count() == 0
    with pytest.raises(ValueError, match="exist already"):
        bpe.encode(df.withColumnRenamed("extra", "ids"), VOCABULARY)
