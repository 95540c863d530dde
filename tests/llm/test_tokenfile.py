import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lapakdw.llm import tokenfile
from lapakdw.llm.shipping import importable
from lapakdw.runtime import new_scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")


PLAIN = Tokenizer.from_file(PATH)


def plain_ids(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 0]


def digest(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def expected(rows):
    """Digests of (doc_id, text) rows whose ids differ."""
    found, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = plain_ids(text)
        found.append((doc_id, start, len(ids), digest(ids)))
        start += len(ids)
    return found


def digests(spark, docs):
    importable(spark)
    return sorted((tuple(r) for r in tokenfile.file_digests(docs, PATH).collect()), key=lambda r: r[1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.sampled_from([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24]), max_size=40))
def test_pack_and_unpack(numbers):
    control, spelled = tokenfile.pack(np.array(numbers, np.uint32))
    assert len(control) == -(-len(numbers) // 4)
    assert len(spelled) == sum(max(1, -(-n.bit_length() // 8)) for n in numbers)
    assert tokenfile.unpack(control, spelled, len(numbers)).tolist() == numbers


def test_control_bytes_by_hand():
    control, spelled = tokenfile.pack(np.array([1, 0x0203, 0x040506, 0x0708090A, 5], np.uint32))
    assert control == bytes([0b11_10_01_00, 0])
    assert spelled == bytes([1, 3, 2, 6, 5, 4, 0x0A, 9, 8, 7, 5])


def ids_of(encoder, texts):
    return [np.frombuffer(i, encoder.kind).tolist() for i in encoder.texts(texts)]


def test_pieces_are_those_of_the_library():
    """Every code point alone, and in front of and behind letters, numbers, marks and spaces."""
    encoder = tokenfile.Encoder(PATH)
    assert encoder.by_pieces and encoder.kind == "<u2"
    every = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = [" ".join(f"a{c}b{c}1{c}!{c} {c}" for c in every[i : i + 2000]) for i in range(0, len(every), 2000)]
    for text in texts[:20] + texts[20::12]:
        assert ids_of(encoder, [text]) == [PLAIN.encode(text, add_special_tokens=False).ids]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab1' \n\t!sdmtrevl\u00a0\u00e9\u4e2d\U0001f642\u0301\u2028")) | st.characters(codec="utf-8")), max_size=5))
def test_texts_together_are_those_of_the_library(texts):
    encoder = tokenfile.Encoder(PATH)
    texts = [*texts, "x<|endoftext|>y", *texts]
    assert ids_of(encoder, texts) == [plain_ids(t)[:-1] for t in texts]


def test_other_tokenizers_go_to_the_library():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = tokenfile.Encoder(path)
    assert not encoder.by_pieces
    text = "Some Words, and MORE."
    assert ids_of(encoder, [text, ""]) == [Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, []]


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(tokenfile, "CACHE_PIECES", 10)
    encoder = tokenfile.Encoder(PATH)
    for i in range(30):
        text = f"word{i} again {'long' * 40}{i}"
        assert ids_of(encoder, [text]) == [plain_ids(text)[:-1]]
        assert len(encoder.known) <= 20 and all(len(p) <= tokenfile.CACHE_CHARS for p in encoder.known)


@pytest.mark.parametrize("most", [1, 7, 50])
def test_stretches_encode_as_the_whole(most):
    texts = ["Don't stop  me now, I'm (quite) fine.\n\nNew line \t tab  end ", "été ça  va 12 34 <|endoftext|> you're", "x" * 300, ""]
    encoder = Tokenizer.from_file(PATH)
    for text in texts:
        parts = list(tokenfile.stretches(text, most))
        assert "".join(parts) == text
        ids = [i for p in parts for i in encoder.encode(p, add_special_tokens=False).ids]
        assert ids == encoder.encode(text, add_special_tokens=False).ids


def test_given_documents_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert digests(spark, docs.orderBy(F.rand(1))) == expected(rows)


def test_nulls_empty_long_and_clashing_columns(spark):
    rows = [(5, None), (None, "no id"), (-3, ""), (9, "very long text, " * 60_000), (7, "Ünïcödé 🙂 <|endoftext|> \n\n")]
    docs = spark.createDataFrame([(*r, b"x", 1, 2) for r in rows], "doc_id long, text string, ids binary, start int, _tie int")
    assert digests(spark, docs) == expected(rows)


def test_repeated_rows_and_ids(spark):
    rows = [(1, "same"), (1, "same"), (1, "other one"), (0, "first")]
    found = digests(spark, spark.createDataFrame(rows, "doc_id long, text string"))
    assert [r[0] for r in found] == [0, 1, 1, 1] and found[0][1] == 0
    assert sorted(r[2:] for r in found[1:]) == sorted((len(i), digest(i)) for i in map(plain_ids, ("same", "same", "other one")))
    assert [r[1] for r in found[1:]] == np.cumsum([r[2] for r in found[:-1]]).tolist()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert digests(spark, docs) == []


def test_small_shards_and_text_ids(spark):
    importable(spark)
    rows = [(f"d{i:03d}", f"document number {i} says {i * i}") for i in range(60)]
    docs = spark.createDataFrame(rows, "name string, body string")
    folder = new_scratch(spark, "files")
    files = tokenfile.write_token_files(docs, PATH, folder, key="name", text="body", shard_ids=40)
    shards = files.manifest.orderBy("part", "shard").collect()
    assert len(shards) >= 10 and sum(s["n_docs"] for s in shards) == 60
    again = tokenfile.TokenFiles(spark, folder, "string")  # another session opens the folder by its name
    found = again.read().orderBy("start").collect()
    assert [r["doc_id"] for r in found] == [name for name, _ in rows]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in found] == [plain_ids(body) for _, body in rows]


def test_frequent_ids_are_short_and_files_are_checked(spark, tmp_path):
    path = str(tmp_path / "a.ids")
    rank_of = np.array([2, 1, 0], np.uint32)
    shard = tokenfile.ShardWriter(path, pa.int64())
    big = np.full(tokenfile.BLOCK_IDS + 3, 2, np.uint32)
    for doc_id, ids in ((1, big), (2, np.zeros(0, np.uint32)), (3, np.array([0, 1, 2], np.uint32))):
        shard.add(doc_id, rank_of.take(ids))
    shard.close()
    read = list(tokenfile.read_shard(path, np.array([2, 1, 0], np.uint32)))
    assert [(d, len(i)) for d, i in read] == [(1, len(big)), (2, 0), (3, 3)]
    assert (read[0][1] == big).all() and read[2][1].tolist() == [0, 1, 2]
    assert shard.size == (tmp_path / "a.ids").stat().st_size < 1.3 * len(big)
    (tmp_path / "a.ids").write_bytes(b"something else entirely, long enough")
    with pytest.raises(ValueError):
        list(tokenfile.read_shard(path, rank_of))


def test_equal_pieces_are_looked_up_once(monkeypatch):
    asked = []
    monkeypatch.setattr(
        tokenfile.Pieces, "__getitem__", lambda self, piece: (asked.append(piece), dict.__getitem__(self, piece))[1], raising=False
    )
    texts = ["satu dua", " dua satu é é 漢漢", "", "dua dua dua\u00e9"] * 50
    found = ids_of(tokenfile.Encoder(PATH), texts)
    assert [list(ids) for ids in found] == [plain_ids(t)[:-1] for t in texts]
    assert len(asked) == len(set(asked))
