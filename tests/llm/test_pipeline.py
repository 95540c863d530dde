import tiktoken
from public_tokenizers import PATTERN
from pyspark.sql import functions as F

import corpus_pipeline
from lapakdw.llm import langid, secret_scan
from lapakdw.llm.bpe import vocabulary
from lapakdw.llm.queries import VOCABULARY, table
from tests.llm import brute


def test_stages_have_the_asked_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secrets", "byte_bpe"]


def redacted(text):
    spans = secret_scan.scan_texts(vocabulary(VOCABULARY), [text])[0]
    out, upto = "", 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a > upto or not out:
            out += text[upto:a] + "[SECRET]"
        upto = max(upto, b)
    return out + text[upto:]


def test_pipeline_against_plain_python(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    rows = docs.select("doc_id", "text", "lang", "source").collect()
    texts = [r["text"] or "" for r in rows]
    left = [r for r, lang, score in zip(rows, *model.predict(texts)) if lang != "und" and score >= langid.MIN_SCORE]
    assert len(left) > 0.95 * len(rows)
    pairs = [(r["doc_id"], r["text"]) for r in left]
    left = [r for r, c in zip(left, brute.classes(pairs)) if r["doc_id"] == c]
    items = [(r["item_id"], r["text"]) for r in table(spark, sf_dir, "benchmark").collect()]
    judged = brute.contamination([(r["doc_id"], r["text"]) for r in left], items)
    left = [r for r, j in zip(left, judged) if not j[-1]]
    own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=vocabulary(VOCABULARY).rank, special_tokens={})
    expected = {r["doc_id"]: own.encode_ordinary(redacted(r["text"] or "")) for r in left}

    found = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"]: list(r["ids"]) for r in found} == expected
    assert len(found) == len(expected) < len(rows)
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in found)


def test_stages_stand_odd_rows(spark, sf_dir):
    rows = [
        (1, None, None, None, None, "a"), (2, "", "en", "s", 0, "a"), (None, "the thing is here", "en", None, 17, None),
        (3, "the thing is here", "en", "s", None, "b"), (3, "the thing is here", "en", "s", None, "b"),
        (4, "and the other password=abcdefabcdef0123 was there", "en", "s", 49, "c"), (5, "a " * 100_000, "en", "s", 200_000, "c"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, spans string"
    docs = spark.createDataFrame(rows, schema)
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, sf_dir)
            if name != "byte_bpe":
                assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
            else:
                assert out.where(~F.col("round_trip")).count() == 0
            out.collect()
    clean = {r["doc_id"]: r for r in corpus_pipeline.secrets(spark, docs, sf_dir).collect()}
    assert clean[4]["text"] == "and the other [SECRET] was there" and clean[4]["n_chars"] == 32
    assert clean[1]["text"] is None and clean[5]["n_chars"] == 200_000


def test_columns_of_any_name_are_kept(spark, sf_dir):
    """Names that stages use inside do not clash with those of the documents, repeated rows included."""
    row = (3, "the thing is here password=abcdefabcdef0123 and there", "en", "s", 53, "t", "u", "v", "w")
    schema = "doc_id long, text string, lang string, source string, n_chars long, __twin string, twin string, spans_found string, text_clean string"
    docs = spark.createDataFrame([row, row], schema)
    near = corpus_pipeline.near_dedup(spark, docs, sf_dir)
    assert near.columns == docs.columns and [tuple(r) for r in near.collect()] == [row]
    clean = corpus_pipeline.secrets(spark, docs, sf_dir).collect()
    assert [tuple(r)[5:] for r in clean] == [row[5:]] * 2
    assert {r["text"] for r in clean} == {"the thing is here [SECRET] and there"}
    coded = corpus_pipeline.byte_bpe(spark, docs, sf_dir).collect()
    assert len(coded) == 2 and all(r["round_trip"] for r in coded)
