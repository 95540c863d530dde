import re
from collections import Counter, defaultdict

import pytest

from lapakdw.llm import divergence
from lapakdw.llm.shipping import importable

FIELDS = "doc_id bigint, text string, lang string, source string"


def brute(rows):
    """The audit in plain Python: rows of (text, lang, source)."""
    df, groups = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
    for text, lang, source in ((t or "", x or "", s or "") for t, x, s in rows):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        terms = re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", lower)
        df[lang].update(set(terms))
        groups[lang][source].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= 3]
        v = len(kept)
        whole = sum(sources.values(), Counter())

        def share(counts):
            n = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 1) // (n + v) for t in kept}

        q = share(whole)
        p = {s: share(counts) for s, counts in sources.items()}
        for a in sources:
            pairs = [(b, sum((p[a][t] - p[b][t]) ** 2 // p[b][t] for t in kept)) for b in sources if b != a]
            terms = [(t, (p[a][t] - q[t]) ** 2 // q[t]) for t in kept if sources[a][t] and p[a][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, 200)):
                ordered = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, a, part, item, value, i) for i, (item, value) in enumerate(ordered, 1)]
    return sorted(out)


def audit(spark, rows):
    importable(spark)
    docs = spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], FIELDS)
    return sorted(tuple(r) for r in divergence.source_divergence(docs).collect())


MIXED = [
    ("The cat and the Cat, über-cat!", "en", "a"),
    ("the dog AND the cat", "en", "a"),
    ("the dog AND the cat", "en", "b"),
    ("the dog AND the cat", "en", "b"),  # a repeated row is a document
    ("über über über and", "en", None),
    (None, "en", "silent"),  # occurs, without terms
    ("1 2 3 ...", "en", "numbers"),
    ("nur einmal", "de", "a"),  # no term of this language is in three documents
    ("ganz anders", "de", "b"),
    ("x y z", None, "a"),
    ("x y", None, "b"),
    ("x É é", "", "b"),
    ("É é ŸŸ x", "", "c"),
    ("É é", "", None),
    ("alone alone", "xx", "a"),
    ("", "yy", "a"),
]


def test_against_plain_python(spark):
    assert audit(spark, MIXED) == brute(MIXED)


def test_given_documents_against_plain_python(spark, sf_dir):
    importable(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = brute([tuple(r) for r in docs.select("text", "lang", "source").collect()])
    assert sorted(tuple(r) for r in divergence.source_divergence(docs).collect()) == expected


def test_blocks_of_sources_and_stretches_of_terms(spark, monkeypatch):
    monkeypatch.setattr(divergence, "CELL_SOURCES", 2)
    monkeypatch.setattr(divergence, "CELL_TERMS", 2)
    rows = [(f"w{'abcdefg'[i % 7]} common u{'xyz'[i % 3]} common", "en", f"s{i % 5}") for i in range(40)] + MIXED
    assert audit(spark, rows) == brute(rows)


def test_ties_of_terms_go_to_the_smaller(spark):
    words = [f"q{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(300)]
    rows = [(" ".join(words), "en", "a")] * 3 + [("other " * 50, "en", "b")] * 3
    found = audit(spark, rows)
    assert found == brute(rows)
    listed = [r[3] for r in found if r[1:3] == ("a", "term")]
    assert sorted(listed) == sorted(words)[:200]


def test_very_long_text(spark):
    rows = [("wort " * 400_000 + "Ende", "de", "a"), ("wort ende", "de", "b"), ("x" * 2_000_000 + " ende", "de", "c")]
    assert audit(spark, rows) == brute(rows)


def test_empty_table_and_clashing_columns(spark):
    importable(spark)
    empty = spark.createDataFrame([], FIELDS)
    assert divergence.source_divergence(empty).collect() == []
    odd = "text string, lang string, source string, term string, counts int, part int, value int, rank int, v int, block int"
    docs = spark.createDataFrame([("a b c", "en", s, "t", 1, 2, 3, 4, 5, 6) for s in ("x", "y", "y")], odd)
    expected = brute([("a b c", "en", "x"), ("a b c", "en", "y"), ("a b c", "en", "y")])
    assert sorted(tuple(r) for r in divergence.source_divergence(docs).collect()) == expected


def test_spilled_stripes_add_up():
    stripes = divergence.Stripes()
    for source, text in (("a", b"one two one"), ("b", b"one"), ("a", b"two")):
        stripes.fold("en", source, text)
    (batch,) = list(stripes.spill())
    rows = {r["term"]: (r["docs"], dict(zip(r["sources"], r["counts"]))) for r in batch.to_pylist()}
    assert rows == {"one": (2, {"a": 2, "b": 1}), "two": (2, {"a": 2})}
    assert not stripes.held and stripes.bytes == 0
    parts = []
    for text in (b"one", b"two one", b"one two two"):
        stripes.fold("en", "a", text)
        parts.extend(stripes.spill())
    import pyarrow as pa

    one = pa.Table.from_batches(parts).sort_by([("lang", "ascending"), ("term", "ascending")]).combine_chunks()
    merged = [r for b in divergence._merge(1)(iter(one.to_batches())) for r in b.to_pylist()]
    assert [(r["term"], r["docs"], r["counts"], r["total"]) for r in merged] == [("one", 3, [3], 3), ("two", 2, [3], 3)]


@pytest.mark.parametrize("count,under", [(0, 1), (0, 7), (6, 7), (10**12, 3 * 10**13), (5 * 10**14, 9 * 10**15)])
def test_shares_are_exact(count, under):
    import numpy as np

    assert divergence.shares(np.array([count]), under)[0] == 1 + 10**9 * (count + 1) // under
