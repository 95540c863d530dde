import random

import numpy as np
import pytest

from lapakdw.llm import ordminhash as om
from tests.llm import brute

DOC = "doc_id long, text string, class_id long, _id long, key string"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 7, 8, "x") for i, t in docs], DOC)


def classes(spark, docs):
    return {(r["doc_id"]): r["class_id"] for r in om.near_duplicates(frame(spark, docs).repartition(3)).collect()}


def family(rng, words, size, edits):
    """A text and copies with a few words replaced, dropped or put in."""
    base = [f"{rng.choice('abcdefgh')}{rng.randrange(400)}" for _ in range(words)]
    out = [base]
    for _ in range(size - 1):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            at = rng.randrange(len(copy))
            copy[at : at + rng.randrange(2)] = rng.choice([[], ["new"], ["other"]])
        out.append(copy)
    return [" ".join(c) for c in out]


def test_same_classes_as_all_pairs(spark):
    rng = random.Random(1)
    texts = []
    for _ in range(25):
        texts += family(rng, rng.choice([4, 8, 40, 120, 200]), rng.randrange(1, 5), 6)
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    want = dict(zip(range(len(docs)), brute.classes(docs)))
    found = classes(spark, docs)
    # Links close to the limit may be missed with a small chance; nothing else may differ.
    assert sum(found[i] != want[i] for i in found) == 0


def test_texts_that_share_a_passage_stay_apart(spark):
    rng = random.Random(2)
    passage = family(rng, 60, 1, 0)[0]
    docs = [(i, family(rng, 55, 1, 0)[0] + " " + passage) for i in range(40)]
    assert all(k == v for k, v in classes(spark, docs).items())


@pytest.mark.parametrize(("small", "tile"), [(32, 512), (1, 512), (1, 4)])
def test_chains_and_hubs(spark, monkeypatch, small, tile):
    """Variants that are close to the base only, and a chain of copies of copies; by pairs and by tiles."""
    monkeypatch.setattr(om, "SMALL_BUCKET", small)
    monkeypatch.setattr(om, "TILE_MEMBERS", tile)
    rng = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    docs = []
    for i in range(12):
        copy = list(base)
        for at in range(i, 200, 50):
            copy[at] = f"v{i}"
        docs.append((i, " ".join(copy)))
    for i in range(12):
        base[i * 12 + 3] = base[i * 12 + 9] = f"c{i}"
        docs.append((20 + i, " ".join(base)))
    rng.shuffle(docs)
    want = dict(zip([d[0] for d in docs], brute.classes(docs)))
    assert classes(spark, docs) == want
    assert want[31] == want[22]


def test_nulls_short_texts_repeats_and_missing_ids(spark):
    docs = [
        (1, None), (2, None), (3, ""), (4, "?!"), (5, "?!"), (6, "one two"), (7, "One, two!"), (8, "two one"), (9, "one two"), (9, "one two"),
        (10, "x " * 50_000), (11, "x " * 50_001), (None, "lone text of some words here"), (None, "one two"),
    ]
    rows = om.near_duplicates(frame(spark, docs)).collect()
    assert len(rows) == len(docs)
    by_id = {r["doc_id"]: r["class_id"] for r in rows if r["doc_id"] is not None}
    assert by_id == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 6, 10: 10, 11: 10}
    assert sorted([r["class_id"] for r in rows if r["doc_id"] is None], key=str) == [6, None]


def test_empty_table(spark):
    assert om.near_duplicates(frame(spark, [])).count() == 0
    assert om.drop_near_duplicates(frame(spark, [])).count() == 0


def test_one_of_each_class_stays(spark):
    docs = [(3, "a b c"), (1, "A b c"), (2, "a-b-c"), (5, "other"), (5, "other"), (6, None), (6, None), (None, "a b c"), (7, "x y"), (7, "X y")]
    df = frame(spark, docs)
    left = om.drop_near_duplicates(df)
    assert left.columns == df.columns
    kept = sorted([(r["doc_id"], (r["text"] or "").lower()) for r in left.collect()], key=str)
    assert kept == sorted([(1, "a b c"), (5, "other"), (6, ""), (6, ""), (7, "x y")], key=str)


def test_similarity_is_the_alignment():
    rng = random.Random(4)
    for _ in range(200):
        a, b = family(rng, rng.randrange(3, 60), 2, 5)
        x, y = (om.labelled_shingles(w) for w in om.word_hashes([a, b]))
        want = brute.aligned(brute.labelled(a), brute.labelled(b))
        got = om.similarity(x, y)
        assert (got >= om.SIMILARITY) == (want >= om.SIMILARITY)
        if got:
            assert got == pytest.approx(want)


def test_tiles_find_the_links_of_all_pairs():
    rng = random.Random(6)
    texts = [t for _ in range(6) for t in family(rng, 60, 5, 3)]
    arrays = [om.labelled_shingles(w) for w in om.word_hashes(texts)]
    links = om.tile_links(list(range(len(texts))), list(range(100, 100 + len(texts))), arrays)
    want = brute.classes(list(enumerate(texts)))
    group = list(range(len(texts)))
    for a, b in links:
        group = [group[a] if g == group[b] else g for g in group]
    assert len(set(group)) == len(set(want)) == len(texts) - len(links)
    assert all((group[i] == group[j]) == (want[i] == want[j]) for i in range(len(texts)) for j in range(i))


def test_moved_halves_are_not_near():
    words = [f"w{i}" for i in range(200)]
    x, y = (om.labelled_shingles(w) for w in om.word_hashes([" ".join(words), " ".join(words[100:] + words[:100])]))
    assert om.similarity(x, y) < om.SIMILARITY


def test_words_and_blocks():
    texts = ["Ä b-C 1", "", "ä B c1", "!", "b c 1"]
    hashed = om.word_hashes(texts)
    assert [len(h) for h in hashed] == [len(brute.words(t)) for t in texts]
    assert (hashed[0][1:] == hashed[4]).all()
    values = np.random.default_rng(1).integers(0, 2**63, 1000).astype(np.uint64)
    whole = om._smallest(values, 5)
    om.BLOCK, before = 64, om.BLOCK
    try:
        assert (np.sort(om._smallest(values, 5)) == np.sort(whole)).all()
    finally:
        om.BLOCK = before


def test_components(spark):
    rng = random.Random(5)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    parent = {x: x for p in pairs for x in p}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    found = {r["node"]: r["label"] for r in om.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {x: root(x) for p in pairs for x in p if p[0] != p[1] or x in found}


def test_short_texts_at_the_limit_meet(spark):
    """One word more at an end: 4 of 5 shingles, 5 of 6, and up to 15 of 16, with 8 of 10 and 12 of 15 between."""
    rng = random.Random(8)
    texts = []
    for i in range(160):
        words = family(rng, 8 + i % 12, 1, 0)[0].split()
        end, more = [f"n{i}"], rng.randrange(2)
        texts += [words, words + end if more else end + words]
    for i in range(60):
        words = family(rng, 12 if i % 2 else 16, 1, 0)[0].split()
        texts += [words, [*words, f"n{i}", f"m{i}"] if i % 2 else [f"n{i}", *words, f"m{i}", f"k{i}"]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    found = classes(spark, docs)
    assert found == {i: i - i % 2 for i in range(len(docs))}


def test_short_texts_with_common_lines(spark):
    """Short texts that share lines without being similar, among copies of some; no link is missed."""
    rng = random.Random(9)
    line = family(rng, 9, 1, 0)[0].split()
    texts = []
    for i in range(120):
        own = [f"o{i}x{j}" for j in range(rng.randrange(1, 6))]
        texts += [line + own, [*line, *own, "end"], ["begin", *line[rng.randrange(3) :], *own]]
    docs = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = dict(zip(range(len(docs)), brute.classes(docs)))
    assert classes(spark, docs) == want


def stored_tables(monkeypatch):
    """Name and rows of each table stored from now on."""
    stored, store = [], om.materialize

    def counted(df, label):
        found = store(df, label)
        stored.append((label, found.count()))
        return found

    monkeypatch.setattr(om, "materialize", counted)
    return stored


def test_components_end_once_all_are_tied_to_the_smallest(spark, monkeypatch):
    """A step over a settled table costs as much as any other; none is taken to see that nothing moves."""
    links = spark.createDataFrame([(50, i) for i in range(1, 50)] + [(i, 50) for i in range(51, 90)], "a long, b long")
    stored = stored_tables(monkeypatch)
    found = {r["node"]: r["label"] for r in om.components(links).collect()}
    assert found == {i: 1 for i in range(1, 90)}
    assert len(stored) <= 8


def test_links_of_leaders_are_not_walked_again(spark, monkeypatch):
    """Copies of one text, edited in places of their own: the leader ties them all, which leaves no links for later."""
    base = [f"w{i}" for i in range(300)]
    docs = [(i, " ".join([*base[: 7 * i], f"v{i}", *base[7 * i + 1 :]])) for i in range(20)]
    stored = stored_tables(monkeypatch)
    assert classes(spark, docs) == {i: 0 for i in range(20)}
    edges = [rows for label, rows in stored if label == "edges"]
    assert edges[0] > 0 and edges[-1] == 0


def test_further_links_join_labels(spark):
    rng = random.Random(11)
    first = [(rng.randrange(80), rng.randrange(80)) for _ in range(40)]
    more = [(rng.randrange(100), rng.randrange(100)) for _ in range(25)] + [(3, 3), (200, 201)]
    frames = [spark.createDataFrame(pairs, "a long, b long") for pairs in (first, more, first + more)]
    labels = om.materialize(om.components(frames[0]), "labels")
    rows = om.join_labels(labels, frames[1]).collect()
    assert len({r["node"] for r in rows}) == len(rows)
    want = {r["node"]: r["label"] for r in om.components(frames[2]).collect()}
    assert {r["node"]: r["label"] for r in rows} == want


@pytest.mark.parametrize("small", [32, 1])
def test_same_classes_without_broadcasts(spark, monkeypatch, small):
    monkeypatch.setattr(om, "broadcast_if_measured", lambda df, limit=0: df)
    monkeypatch.setattr(om, "SMALL_BUCKET", small)
    rng = random.Random(12)
    texts = [t for size in (3, 8, 60, 120) for t in family(rng, size, 6, 5)]
    docs = list(enumerate(texts))
    assert classes(spark, docs) == dict(zip(range(len(docs)), brute.classes(docs)))
