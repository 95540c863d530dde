import random
import zlib

import numpy as np

from lapakdw.llm import gam

DOC, LABEL = "doc_id long, text string, score double", "doc_id long, quality int, toxic int"


def texts(n, seed=1):
    rng = random.Random(seed)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed"]

    def prose(k):
        return " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(k)).capitalize() + "."

    rows = []
    for i in range(n):
        body = "\n".join(prose(rng.randrange(3, 15)) for _ in range(rng.randrange(1, 9)))
        good = rng.random() < 0.7
        if not good:
            body = rng.choice([body.upper().replace(" ", "!! "), body.replace(" ", "*** "), body.replace(" ", " | "), (body.split()[0] + " ") * 80])
        rows.append((i, body, int(good)))
    return rows


def is_held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    rows = texts(900)
    docs = spark.createDataFrame([(i, t, 0.1) for i, t, _ in rows], DOC)
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in rows], LABEL)
    found = gam.quality(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    truth = {i: q for i, _, q in rows}
    held = [r for r in found.collect() if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if is_held(i)}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in held)


def test_held_out_labels_change_nothing(spark):
    rows = texts(200, seed=2)
    docs = spark.createDataFrame([(i, t, 0.1) for i, t, _ in rows], DOC)
    scores = []
    for flip in (False, True):
        labels = spark.createDataFrame([(i, 1 - q if flip and is_held(i) else q, 0) for i, _, q in rows], LABEL)
        scores.append(sorted(map(tuple, gam.quality(docs, labels).collect())))
    assert scores[0] == scores[1]


def test_nulls_repeats_and_conflicting_labels(spark):
    rows = texts(60, seed=3)
    docs = spark.createDataFrame(
        [(i, t, 0.1) for i, t, _ in rows] + [(None, "x", None), (500, None, None), (501, "", 1.0), (501, "", 1.0), (502, " \n ", 1.0), (503, "word " * 200_000, 0.0)],
        DOC,
    )
    labels = spark.createDataFrame(
        [(i, q, 0) for i, _, q in rows] + [(1, 0, 0), (1, 1, 0), (500, 0, 0), (501, 0, 0), (None, 1, 1), (2, None, None), (3, 7, 0)], LABEL
    )
    found = gam.quality(docs, labels).collect()
    assert len(found) == 66
    assert all(r["score"] is not None and r["held_out"] is not None for r in found)
    assert not next(r for r in found if r["doc_id"] is None)["held_out"]


def test_empty_tables(spark):
    no_labels = spark.createDataFrame([], LABEL)
    docs = spark.createDataFrame([(1, "a b c", 0.0)], DOC)
    assert [r["score"] for r in gam.quality(docs, no_labels).collect()] == [0.5]
    assert gam.quality(docs.limit(0), no_labels).count() == 0


def test_pairs_learn_what_single_measures_cannot():
    rng = np.random.default_rng(1)
    rows = rng.uniform(-1, 1, (4000, 3))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 1] > 0)).astype(float)
    model = gam.fit_rows(rows, labels)
    assert {0, 1} in [{i, j} for i, j, _ in model.pairs]
    assert ((model.score(rows) > 0.5) == (labels > 0.5)).mean() > 0.9


def test_measures_are_as_many_as_named():
    for text in ("", " ", "a", "A b\n\nC! |", "é" * 5):
        row = gam.measure(text)
        assert len(row) == len(gam.MEASURES) and np.isfinite(row).all()
