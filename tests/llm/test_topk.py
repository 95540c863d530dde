import math
import random

import pytest

from lapakdw.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, asks, k):
    def usable(i, v):
        return i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    def whole(v):
        return tuple(math.floor(64 * x) for x in v)

    vectors = {(i, whole(v)) for i, v in rows if usable(i, v)}
    asking = {}
    for i, v in asks:
        if usable(i, v):
            asking[i] = min(asking.get(i, v), v)
    out = []
    for q, v in asking.items():
        best = {}
        for i, w in vectors:
            if i != q:
                score = sum(a * b for a, b in zip(whole(v), w))
                best[i] = max(best.get(i, score), score)
        for rank, (i, score) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k], start=1):
            out.append((q, rank, i, score))
    return sorted(out)


def check(spark, rows, asks, k=5):
    df, q = (spark.createDataFrame([(i, v, 1) for i, v in x], SCHEMA) for x in (rows, asks))
    found = topk.top_k(df.repartition(3), q, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute(rows, asks, k)


def f32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


@pytest.mark.parametrize(("tile", "asked", "cell"), [(4096, 1024, 4), (7, 3, 1), (1, 1, 2)])
def test_any_tiling(spark, monkeypatch, tile, asked, cell):
    monkeypatch.setattr(topk, "TILE_ROWS", tile)
    monkeypatch.setattr(topk, "QUERY_ROWS", asked)
    monkeypatch.setattr(topk, "CELL_TILES", cell)
    monkeypatch.setattr(topk, "FAN_IN", 2)
    rng = random.Random(tile)
    rows = [(i - 20, [f32(rng.choice([0.0, 0.5, -0.25, rng.uniform(-1, 1)])) for _ in range(6)]) for i in range(60 if tile > 1 else 25)]
    check(spark, rows, [r for r in rows if r[0] % 4 == 0])


def test_ties_repeats_and_ids_with_several_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "TILE_ROWS", 5)
    rows = [(i, [1.0, 0.0]) for i in range(30)] + [(3, [1.0, 0.0])] * 9 + [(4, [2.0, 0.0]), (4, [0.5, 0.0]), (5, [float(i) for i in range(2)])]
    check(spark, rows, [rows[0], rows[3], rows[3], (4, [2.0, 0.0]), (4, [0.5, 0.0]), (99, [1.0, 1.0])], k=8)


def test_nulls_lengths_and_large_components(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (None, [1.0]), (1, None), (2, [None, 1.0]), (3, [nan]), (4, [-inf, 0.0]), (5, []), (6, [1.0]), (7, [1.0, -2.0, 3.0]),
        (8, [f32(1e12), 1.0]), (9, [f32(-1e12), f32(0.1)]), (10, [f32(3e5)] * 3),
    ]
    small = [(i, v) for i, v in rows if i not in (8, 9)]
    check(spark, small, small)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
    top = {r["vec_id"]: r["score"] for r in topk.top_k(df, df.where("vec_id = 8"), 20).collect()}
    assert top[9] == -(2**63 - 2)  # cut to the range of a long


def test_fewer_candidates_than_asked_and_empty_tables(spark):
    check(spark, [(1, [1.0])], [(1, [1.0])])
    check(spark, [(1, [1.0]), (2, [0.5])], [(1, [1.0])])
    check(spark, [], [(1, [1.0])])
    check(spark, [(1, [1.0])], [])
