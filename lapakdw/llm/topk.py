"""Exact top-k search by inner product: tiles of queries against tiles of rows, and a tree of merges.

Queries and rows are packed into tiles, small matrices that are one row each.
The tiles are dealt over a grid of cells, query tiles by line and row tiles by
column, so that every pair of tiles meets in one cell and a cell holds few
tiles. A cell multiplies its tiles, keeps the best of each tile per query and
merges them; the cells of a line are then merged a few at a time until one list
per query is left.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapakdw.runtime import materialize

# Fixed value: components are floor(SCALE * x).
SCALE = 64

# Most rows and numbers in a tile, query rows in a query tile, row tiles per cell, lists per merge.
TILE_ROWS, TILE_NUMBERS = 4096, 1 << 20
QUERY_ROWS = 1024
CELL_TILES = 4
FAN_IN = 8
# Queries multiplied at once.
STRIPE = 128

EXACT = 2.0**53
NONE = np.iinfo(np.int64).min

TILE = "ids binary, dim int, matrix binary"
LISTS = "line bigint, cell int, queries binary, ids binary, scores binary"


def usable(vector: Column) -> Column:
    """Not null, and neither null, NaN nor infinite anywhere."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(fine, F.lit(False))


def _pad(rows: list[np.ndarray], dim: int) -> np.ndarray:
    out = np.zeros((len(rows), dim))
    for i, r in enumerate(rows):
        out[i, : len(r)] = r
    return out


def _tiles(ids: np.ndarray, rows: list[np.ndarray], most: int) -> Iterator[tuple[bytes, int, bytes]]:
    """Tiles with ascending ids and no id twice; equal rows count once."""
    order = np.argsort(ids, kind="stable")
    todo = [(int(ids[i]), np.floor(SCALE * rows[i].astype(np.float64))) for i in order]
    while todo:
        now: list[tuple[int, np.ndarray]] = []
        later: list[tuple[int, np.ndarray]] = []
        for row in todo:
            if now and now[-1][0] == row[0]:
                if not np.array_equal(now[-1][1], row[1]):
                    later.append(row)
            else:
                now.append(row)
        dim = max(len(v) for _, v in now)
        size = max(1, min(most, TILE_NUMBERS // max(1, dim)))
        for a in range(0, len(now), size):
            part = now[a : a + size]
            matrix = _pad([v for _, v in part], dim)
            yield np.array([i for i, _ in part], np.int64).tobytes(), dim, matrix.tobytes()
        todo = later


def pack(df: DataFrame, most: int) -> DataFrame:
    """The rows (vec_id, embedding) of each task as tiles with a number of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["ids", "dim", "matrix"]
        ids: list[np.ndarray] = []
        rows: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for tile in _tiles(np.concatenate(ids), rows, most):
                values = [[x] for x in tile]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[0], pa.binary()), pa.array(values[1], pa.int32()), pa.array(values[2], pa.binary())],
                    names=names,
                )

        for batch in batches:
            vectors = batch.column(1)
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(vectors.value_lengths().to_numpy(zero_copy_only=False))
            every = batch.column(0).to_numpy(zero_copy_only=False)
            for a in range(0, batch.num_rows, most):
                b = min(a + most, batch.num_rows)
                part = np.split(flat[ends[a - 1] if a else 0 : ends[b - 1]], (ends[a : b - 1] - (ends[a - 1] if a else 0)))
                ids.append(every[a:b])
                rows += part
                held += b - a
                if held >= most:
                    yield from flush()
                    ids.clear()
                    rows.clear()
                    held = 0
        if held:
            yield from flush()

    packed = df.select("vec_id", "embedding").mapInArrow(run, TILE)
    return materialize(packed.withColumn("tile", F.monotonically_increasing_id()), "tiles")


def _matrix(ids: np.ndarray, dim: int, data: bytes, width: int) -> np.ndarray:
    m = np.frombuffer(data, np.float64).reshape(len(ids), dim)
    return m if dim == width else np.pad(m, ((0, 0), (0, width - dim)))


def tile_best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) of one tile for each query; ``ids`` ascend. Unused places have score NONE."""
    n, width = len(q_ids), min(k, len(ids))
    out_ids, out_scores = np.zeros((n, k), np.int64), np.full((n, k), NONE, np.int64)
    limit = np.abs(q).max(initial=0.0) * np.abs(m).max(initial=0.0) * max(1, q.shape[1])
    own = np.searchsorted(ids, q_ids)
    has_own = (own < len(ids)) & (ids[np.minimum(own, len(ids) - 1)] == q_ids)
    if limit * len(ids) >= EXACT / 2:
        return _tile_best_exact(q_ids, q, ids, m, k)
    for a in range(0, n, STRIPE):
        b = min(a + STRIPE, n)
        key = (q[a:b] @ m.T) * len(ids) - np.arange(len(ids))  # equal scores: the smaller id first
        mine = np.flatnonzero(has_own[a:b])
        key[mine, own[a:b][mine]] = -np.inf
        if width < len(ids):
            at = np.argpartition(-key, width - 1, axis=1)[:, :width]
        else:
            at = np.broadcast_to(np.arange(len(ids)), key.shape)
        best = np.take_along_axis(key, at, 1)
        real = np.isfinite(best)
        scores = np.ceil(np.where(real, best, 0) / len(ids))
        out_ids[a:b, :width] = ids[at]
        out_scores[a:b, :width] = np.where(real, scores, 0).astype(np.int64)
        out_scores[a:b, :width][~real] = NONE
    return out_ids, out_scores


def _tile_best_exact(q_ids, q, ids, m, k):
    """The same in whole numbers of any size, for components beyond what floating point adds exactly."""
    out_ids, out_scores = np.zeros((len(q_ids), k), np.int64), np.full((len(q_ids), k), NONE, np.int64)
    top = np.iinfo(np.int64).max - 1  # still above what marks an unused place
    rows = [[int(x) for x in r] for r in m]
    for i, (own, vector) in enumerate(zip(q_ids.tolist(), q)):
        left = [int(x) for x in vector]
        scored = ((sum(map(int.__mul__, left, r)), c) for c, r in zip(ids.tolist(), rows) if c != own)
        for j, (score, c) in enumerate(heapq.nsmallest(k, scored, key=lambda x: (-x[0], x[1]))):
            out_ids[i, j], out_scores[i, j] = c, max(-top, min(top, score))
    return out_ids, out_scores


def merge_lists(parts: list[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of several lists per query, best first, an id once; ties to the smaller id."""
    ids, scores = np.hstack([p[0] for p in parts]), np.hstack([p[1] for p in parts])
    order = np.lexsort((ids, -np.maximum(scores, NONE + 1)), axis=1)
    ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    by_id = np.argsort(ids, axis=1, kind="stable")  # equal ids keep their order: the best first
    sorted_ids = np.take_along_axis(ids, by_id, 1)
    used = np.take_along_axis(scores, by_id, 1) > NONE
    again = np.zeros_like(used)
    again[:, 1:] = (sorted_ids[:, 1:] == sorted_ids[:, :-1]) & used[:, 1:] & used[:, :-1]
    repeated = np.zeros_like(again)
    np.put_along_axis(repeated, by_id, again, 1)
    if repeated.any():
        scores = np.where(repeated, NONE, scores)
        order = np.lexsort((ids, -np.maximum(scores, NONE + 1)), axis=1)
        ids, scores = np.take_along_axis(ids, order, 1), np.take_along_axis(scores, order, 1)
    if ids.shape[1] < k:
        pad = k - ids.shape[1]
        ids, scores = np.pad(ids, ((0, 0), (0, pad))), np.pad(scores, ((0, 0), (0, pad)), constant_values=NONE)
    return np.ascontiguousarray(ids[:, :k]), np.ascontiguousarray(scores[:, :k])


def _list_table(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    names = ["line", "cell", "queries", "ids", "scores"]
    columns = list(zip(*rows)) if rows else [[]] * len(kinds)
    return pa.Table.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)


def top_k(rows: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k rows with the largest inner product for each query: ``query_id, rank, vec_id, score``.

    Both tables have ``vec_id, embedding``. A row never answers a query of its
    own id; ties go to the smaller id; queries with fewer candidates get all.
    Components are ``floor(64 * x)`` and scores exact whole numbers, cut to the
    range of a long. Rows without id, and vectors that are null or hold null,
    NaN or infinite components, take no part. Shorter vectors are filled up with
    zeros, an empty one too. Equal rows count once; of several vectors of one id
    the best answers, and the smallest asks. Other columns are ignored; either
    table may be empty.
    """
    fine = rows.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", "embedding")
    asking = queries.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    asking = asking.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    tiles = pack(fine, TILE_ROWS)
    asked = pack(asking, QUERY_ROWS)
    lines, columns = max(1, asked.count()), max(1, -(-tiles.count() // CELL_TILES))

    left = asked.select(
        "tile", "ids", "dim", "matrix",
        F.pmod(F.xxhash64("ids"), F.lit(lines)).cast("int").alias("line"),
        F.explode(F.sequence(F.lit(0), F.lit(columns - 1))).alias("cell"),
    )
    right = tiles.select(
        "ids", "dim", "matrix",
        F.pmod(F.xxhash64("ids"), F.lit(columns)).cast("int").alias("cell"),
        F.explode(F.sequence(F.lit(0), F.lit(lines - 1))).alias("line"),
    )

    def meet(some: pa.Table, others: pa.Table) -> pa.Table:
        found = []
        for query in some.to_pylist():
            q_ids = np.frombuffer(query["ids"], np.int64)
            parts = []
            for tile in others.select(["ids", "dim", "matrix"]).to_pylist():
                ids, width = np.frombuffer(tile["ids"], np.int64), max(query["dim"], tile["dim"])
                q = _matrix(q_ids, query["dim"], query["matrix"], width)
                parts.append(tile_best(q_ids, q, ids, _matrix(ids, tile["dim"], tile["matrix"], width), k))
            if parts:
                ids, scores = merge_lists(parts, k)
                found.append((query["tile"], query["cell"], query["ids"], ids.tobytes(), scores.tobytes()))
        return _list_table(found)

    def merge(group: pa.Table) -> pa.Table:
        lists = group.to_pylist()
        n = len(np.frombuffer(lists[0]["queries"], np.int64))
        shape = (n, k)
        parts = [
            (np.frombuffer(x["ids"], np.int64).reshape(shape), np.frombuffer(x["scores"], np.int64).reshape(shape))
            for x in lists
        ]
        ids, scores = merge_lists(parts, k)
        first = lists[0]
        return _list_table([(first["line"], first["cell"], first["queries"], ids.tobytes(), scores.tobytes())])

    lists = left.groupBy("line", "cell").cogroup(right.groupBy("line", "cell")).applyInArrow(meet, LISTS)
    while columns > 1:
        columns = -(-columns // FAN_IN)
        lists = (
            lists.withColumn("cell", F.floor(F.col("cell") / FAN_IN).cast("int"))
            .groupBy("line", "cell")
            .applyInArrow(merge, LISTS)
        )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in batch.to_pylist():
                q_ids = np.frombuffer(x["queries"], np.int64)
                scores = np.frombuffer(x["scores"], np.int64).reshape(len(q_ids), k)
                ids = np.frombuffer(x["ids"], np.int64).reshape(len(q_ids), k)
                used = scores > NONE
                rank = np.broadcast_to(np.arange(1, k + 1, dtype=np.int32), used.shape)
                yield pa.RecordBatch.from_arrays(
                    [np.repeat(q_ids, used.sum(1)), rank[used], ids[used], scores[used]],
                    names=["query_id", "rank", "vec_id", "score"],
                )

    return lists.mapInArrow(unpack, "query_id bigint, rank int, vec_id bigint, score bigint")
