"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of shape measures. The model is a sum of lookup
tables, one per measure and one per chosen pair of measures, whose value for a
text goes through the logistic function. Tables are learnt by cyclic boosting:
round after round, each table in turn is moved a little by a shallow tree that
is grown on the binned gradients. Scoring finds bins and adds table entries for
whole batches at once.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapakdw.llm.bpe import text_slices
from lapakdw.llm.sampling import hash_share, held_out, learnable
from lapakdw.llm.text import broadcast_if_measured
from lapakdw.runtime import materialize

# Labelled documents that the model is fitted on, about.
FIT_ROWS = 12_000
BINS, PAIR_BINS, PAIRS = 48, 12, 6
ROUNDS, PAIR_ROUNDS, RATE = 240, 80, 0.12
LEAVES, LEAST, RIDGE = 3, 8.0, 1.0

THRESHOLD = 0.7

MEASURES = (
    "log_chars", "word_chars", "distinct_words", "capitals", "digits", "symbols", "stops", "calls", "top_word",
    "symbol_ends", "line_words", "repeated_lines", "short_words", "long_words", "twins", "beyond_ascii", "bars",
    "sentence_starts", "top_line",
)

# Classes of characters: small letters, capitals, digits, blanks, sentence marks, calls, bars, other ASCII, beyond.
SMALL, CAPITAL, DIGIT, BLANK, STOP, CALL, BAR, SYMBOL, WIDE = range(9)
_classes = np.full(129, SYMBOL, np.uint8)
for _chars, _value in (
    ("abcdefghijklmnopqrstuvwxyz", SMALL),
    ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", CAPITAL),
    ("0123456789", DIGIT),
    (" \t\r\n\f\v", BLANK),
    (".,;:?'\"()-", STOP),
    ("!", CALL),
    ("|", BAR),
):
    _classes[[ord(c) for c in _chars]] = _value
_classes[128] = WIDE


def measure(text: str) -> list[float]:
    """The measures of one text. All are 0 for an empty one."""
    if not text:
        return [0.0] * len(MEASURES)
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    kinds = np.bincount(_classes.take(np.minimum(codes, 128)), minlength=9).tolist()
    solid = max(1, len(codes) - kinds[BLANK])
    letters = max(1, kinds[SMALL] + kinds[CAPITAL] + kinds[WIDE])
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line]
    m = max(1, len(lines))
    line_counts = Counter(lines)
    ends = Counter([w[-1] for w in words])
    symbol_ends = sum(c for e, c in ends.items() if not e.isalnum() and e not in ".,;:?'\")-")
    return [
        float(np.log1p(len(codes))),
        float(lengths.mean()) if len(words) else 0.0,
        len(counts) / n,
        kinds[CAPITAL] / letters,
        kinds[DIGIT] / solid,
        kinds[SYMBOL] / solid,
        kinds[STOP] / solid,
        kinds[CALL] / solid,
        max(counts.values(), default=0) / n,
        symbol_ends / n,
        float(np.log1p(n / m)),
        1.0 - len(line_counts) / m if lines else 0.0,
        float((lengths <= 2).mean()) if len(words) else 0.0,
        float((lengths > 14).mean()) if len(words) else 0.0,
        sum(map(str.__eq__, words, words[1:])) / n,
        kinds[WIDE] / letters,
        kinds[BAR] / solid,
        text.count(". ") / n,
        max(map(len, line_counts), default=0) / max(1, len(codes)),
    ]


def _shallow_tree(gradient: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Step for each bin: the leaf values of a tree with at most LEAVES leaves over ordered bins."""
    pieces = [(0, len(gradient))]
    g, h = np.concatenate([[0.0], gradient.cumsum()]), np.concatenate([[0.0], weight.cumsum()])

    def worth(a: int | np.ndarray, b: int | np.ndarray) -> float | np.ndarray:
        return (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)

    while len(pieces) < LEAVES:
        best = (1e-9, None, None)
        for place, (a, b) in enumerate(pieces):
            cuts = np.arange(a + 1, b)
            if len(cuts):
                gain = worth(a, cuts) + worth(cuts, b) - worth(a, b)
                gain[(h[cuts] - h[a] < LEAST / 4) | (h[b] - h[cuts] < LEAST / 4)] = 0.0
                top = int(gain.argmax())
                if gain[top] > best[0]:
                    best = (gain[top], place, int(cuts[top]))
        if best[1] is None:
            break
        a, b = pieces[best[1]]
        pieces[best[1] : best[1] + 1] = [(a, best[2]), (best[2], b)]
    step = np.empty(len(gradient))
    for a, b in pieces:
        step[a:b] = (g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return step


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best split of a two-way table by one cut each way: how much it gains, and the step of each cell."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    n = len(gradient)
    c = np.arange(1, n)

    def parts(t: np.ndarray) -> list[np.ndarray]:
        low, left, top, all_ = t[np.ix_(c, c)], t[c, n][:, None], t[n, c][None, :], t[n, n]
        return [low, left - low, top - low, all_ - left - top + low]

    gain = sum(a * a / (b + RIDGE) for a, b in zip(parts(g), parts(h)))
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    values = [a[i, j] / (b[i, j] + RIDGE) for a, b in zip(parts(g), parts(h))]
    step = np.empty_like(gradient)
    i, j = i + 1, j + 1
    step[:i, :j], step[:i, j:], step[i:, :j], step[i:, j:] = values
    return float(gain.max() - g[n, n] ** 2 / (h[n, n] + RIDGE)), step


@dataclass(frozen=True)
class AdditiveModel:
    """Edges of the bins, lookup tables of measures and of pairs, and the constant term."""

    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]
    constant: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.constant)
        for f, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table.take(np.searchsorted(edges, rows[:, f], "right"))
        for i, j, table in self.pairs:
            a = np.searchsorted(self.coarse[i], rows[:, i], "right")
            total += table[a, np.searchsorted(self.coarse[j], rows[:, j], "right")]
        return 1.0 / (1.0 + np.exp(-total))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def fit_rows(rows: np.ndarray, labels: np.ndarray) -> AdditiveModel:
    """Cyclic boosting of the tables on one row of measures and one label (0 or 1) per text."""
    wide = rows.shape[1]
    share = (labels.sum() + 0.5) / (len(labels) + 1.0)
    constant = float(np.log(share / (1 - share)))
    if not len(labels):
        return AdditiveModel([np.zeros(0)] * wide, [np.zeros(1)] * wide, [np.zeros(0)] * wide, [], constant)
    edges = [_edges(rows[:, f], BINS) for f in range(wide)]
    coarse = [_edges(rows[:, f], PAIR_BINS) for f in range(wide)]
    at = [np.searchsorted(e, rows[:, f], "right") for f, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(labels), constant)

    def state() -> tuple[np.ndarray, np.ndarray]:
        p = 1.0 / (1.0 + np.exp(-total))
        return labels - p, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for f in range(wide):
            residual, weight = state()
            size = len(tables[f])
            step = RATE * _shallow_tree(
                np.bincount(at[f], residual, size), np.bincount(at[f], weight, size)
            )
            tables[f] += step
            total += step.take(at[f])

    near = [np.searchsorted(e, rows[:, f], "right") for f, e in enumerate(coarse)]

    def table_of(i: int, j: int) -> tuple[float, np.ndarray]:
        residual, weight = state()
        cell, size = near[i] * PAIR_BINS + near[j], PAIR_BINS * PAIR_BINS
        shape = (PAIR_BINS, PAIR_BINS)
        return _quadrants(
            np.bincount(cell, residual, size).reshape(shape), np.bincount(cell, weight, size).reshape(shape)
        )

    ranked = sorted(((-table_of(i, j)[0], i, j) for i in range(wide) for j in range(i)))[:PAIRS]
    pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in ranked]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in pairs:
            step = RATE * table_of(i, j)[1]
            table += step
            total += step[near[i], near[j]]
    return AdditiveModel(edges, tables, coarse, pairs, constant)


MEASURED = T.ArrayType(T.DoubleType())


@F.arrow_udf(MEASURED)
def measures(text: pa.Array) -> pa.Array:
    rows = [measure(t) for _, _, texts in text_slices(text) for t in texts]
    return pa.array(rows, pa.list_(pa.float64()))


def fit(documents: DataFrame, labels: DataFrame) -> AdditiveModel:
    """A model learnt from about FIT_ROWS labelled documents that are not held out.

    A document is in the sample if the hash of its id is below a share that
    follows from how many labels there are. Of several labels of an id the
    smallest counts, and of several texts the one with the smallest measures.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1) & learnable(F.col("doc_id")))
        .groupBy(F.col("doc_id").alias("id"))
        .agg(F.min("quality").alias("label"))
    )
    share = min(1.0, FIT_ROWS / max(1, known.count()))
    drawn = materialize(known.where(hash_share(F.col("id"), 3) < share), "labelled")
    texts = documents.select("doc_id", "text").join(broadcast_if_measured(drawn), F.col("doc_id") == F.col("id"))
    rows = (
        texts.select("doc_id", "label", measures(F.col("text")).alias("row"))
        .groupBy("doc_id")
        .agg(F.min(F.struct("row", "label")).alias("x"))
        .select("doc_id", "x.*")
        .collect()  # bounded by the sample
    )
    rows.sort(key=lambda r: r["doc_id"])
    table = np.array([r["row"] for r in rows], float).reshape(len(rows), len(MEASURES))
    return fit_rows(table, np.array([r["label"] for r in rows], float))


def score_quality(documents: DataFrame, model: AdditiveModel) -> DataFrame:
    """``doc_id, score`` of each text, from 0 to 1; higher where good quality is likelier."""
    taken = documents.select("doc_id", "text")
    schema = T.StructType([taken.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([measure(t) for _, _, texts in text_slices(batch.column(1)) for t in texts])
            score = model.score(rows.reshape(batch.num_rows, len(MEASURES)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], names=["doc_id", "score"])

    return taken.mapInArrow(run, schema)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Fit, and score all documents: ``doc_id, held_out, score, predicted``.

    Null and empty texts are scored by their measures, which are all 0. Rows
    keep their number; a null id is scored but never learnt from. Without
    labels every score is one half. Other columns are ignored.
    """
    scored = score_quality(documents, fit(documents, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
