"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams.

Letters are lower-cased, everything else is a gap, and all n-grams of one to
three characters are hashed to bins. Document frequencies of the bins are
counted over all documents that may be learnt from. The model is trained on a
bounded sample of them, balanced between languages, by follow the regularised
leader with L1 and L2 penalties; a slice of the sample sets the temperature
that makes its probabilities honest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapakdw.llm.bpe import LETTER, code_classes, text_slices
from lapakdw.llm.sampling import hash_share, held_out, learnable

BINS = 1 << 15
# Documents of each language that the model is fitted on, about.
FIT_PER_LANGUAGE = 900
CALIBRATION_SHARE = 0.2
EPOCHS = 4
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.02

UNDETERMINED = "und"
# Documents below this probability are rejected where languages filter.
MIN_SCORE = 0.5

# Characters handled at once.
CHUNK_CHARS = 500_000

# Letters added to the length that n-gram counts are divided by, so that short texts say less.
PRIOR_LETTERS = 20

_GAP = 2  # gaps between texts, so that no n-gram spans two of them
_MIX = [np.uint32(x) for x in (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35, 0x27D4EB2F, 0x165667B1, 0xD3A2646D)]


def _bin(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint32(15)
    h *= np.uint32(0x2C1B3C6D)
    return h >> np.uint32(17)


def gram_bins(texts: list[str]) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each order the bins of the n-grams (BINS for gaps only) and where each text's begin; letters per text.

    The n-grams of a text include those that reach into the gaps around it.
    """
    lowered = [t.lower() for t in texts]
    gap = "\0" * _GAP
    codes = np.frombuffer((gap + gap.join(lowered) + gap).encode("utf-32-le"), "<u4")
    lengths = np.array([len(t) + _GAP for t in lowered], np.int64)
    starts = _GAP + np.cumsum(lengths) - lengths
    letter = code_classes().take(codes) == LETTER
    c = np.where(letter, codes, np.uint32(0))
    letters = np.add.reduceat(letter, starts, dtype=np.int64)
    one = _bin(c * _MIX[0])
    two = _bin(c[:-1] * _MIX[1] + c[1:] * _MIX[2])
    three = _bin(c[:-2] * _MIX[3] + c[1:-1] * _MIX[4] + c[2:] * _MIX[5])
    gaps = ~letter
    one[gaps] = BINS
    two[gaps[:-1] & gaps[1:]] = BINS
    three[gaps[:-2] & gaps[1:-1] & gaps[2:]] = BINS
    return [one, two, three], [starts, starts - 1, starts - 2], letters


def _per_text(bins: list[np.ndarray], starts: list[np.ndarray]) -> Iterator[np.ndarray]:
    edges = [np.append(s, len(b)) for b, s in zip(bins, starts)]
    for i in range(len(starts[0])):
        yield np.concatenate([b[e[i] : e[i + 1]] for b, e in zip(bins, edges)])


@dataclass(frozen=True)
class LanguageModel:
    """Weights of languages by bin, with the inverse document frequency and the temperature in them."""

    languages: list[str]
    weights: np.ndarray  # (BINS + 1, languages); the last row, for gaps, is zero
    bias: np.ndarray

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        bins, starts, letters = gram_bins(texts)
        total = np.zeros((len(texts), len(self.languages)))
        for b, at in zip(bins, starts):
            total += np.add.reduceat(self.weights.take(b, axis=0), at, axis=0)
        return total * (100.0 / (letters + PRIOR_LETTERS))[:, None] + self.bias, letters

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        logits, letters = self.logits(texts)
        logits -= logits.max(axis=1, keepdims=True)
        best = logits.argmax(axis=1)
        score = 1.0 / np.exp(logits).sum(axis=1)
        found = [self.languages[b] if n else UNDETERMINED for b, n in zip(best.tolist(), letters.tolist())]
        return found, np.where(letters > 0, score, 0.0)


def document_frequencies(df: DataFrame) -> tuple[int, np.ndarray]:
    """Documents, and documents that hold each bin. Tasks count into one array each; arrays are added in a tree."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(BINS + 1, np.int64), 0
        for batch in batches:
            seen += batch.num_rows
            for _, _, texts in text_slices(batch.column(0), CHUNK_CHARS):
                bins, starts, _ = gram_bins(texts)
                for mine in _per_text(bins, starts):
                    total += np.bincount(mine, minlength=BINS + 1) > 0
        total[BINS] = seen
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist())
        return pa.table({"counts": pa.array([total.tobytes()], pa.binary())})

    counts = df.select("text").mapInArrow(count, "counts binary")
    for width in (256, 16, 1):
        counts = (
            counts.select("counts", F.pmod(F.xxhash64("counts"), F.lit(width)).alias("lot"))
            .groupBy("lot")
            .applyInArrow(add, "counts binary")
        )
    rows = counts.collect()  # one row of fixed size
    total = np.frombuffer(bytes(rows[0]["counts"]), np.int64) if rows else np.zeros(BINS + 1, np.int64)
    return int(total[BINS]), total[:BINS]


def sample(df: DataFrame) -> list[tuple[str, float, np.ndarray, np.ndarray, int]]:
    """(language, share, bins, counts, letters) of about FIT_PER_LANGUAGE documents of each language.

    A document is in if the hash of its id is below a share that follows from
    how many documents its language has. Repeated ids count once.
    """
    sizes = {r["lang"]: r["count"] for r in df.groupBy("lang").count().collect()}
    if not sizes:
        return []
    share = F.element_at(
        F.map_from_arrays(
            F.array(*(F.lit(lang) for lang in sizes)),
            F.array(*(F.lit(min(1.0, FIT_PER_LANGUAGE / n)) for n in sizes.values())),
        ),
        F.col("lang"),
    )
    drawn = df.where(hash_share(F.col("doc_id"), 1) < share).select("doc_id", "lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(2), CHUNK_CHARS):
                bins, starts, letters = gram_bins(texts)
                found = [np.unique(mine[mine < BINS], return_counts=True) for mine in _per_text(bins, starts)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(a, b - a) for i in (0, 1)),
                        pa.array([x.astype(np.int32).tobytes() for x, _ in found], pa.binary()),
                        pa.array([n.astype(np.int32).tobytes() for _, n in found], pa.binary()),
                        pa.array(letters),
                    ],
                    names=["doc_id", "lang", "bins", "counts", "letters"],
                )

    schema = "doc_id bigint, lang string, bins binary, counts binary, letters bigint"
    counted = drawn.mapInArrow(count, schema).where("letters > 0")
    one = counted.groupBy("doc_id").agg(F.min(F.struct("lang", "bins", "counts", "letters")).alias("x"))
    rows = one.select("x.*", hash_share(F.col("doc_id"), 2).alias("share")).collect()  # bounded by the sample
    rows.sort(key=lambda r: (r["share"], r["lang"]))
    return [
        (
            r["lang"],
            r["share"],
            np.frombuffer(bytes(r["bins"]), np.int32),
            np.frombuffer(bytes(r["counts"]), np.int32),
            r["letters"],
        )
        for r in rows
    ]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(examples: list[tuple[int, np.ndarray, np.ndarray]], classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal with elastic-net penalties, over the examples in order, again and again."""
    z, n = np.zeros((BINS, classes)), np.zeros((BINS, classes))
    zb, nb = np.zeros(classes), np.zeros(classes)

    def solve(z: np.ndarray, n: np.ndarray, l1: float) -> np.ndarray:
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    for _ in range(EPOCHS):
        for label, at, x in examples:
            zi, ni = z[at], n[at]
            w, b = solve(zi, ni, L1), solve(zb, nb, 0.0)
            wrong = _softmax(x @ w + b)
            wrong[label] -= 1.0
            g = x[:, None] * wrong
            grown = ni + g * g
            z[at] = zi + g - (np.sqrt(grown) - np.sqrt(ni)) / ALPHA * w
            n[at] = grown
            grown = nb + wrong * wrong
            zb += wrong - (np.sqrt(grown) - np.sqrt(nb)) / ALPHA * b
            nb = grown
    return solve(z, n, L1), solve(zb, nb, 0.0)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits, at least 1, under which the labels are likeliest."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / t)[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    return min(np.geomspace(1.0, 20.0, 60).tolist(), key=lambda t: (loss(t), abs(np.log(t))))


def fit(documents: DataFrame) -> LanguageModel:
    """A model of the languages in ``lang``, learnt from texts whose language is known and which are not held out."""
    usable = documents.where(F.col("lang").isNotNull() & learnable(F.col("doc_id"))).select("doc_id", "lang", "text")
    docs, frequency = document_frequencies(usable)
    rows = sample(usable)
    languages = sorted({r[0] for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((BINS + 1, 0), np.float32), np.zeros(0))
    idf = np.log((1.0 + docs) / (1.0 + frequency)) + 1.0
    place = {name: i for i, name in enumerate(languages)}
    data = [(place[lang], at, counts * idf[at] * (100.0 / (letters + PRIOR_LETTERS))) for lang, _, at, counts, letters in rows]
    cut = int(len(data) * CALIBRATION_SHARE) if len(data) >= 20 else 0
    weights, bias = ftrl(data[cut:], len(languages))
    logits = np.array([x @ weights[at] + bias for _, at, x in data[:cut]]).reshape(cut, len(languages))
    heat = temperature(logits, np.array([label for label, _, _ in data[:cut]], int))
    scaled = np.zeros((BINS + 1, len(languages)), np.float32)
    scaled[:BINS] = weights * idf[:, None] / heat
    return LanguageModel(languages, scaled, bias / heat)


def identify(documents: DataFrame, model: LanguageModel) -> DataFrame:
    """``doc_id, lang_pred, score`` of each text.

    Null texts and texts without a letter are ``und`` with score 0. Whole texts
    are read; rows keep their number. Other columns are ignored.
    """
    taken = documents.select("doc_id", "text")
    schema = T.StructType(
        [taken.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), CHUNK_CHARS):
                found, score = model.predict(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(found, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return taken.mapInArrow(run, schema)


def predictions(documents: DataFrame) -> DataFrame:
    """Fit on the documents that are not held out, and predict all: ``doc_id, held_out, lang_pred, score``."""
    found = identify(documents, fit(documents))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def keep_identified(documents: DataFrame) -> DataFrame:
    """The documents in a language that is identified with some certainty, with all their columns."""
    model = fit(documents)
    place = documents.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(place), CHUNK_CHARS):
                found, score = model.predict(texts)
                sure = [lang != UNDETERMINED and p >= MIN_SCORE for lang, p in zip(found, score.tolist())]
                yield batch.slice(a, b - a).filter(pa.array(sure, pa.bool_()))

    return documents.mapInArrow(run, documents.schema)
