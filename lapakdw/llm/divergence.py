"""Source divergence audit: how far the sources of a language differ in their vocabulary.

Tasks fold whole documents into stripes: a hash table from (language, term) to
the number of documents and the occurrences per source. A table that grows past
a bound is spilled as rows and begun anew. The shuffle sorts all stripes by key;
terms of fewer documents than asked for are left out by a sum over the key, and
a merging task adds up neighbours, one stripe at a time.

The merged stripes then emit divergences directly. A cell is a stretch of a
language's terms (by hash) and a block of its sources against another; tasks
sum a cell's contributions in an integer matrix and keep the best terms of each
source. The shares of a language's terms that a source lacks are all alike, so
a cell only needs the terms that occur in it and a multiple of the rest.

All arithmetic is in whole numbers: a share is one plus the floor of 10**9 times
(count + 1) over (all counts + terms), a contribution the floor of
(p - q)**2 / q. Shares are divided in three steps of 1000, which is exact up to
9 * 10**15 occurrences.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapakdw.llm.text import broadcast_if_measured
from lapakdw.runtime import materialize

# A term is a run of letters A-Z and of characters beyond ASCII,
# here as UTF-8 in lower case; it counts from three documents of a language on,
# and the 200 that stand out most are listed.
TERM = re.compile(rb"[a-z\x80-\xff]+")
LEAST_DOCS = 3
LISTED = 200
STEPS = 3  # of a thousand: shares are in thousand millionths

# Estimated bytes of stripes a task holds before it spills them, and of an entry beside its term.
HELD_BYTES = 96_000_000
STRIPE_BYTES, ENTRY_BYTES = 300, 80
# Text that is searched at once; longer texts are walked match by match.
WHOLE_BYTES = 1_000_000
# Stripes in an Arrow batch, terms and sources of a cell, and numbers in a block of its arithmetic.
BATCH_ROWS = 10_000
CELL_TERMS = 50_000
CELL_SOURCES = 256
BLOCK_NUMBERS = 1_000_000

STRIPE = "lang string, term string, docs bigint, sources array<string>, counts array<bigint>"
MERGED = STRIPE + ", total bigint"
EMITTED = "lang string, source string, part string, item string, value bigint"
PAIR, OUTSTANDING = "pair", "term"


def _lists(lengths: list[int], values: list, dtype: pa.DataType) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, dtype))


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).view(pa.string())


class Stripes:
    """The stripes of a task: language, term, and under it the occurrences by source and the documents under None."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.held: dict[str, dict[bytes, dict[str | None, int]]] = {}
        self.bytes = 0

    def fold(self, lang: str, source: str, text: bytes) -> None:
        text = text.lower()  # of bytes: A-Z alone
        if len(text) <= WHOLE_BYTES:
            counts = Counter(TERM.findall(text))
        else:
            counts = Counter(m.group() for m in TERM.finditer(text))
        stripes = self.held.setdefault(lang, {})
        for term, n in counts.items():
            stripe = stripes.get(term)
            if stripe is None:
                stripes[term] = {None: 1, source: n}
                self.bytes += STRIPE_BYTES + len(term)
            else:
                stripe[None] += 1
                if source in stripe:
                    stripe[source] += n
                else:
                    stripe[source] = n
                    self.bytes += ENTRY_BYTES

    def spill(self) -> Iterator[pa.RecordBatch]:
        for lang, stripes in self.held.items():
            terms = list(stripes)
            for a in range(0, len(terms), BATCH_ROWS):
                part = terms[a : a + BATCH_ROWS]
                found = [stripes[t] for t in part]
                docs = [s.pop(None) for s in found]
                lengths = [len(s) for s in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(part), pa.string()),
                        _strings(part),
                        pa.array(docs, pa.int64()),
                        _lists(lengths, [name for s in found for name in s], pa.string()),
                        _lists(lengths, [n for s in found for n in s.values()], pa.int64()),
                    ],
                    names=["lang", "term", "docs", "sources", "counts"],
                )
        self.clear()


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stripes, names = Stripes(), {}
    for batch in batches:
        langs, sources = (batch.column(i).to_pylist() for i in (0, 1))
        texts = batch.column(2).view(pa.binary())
        for i, (lang, source) in enumerate(zip(langs, sources)):
            stripes.fold(lang, names.setdefault(source, source), texts[i].as_py())
            if stripes.bytes > HELD_BYTES:
                yield from stripes.spill()
                names = {}
    yield from stripes.spill()


def _merge(least_docs: int):
    """Adds up the neighbouring stripes of one key, in sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, sums = None, 0, {}
        done: list[tuple] = []

        def flush() -> pa.RecordBatch:
            lengths = [len(s) for *_, s in done]
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k, *_ in done], pa.string()),
                    pa.array([k[1] for k, *_ in done], pa.string()),
                    pa.array([d for _, d, _ in done], pa.int64()),
                    _lists(lengths, [name for *_, s in done for name, _ in s], pa.string()),
                    _lists(lengths, [n for *_, s in done for _, n in s], pa.int64()),
                    pa.array([sum(n for _, n in s) for *_, s in done], pa.int64()),
                ],
                names=["lang", "term", "docs", "sources", "counts", "total"],
            )
            done.clear()
            return batch

        for batch in batches:
            for a in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(a, BATCH_ROWS)
                ends = np.cumsum(part.column(3).value_lengths().to_numpy()).tolist()
                names, counts = part.column(3).flatten().to_pylist(), part.column(4).flatten().to_pylist()
                begin = 0
                for lang, term, d, end in zip(*(part.column(i).to_pylist() for i in range(3)), ends):
                    if (lang, term) != key:
                        if docs >= least_docs:
                            done.append((key, docs, sorted(sums.items())))
                            if len(done) >= BATCH_ROWS:
                                yield flush()
                        key, docs, sums = (lang, term), 0, {}
                    docs += d
                    for name, n in zip(names[begin:end], counts[begin:end]):
                        sums[name] = sums.get(name, 0) + n
                    begin = end
        if docs >= least_docs:
            done.append((key, docs, sorted(sums.items())))
        if done:
            yield flush()

    return run


def term_stripes(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Merged stripes: ``lang, term, docs, sources, counts, total`` of every term in ``least_docs`` documents or more.

    Every row is a document. Null texts, languages and sources are empty;
    ``sources`` and ``counts`` are in the order of the names.
    """
    taken = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    documents = F.sum("docs").over(Window.partitionBy("lang", "term"))
    sorted_runs = taken.mapInArrow(_fold, STRIPE).withColumn("_documents", documents)
    often = sorted_runs.where(F.col("_documents") >= least_docs).drop("_documents")
    return often.sortWithinPartitions("lang", "term").mapInArrow(_merge(least_docs), MERGED)


def source_totals(docs: DataFrame, stripes: DataFrame) -> DataFrame:
    """Every occurring (lang, source) with its kept occurrences ``n``, those of the language, and its terms ``v``."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    entries = stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
    counted = entries.groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n"))
    spoken = stripes.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    groups = docs.select(*names).distinct().join(counted, ["lang", "source"], "left").join(spoken, "lang", "left")
    return groups.fillna(0, ["n", "lang_n", "v"])


def shares(counts: np.ndarray, under: np.ndarray | int) -> np.ndarray:
    """One plus the floor of 10**9 * (count + 1) / under."""
    rest = counts + 1
    found = np.zeros_like(rest)
    for _ in range(STEPS):
        rest = rest * 1000
        found = found * 1000 + rest // under
        rest = rest % under
    return found + 1


def contributions(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    gap = p - q
    return gap * gap // q


def _best(kept: list[tuple[int, str]], values: np.ndarray, terms: np.ndarray) -> list[tuple[int, str]]:
    """The ``LISTED`` largest of both, as (value negated, term); of equals the smaller term."""
    if len(values) > LISTED:
        chosen = values >= np.partition(values, len(values) - LISTED)[len(values) - LISTED]
        values, terms = values[chosen], terms[chosen]
    return heapq.nsmallest(LISTED, [*kept, *zip((-values).tolist(), terms.tolist())])


def _emit(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
    """The divergences a cell contributes to. ``left`` are its stripes, ``right`` the sources of both its blocks."""
    lang, block_a, block_b, stretch = (k.as_py() for k in key)
    right = right.sort_by("source")
    names, blocks = right["source"].to_pylist(), right["block"].to_numpy()
    a, b = np.flatnonzero(blocks == block_a), np.flatnonzero(blocks == block_b)
    v, lang_n = (right[c][0].as_py() if names else 0 for c in ("v", "lang_n"))
    rows: list[tuple] = []
    if names and v == 0:
        rows = [(names[i], PAIR, names[j], 0) for i in a for j in b if i != j and stretch == 0]
    elif names:
        under = right["n"].to_numpy() + v
        absent = shares(np.zeros(len(names), np.int64), under)
        missing = contributions(absent[a][:, None], absent[b][None, :])
        sums = missing * ((v if stretch == 0 else 0) - left.num_rows)
        best: list[list] = [[] for _ in a]
        place = {name: i for i, name in enumerate(names)}
        step = max(1, BLOCK_NUMBERS // len(names))
        for batch in left.combine_chunks().to_batches(max_chunksize=step):
            lists = batch.column("sources")
            coded = lists.flatten().dictionary_encode()
            where = np.array([place[name] for name in coded.dictionary.to_pylist()], np.int64)
            counts = np.zeros((batch.num_rows, len(names)), np.int64)
            row = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
            counts[row, where.take(coded.indices.to_numpy())] = batch.column("counts").flatten().to_numpy()
            p = shares(counts, under)
            against = p[:, b]
            for k, i in enumerate(a):
                sums[k] += contributions(p[:, i : i + 1], against).sum(0)
            if block_a == block_b:
                q = shares(batch.column("total").to_numpy(), lang_n + v)
                terms = np.array(batch.column("term").to_pylist(), object)
                for k, i in enumerate(a):
                    out = (counts[:, i] > 0) & (p[:, i] > q)
                    best[k] = _best(best[k], contributions(p[out, i], q[out]), terms[out])
        rows = [(names[i], PAIR, names[j], int(sums[k, m])) for k, i in enumerate(a) for m, j in enumerate(b) if i != j]
        rows += [(names[i], OUTSTANDING, term, -value) for k, i in enumerate(a) for value, term in best[k]]
    columns = list(zip(*rows)) or [(), (), (), ()]
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    return pa.table(
        [pa.array([lang] * len(rows), pa.string()), *(pa.array(c, k) for c, k in zip(columns, kinds))],
        names=["lang", "source", "part", "item", "value"],
    )


def divergences(stripes: DataFrame, totals: DataFrame) -> DataFrame:
    """The audit rows of stored stripes and totals; see ``source_divergence``."""
    sizes = totals.groupBy("lang").agg(F.count("*").alias("sources"), F.max("v").alias("v"))
    widest = sizes.agg(F.max("sources")).first()[0]
    blocks = max(1, -(-(widest or 0) // CELL_SOURCES))
    block = F.pmod(F.xxhash64("source"), F.lit(blocks)).cast("int")
    stretches = F.greatest(F.ceil(F.col("v") / CELL_TERMS), F.lit(1)).cast("int")
    every = F.array(*(F.lit(i) for i in range(blocks))) if blocks < 100 else F.sequence(F.lit(0), F.lit(blocks - 1))

    sides = totals.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), stretches - 1)).alias("stretch"))
    cut = broadcast_if_measured(sizes.select("lang", stretches.alias("stretches")))
    parts = stripes.join(cut, "lang").withColumn(
        "stretch", F.pmod(F.xxhash64("term"), F.col("stretches")).cast("int")
    )
    for side in ("block_a", "block_b"):
        sides, parts = (df.withColumn(side, F.explode(every)) for df in (sides, parts))

    def inside(number: Column) -> Column:
        return (number == F.col("block_a")) | (number == F.col("block_b"))

    sides = sides.where(inside(F.col("block")))
    if blocks > 1:
        entries = F.filter(
            F.arrays_zip("sources", "counts"),
            lambda e: inside(F.pmod(F.xxhash64(e["sources"]), F.lit(blocks)).cast("int")),
        )
        parts = parts.withColumn("e", entries).where(F.size("e") > 0)
        parts = parts.withColumns({"sources": F.col("e.sources"), "counts": F.col("e.counts")})
    cell = ["lang", "block_a", "block_b", "stretch"]
    emitted = (
        parts.select(*cell, "term", "sources", "counts", "total")
        .groupBy(*cell)
        .cogroup(sides.select(*cell, "source", "block", "n", "lang_n", "v").groupBy(*cell))
        .applyInArrow(_emit, EMITTED)
    )
    emitted = materialize(emitted, "divergences")
    pairs = emitted.where(F.col("part") == PAIR).groupBy("lang", "source", "part", "item")
    pairs = pairs.agg(F.sum("value").alias("value"))
    terms = emitted.where(F.col("part") == OUTSTANDING)
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [df.withColumn("rank", F.row_number().over(order)) for df in (pairs, terms)]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= LISTED))


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """How every source differs from the other sources of its language, and by which terms from the language.

    Columns ``lang, source, part, item, value, rank``. Part ``pair``: ``item``
    is another source of the language, ``value`` the sum of (p - q)**2 / q over
    the kept terms, each rounded down, with p the shares in the source and q
    those in the other; 0 if the language keeps no term. Part ``term``: ``item``
    is a kept term whose share in the source exceeds that in the language, the
    first 200 of them. ``rank`` counts from 1 by value, largest first, and by
    item among equals.

    Takes columns lang, source and text; others are ignored, whatever their
    names. Null lang, source and text are empty; documents without terms make
    their source occur. Repeated rows are documents of their own. A text may be
    of any length. An empty table gives no rows; a source that is alone in its
    language has no pairs.
    """
    stripes = materialize(term_stripes(docs, least_docs), "stripes")
    totals = materialize(source_totals(docs, stripes), "totals")
    return divergences(stripes, totals)
