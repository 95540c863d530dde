"""Benchmark decontamination by winnowing.

Documents and benchmark items are cut into overlapping grams of K words. Of
every W neighbouring grams the smallest hash is kept as a fingerprint; W grams
span K + W - 1 = 13 words, so two texts that share 13 consecutive words share
the fingerprint of that stretch. Every text is cut once for its fingerprints and
the number of its words. Fingerprints are joined, and the documents that have a
hit are looked at again: every 13-word window is extended from its
hit and held against the windows of the items by digest.

Items shorter than 13 words are one window of their own length, found by all
grams of that length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapakdw.llm.text import broadcast_if_measured, let, text_key, words
from lapakdw.runtime import materialize

# Words in a window, and the share of hit words (1 in 20) from which a document is contaminated.
WINDOW = 13
SHARE = 20

# Words per gram; the rest of a window is the winnowing window.
GRAM = 5


def _grams(ws: Column, size: int) -> Column:
    """Hash of every run of ``size`` words; the size is part of the hash."""
    last = F.size(ws) - size
    every = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(F.lit(size), F.slice(ws, i + 1, size)))
    return F.when(last >= 0, every).otherwise(F.array().cast("array<bigint>"))


def winnow(ws: Column, gram: int = GRAM, window: int = WINDOW) -> Column:
    """The smallest gram hash of each window, one per window position."""
    span = window - gram + 1

    def minima(hashes: Column) -> Column:
        last = F.size(hashes) - span
        every = F.transform(F.sequence(F.lit(0), last), lambda i: F.array_min(F.slice(hashes, i + 1, span)))
        return F.when(last >= 0, every).otherwise(F.array().cast("array<bigint>"))

    return let(_grams(ws, gram), minima)


def _fingerprints(ws: Column, short: list[int]) -> Column:
    return F.array_distinct(F.concat(winnow(ws), *(_grams(ws, n) for n in short)))


def _windows(ws: Column, size: int) -> Column:
    """Every window of ``size`` words: where it starts, where it ends, its digest."""
    last = F.size(ws) - size

    def one(i: Column) -> Column:
        digest = F.md5(F.array_join(F.slice(ws, i + 1, size), " "))
        return F.struct(i.alias("start"), (i + size).alias("end"), digest.alias("digest"))

    every = F.transform(F.sequence(F.lit(0), last), one)
    return F.when(last >= 0, every).otherwise(F.array().cast("array<struct<start:int,end:int,digest:string>>"))


def item_windows(benchmark: DataFrame) -> tuple[DataFrame, DataFrame, list[int]]:
    """Fingerprints of the items, their windows with the items that hold them, and the short lengths in use."""
    items = materialize(
        benchmark.select("item_id", words(F.col("text")).alias("ws")).where(F.size("ws") > 0), "items"
    )
    lengths = items.select(F.size("ws").alias("n")).where(F.col("n") < WINDOW).distinct()
    short = sorted(row["n"] for row in lengths.collect())  # at most twelve numbers
    whole = items.where(F.size("ws") >= WINDOW).select("item_id", F.col("ws"))
    prints = whole.select(F.explode(F.array_distinct(winnow(F.col("ws")))).alias("print"))
    found = whole.select("item_id", F.inline(_windows(F.col("ws"), WINDOW)))
    for n in short:
        part = items.where(F.size("ws") == n)
        prints = prints.union(part.select(F.explode(_grams(F.col("ws"), n))))
        found = found.union(part.select("item_id", F.inline(_windows(F.col("ws"), n))))
    size = (F.col("end") - F.col("start")).alias("size")
    held = found.groupBy("digest", size).agg(F.sort_array(F.collect_set("item_id")).alias("items"))
    return materialize(prints.distinct(), "prints"), materialize(held, "windows"), short


def covered(spans: Column) -> Column:
    """Positions inside any of the sorted (start, end) spans."""
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("upto"))

    def step(acc: Column, s: Column) -> Column:
        more = F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], acc["upto"]))
        return F.struct((acc["n"] + more).alias("n"), F.greatest(acc["upto"], s["end"]).alias("upto"))

    return F.aggregate(spans, zero, step, lambda acc: acc["n"])


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", text_key(F.col("text")).alias("key"), "text")


def look(documents: DataFrame, prints: DataFrame, short: list[int]) -> DataFrame:
    """Every text cut into words and fingerprints, once: ``doc_id, key, n_words``, stored.

    A row per document with the number of its words, and a row without one per
    fingerprint that the document shares with an item.
    """
    # The number of words travels in front of the fingerprints.
    numbers = let(
        words(F.col("text")), lambda ws: F.concat(F.array(F.size(ws).cast("long")), _fingerprints(ws, short))
    )
    found = _keyed(documents).select("doc_id", "key", F.posexplode(numbers).alias("at", "number"))
    # Rows with numbers of words match nothing; where the join shuffles, they go by document.
    met = F.when(F.col("at") > 0, F.col("number")).otherwise(F.xxhash64("doc_id", "key"))
    met = (met == F.col("print")) & (F.col("at") > 0)
    held = found.join(broadcast_if_measured(prints), met, "left").where((F.col("at") == 0) | F.col("print").isNotNull())
    n_words = F.when(F.col("at") == 0, F.col("number")).alias("n_words")
    return materialize(held.select("doc_id", "key", n_words), "looked")


def _hits(documents: DataFrame, looked: DataFrame, windows: DataFrame, short: list[int]) -> DataFrame:
    candidates = materialize(looked.where(F.col("n_words").isNull()).select("doc_id", "key").distinct(), "candidates")
    few = broadcast_if_measured(candidates.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")))
    again = _keyed(documents).join(few, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left_semi")
    sizes = [WINDOW, *short]
    stretches = again.select(
        "doc_id", "key", F.inline(let(words(F.col("text")), lambda ws: F.concat(*(_windows(ws, n) for n in sizes))))
    )
    hits = stretches.join(
        broadcast_if_measured(windows.select("digest", "size", "items")),
        (stretches["digest"] == windows["digest"]) & (F.col("end") - F.col("start") == F.col("size")),
    )
    return hits.groupBy("doc_id", "key").agg(
        F.sort_array(F.collect_set(F.struct("start", "end"))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
    )


def find_hits(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold a window: ``doc_id, key, spans, items``.

    ``spans`` are the distinct (start, end) word positions, sorted; ``items``
    the ids of the items whose windows occur, sorted as numbers.
    """
    prints, windows, short = item_windows(benchmark)
    return _hits(documents, look(documents, prints, short), windows, short)


def judge(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contamination`` with the key of each text beside the id."""
    prints, windows, short = item_windows(benchmark)
    looked = look(documents, prints, short)
    rows = looked.where(F.col("n_words").isNotNull())
    found = _hits(documents, looked, windows, short).select(
        F.col("doc_id").alias("_id"),
        F.col("key").alias("_key"),
        covered(F.col("spans")).cast("long").alias("hit"),
        F.array_sort(F.transform("items", lambda x: x.cast("string"))).alias("ids"),
    )
    joined = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    hit = F.coalesce("hit", F.lit(0)).cast("long")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select(
        "doc_id",
        "key",
        "n_words",
        hit.alias("n_hit"),
        F.size(ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        ((hit > 0) & (hit * SHARE >= F.col("n_words"))).alias("contaminated"),
    )


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null and empty texts have no words and are clean. Repeated rows each get
    their row; a null id is an id like any other. Items without an id make
    words hit but are not listed. Other columns are ignored. Either table may
    be empty.
    """
    return judge(documents, benchmark).drop("key")


def drop_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with all their columns."""
    bad = judge(documents, benchmark).where("contaminated").select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key")
    )
    bad = materialize(bad.distinct(), "contaminated")
    same = documents["doc_id"].eqNullSafe(bad["_id"]) & (text_key(documents["text"]) == bad["_key"])
    return documents.join(broadcast_if_measured(bad), same, "left_anti")
