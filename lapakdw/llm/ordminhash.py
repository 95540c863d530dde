"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A text is the sequence of its overlapping shingles of five words, each labelled
with how often it occurred before, so that no labelled shingle occurs twice. A
sketch takes the LENGTH labelled shingles of smallest hash and keeps them in
text order; texts with many shingles in common and in the same order share
some of their SKETCHES sketches. Short texts also meet by single shingles: of two
that are similar enough, the rarest shingles of both, so many as the similarity
lets either do without and one more, have one in common.

Texts with equal words are one from the start. The others meet in buckets, one
per shared sketch or rare shingle. In each bucket all are held against one leader, the text that
meets most others. Where that leaves texts of a bucket in different groups, all
of them are held against each other: in small buckets pair by pair, in larger
ones in tiles whose tasks return only the links that connect something. So a
large group of copies costs one comparison per text and bucket and a number of
links that grows with its texts, and still no pair that could join two groups
goes unseen.

The similarity of two texts is c / (n + m - c) for n and m labelled shingles,
c of which can be aligned in order inside the band that this similarity leaves.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapakdw.llm.bpe import text_slices
from lapakdw.llm.text import broadcast_if_measured, free_name, text_key
from lapakdw.runtime import materialize, sql_conf

# Words in a shingle, and the smallest similarity of near duplicates.
SHINGLE_WORDS = 5
SIMILARITY = 0.8

# Shingles in a sketch, and sketches of a text. Long texts at the smallest similarity miss each other with
# a chance of about (1 - 0.8 ** LENGTH) ** SKETCHES, two in a hundred thousand.
LENGTH, SKETCHES = 5, 28
# Texts of up to this many shingles, for which that chance is larger, also meet by their rarest shingles, which misses none.
EXACT_SHINGLES = 40
# Up to this many members, the pairs of a bucket that may still be tied are compared one by one; larger
# buckets are compared in tiles of blocks of about so many members, by slices of so many shingles.
SMALL_BUCKET, TILE_MEMBERS, TABLE_COLUMNS = 32, 512, 4096
# Bytes of text and shingles hashed at once, and bytes per batch of pairs that are aligned.
CHUNK_CHARS = 500_000
BLOCK = 1 << 15
PAIR_BATCH_BYTES = 32 << 20
# Largest measured size of the shingles of all texts in buckets that are sent to every executor.
SHINGLE_BYTES = 16 << 20

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def _odd_numbers(n: int, seed: int) -> np.ndarray:
    return _mix(np.arange(1, n + 1, dtype=np.uint64) * _ODD + np.uint64(seed)) | np.uint64(1)


_POWERS = _odd_numbers(4096, 11)
_PLACES = _odd_numbers(SHINGLE_WORDS, 12)
_SEEDS = _odd_numbers(SKETCHES, 13)
_SEATS = _odd_numbers(LENGTH, 14)

# Words are runs of digits, letters and characters beyond ASCII; A-Z count as a-z.
_in_word = np.zeros(129, bool)
_in_word[48:58] = _in_word[65:91] = _in_word[97:123] = True
_in_word[128] = True


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of each text."""
    codes = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), "<u4")
    inside = _in_word.take(np.minimum(codes, 128))
    values = codes + np.where((codes >= 65) & (codes <= 90), np.uint32(32), np.uint32(0))
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return [np.zeros(0, np.uint64)] * len(texts)
    at = np.flatnonzero(inside)
    place = np.arange(len(at)) - np.repeat(np.cumsum(ends - starts) - (ends - starts), ends - starts)
    terms = _mix(values[at].astype(np.uint64) + _ODD) * _POWERS.take(place % len(_POWERS))
    firsts = np.cumsum(ends - starts) - (ends - starts)
    hashes = _mix(np.add.reduceat(terms, firsts))
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    cuts = np.searchsorted(starts, np.cumsum(lengths))
    return np.split(hashes, cuts[:-1])


def labelled_shingles(words: np.ndarray) -> np.ndarray:
    """Hash of every shingle with its label, in text order. Fewer than five words are one shingle."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(n, SHINGLE_WORDS)
    total = np.zeros(n - size + 1, np.uint64)
    for i in range(size):
        total += words[i : n - size + 1 + i] * _PLACES[i]
    shingles = _mix(total)
    order = np.argsort(shingles, kind="stable")
    ordered = shingles[order]
    same = ordered[1:] == ordered[:-1]
    if same.any():
        group = np.concatenate([[0], np.cumsum(~same)])
        first = np.concatenate([[0], np.flatnonzero(~same) + 1])
        label = np.empty(len(order), np.uint64)
        label[order] = np.arange(len(order)) - first[group]
        again = label > 0
        shingles[again] = _mix(shingles[again] + label[again] * _ODD)
    return shingles


def _smallest(shingles: np.ndarray, keep: int) -> np.ndarray:
    """Positions of the ``keep`` smallest hashes under every seed, one row per seed."""
    best_at = np.zeros((SKETCHES, 0), np.int64)
    best = np.zeros((SKETCHES, 0), np.uint64)
    rows = np.arange(SKETCHES)
    for a in range(0, len(shingles), BLOCK):
        h = shingles[None, a : a + BLOCK] * _SEEDS[:, None]
        h ^= h >> np.uint64(32)
        h *= _M2
        most = min(keep, h.shape[1])
        at, low = np.empty((SKETCHES, most), np.int64), np.empty((SKETCHES, most), np.uint64)
        for j in range(most):
            at[:, j] = h.argmin(axis=1)
            low[:, j] = h[rows, at[:, j]]
            h[rows, at[:, j]] = ~np.uint64(0)
        best_at, best = np.hstack([best_at, at + a]), np.hstack([best, low])
        if best.shape[1] > keep:
            chosen = np.argsort(best, axis=1, kind="stable")[:, :keep]
            best_at, best = np.take_along_axis(best_at, chosen, 1), np.take_along_axis(best, chosen, 1)
    return best_at


def sketches(shingles: np.ndarray) -> np.ndarray:
    """One number per seed: the smallest labelled shingles, in text order."""
    keep = min(LENGTH, len(shingles))
    if not keep:
        return np.zeros(0, np.int64)
    chosen = shingles[np.sort(_smallest(shingles, keep), axis=1)]
    total = (chosen * _SEATS[:keep]).sum(axis=1, dtype=np.uint64)
    return _mix(total + _SEEDS).view(np.int64)


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Banded alignment of two sequences of labelled shingles."""
    n, m = len(a), len(b)
    if not n or not m or min(n, m) < SIMILARITY * max(n, m):
        return 0.0
    _, at, other = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if len(at) < SIMILARITY * (n + m - len(at)):
        return 0.0  # not even without regard to order
    # An alignment this good leaves out so few shingles that it cannot shift further.
    band = int((n + m) * (1 - SIMILARITY) / (1 + SIMILARITY)) + 1
    near = np.abs(at - other) <= band
    order = np.argsort(at[near])
    chain = other[near][order]
    if len(chain) and (np.diff(chain) <= 0).any():
        ends: list[int] = []  # smallest end of an increasing chain of each length
        for x in chain.tolist():
            i = bisect_left(ends, x)
            ends[i : i + 1] = [x]
        c = len(ends)
    else:
        c = len(chain)
    return c / (n + m - c)


def sketch_documents(documents: DataFrame) -> DataFrame:
    """``doc_id, key, digest, n, sketches, few`` of each document; ``digest`` is null where a text has no words.

    ``few`` are all labelled shingles of a short text, and empty for others.
    """

    def lists(found: list[np.ndarray]) -> pa.ListArray:
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(2), CHUNK_CHARS):
                digests, sizes, found, few = [], [], [], []
                for words in word_hashes(texts):
                    shingles = labelled_shingles(words)
                    digests.append(hashlib.md5(words.tobytes()).digest() if len(words) else None)
                    sizes.append(len(shingles))
                    found.append(sketches(shingles))
                    few.append(shingles[: len(shingles) if len(shingles) <= EXACT_SHINGLES else 0].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        batch.column(1).slice(a, b - a),
                        pa.array(digests, pa.binary()),
                        pa.array(sizes, pa.int32()),
                        lists(found),
                        lists(few),
                    ],
                    names=["doc_id", "key", "digest", "n", "sketches", "few"],
                )

    taken = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("key"), "text"
    )
    return taken.mapInArrow(run, "doc_id bigint, key bigint, digest binary, n int, sketches array<bigint>, few array<bigint>")


def _head() -> Column:
    """Orders documents of a group: by id, a missing id last, then by text."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")


def _same_row(left: str = "") -> Column:
    return F.col("doc_id").eqNullSafe(F.col(f"{left}doc_id")) & (F.col("key") == F.col(f"{left}key"))


def fetch_shingles(documents: DataFrame, heads: DataFrame) -> DataFrame:
    """``rep, shingles`` for heads ``(rep, head_doc_id, head_key)``, from a second look at their texts."""
    wanted = broadcast_if_measured(heads)
    texts = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_key(F.col("text")).alias("key"), "text"
    ).join(wanted, _same_row("head_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), CHUNK_CHARS):
                found = [labelled_shingles(words).tobytes() for words in word_hashes(texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(found, pa.binary())], names=["rep", "shingles"]
                )

    shingles = texts.select("rep", "text").mapInArrow(run, "rep bigint, shingles binary")
    return materialize(shingles.dropDuplicates(["rep"]), "shingles")


def verify(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """Those of the pairs ``(a, b)`` that are similar enough, stored."""
    left = shingles.select(F.col("rep").alias("a"), F.col("shingles").alias("left"))
    right = shingles.select(F.col("rep").alias("b"), F.col("shingles").alias("right"))
    both = pairs.join(right, "b").join(left, "a").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits = [
                similarity(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)) >= SIMILARITY
                for x, y in zip(batch.column(2), batch.column(3))
            ]
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    spark = pairs.sparkSession
    with sql_conf(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": str(PAIR_BATCH_BYTES)}):
        return materialize(both.mapInArrow(run, "a bigint, b bigint"), "links")


def components(links: DataFrame) -> DataFrame:
    """``node, label`` for every node of the links ``(a, b)``; the label is the smallest node of its component.

    Large-star and small-star steps in turn: each node's larger (then smaller)
    neighbours are tied to its smallest one, until every node is tied to one
    that is tied to no smaller one. The links of a step are stored, so that a
    step never runs twice.
    """
    ends = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v")
    edges = materialize(ends, "edges")
    if edges.isEmpty():
        return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))
    while True:
        both = edges.union(edges.select("v", "u"))
        # Stored, so that the join behind can split the many edges of one node.
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        nearest = broadcast_if_measured(least.withColumnRenamed("u", "v"))
        large = materialize(edges.join(nearest, "v").select("u", F.col("m").alias("v")), "edges")
        smallest = materialize(large.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")), "least")
        tied = broadcast_if_measured(smallest.select("u", "m"))
        inner = large.join(tied.select(F.col("u").alias("v")), "v", "left_semi").select("v")
        if smallest.where("m < most").select("u").union(inner).isEmpty():
            break
        small = (
            large.join(tied, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(smallest.select("u", F.col("m").alias("v")))
        )
        edges = materialize(small.where("u <> v").distinct(), "edges")
    return smallest.select(F.col("u").alias("node"), F.col("m").alias("label")).union(
        smallest.select(F.col("m").alias("node"), F.col("m").alias("label")).distinct()
    )


def join_labels(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The ``node, label`` of ``components`` after further links ``(a, b)``, which only tie labels to each other."""
    known = broadcast_if_measured(labels)
    for end in ("a", "b"):
        named = known.select(F.col("node").alias(end), "label")
        links = links.join(named, end, "left").withColumn(end, F.coalesce("label", end)).drop("label")
    tied = materialize(components(links), "tied")
    over = broadcast_if_measured(tied.select(F.col("node").alias("label"), F.col("label").alias("least")))
    moved = labels.join(over, "label", "left").select("node", F.coalesce("least", "label").alias("label"))
    # Labels have their row above; other nodes of the links have none yet.
    return moved.union(tied.join(known.select("node"), "node", "left_anti").select("node", "label"))


def _lengths_fit(a: str, b: str) -> Column:
    return F.least(a, b) >= SIMILARITY * F.greatest(a, b)


def short_buckets(reps: DataFrame) -> DataFrame:
    """``bucket, rep, n``: short texts by their rarest shingles, one bucket per shingle.

    Similar texts of n and m shingles share SIMILARITY * max(n, m) of them at least. If the rarest
    n - ceil(SIMILARITY * n) + 1 of the one, and as many of the other by its size, in one order of all shingles,
    had none in common, too few would be left.
    """
    each = reps.where(F.col("n") <= EXACT_SHINGLES).select("rep", "n", F.explode("few").alias("shingle"))
    shared = materialize(each.groupBy("shingle").agg(F.count("*").alias("texts")).where("texts > 1"), "shared")
    counted = each.join(broadcast_if_measured(shared), "shingle", "left")
    one = F.struct(F.coalesce("texts", F.lit(1)).alias("texts"), "shingle")
    least = F.ceil(F.col("n") * F.lit(SIMILARITY) - F.lit(1e-9)).cast("int")
    rarest = counted.groupBy("rep", "n").agg(F.sort_array(F.collect_list(one)).alias("all"))
    rarest = rarest.select("rep", "n", F.explode(F.slice("all", F.lit(1), F.col("n") - least + 1)).alias("x"))
    return rarest.where("x.texts > 1").select(F.xxhash64(F.lit(-1), "x.shingle").alias("bucket"), "rep", "n")


def near_labels(documents: DataFrame, reps: DataFrame) -> DataFrame:
    """``node, label`` of the representatives with verified links, which connect all that are connected in some bucket."""
    keyed = reps.select("rep", "n", F.posexplode("sketches").alias("seat", "sketch")).select(
        F.xxhash64("seat", "sketch").alias("bucket"), "rep", "n"
    )
    keyed = keyed.union(materialize(short_buckets(reps), "short"))
    shared = materialize(keyed.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "buckets")
    members = materialize(keyed.join(broadcast_if_measured(shared), "bucket"), "members")
    # A text that meets many others is likely to be what they are copies of: the best first guess for a leader.
    met = members.groupBy("rep").agg(F.sum("size").alias("met"), F.min("n").alias("n"))
    met = broadcast_if_measured(materialize(met, "met"))
    best = members.select("bucket", "rep").join(met, "rep").groupBy("bucket").agg(
        F.max(F.struct("met", (-F.col("rep")).alias("last"), "n")).alias("x")
    )
    leaders = materialize(
        best.select("bucket", (-F.col("x.last")).alias("leader"), F.col("x.n").alias("leader_n")), "leaders"
    )
    members = materialize(members.drop("size").join(broadcast_if_measured(leaders), "bucket"), "members")
    heads = reps.join(met.select("rep"), "rep").select("rep", "head_doc_id", "head_key")
    shingles = broadcast_if_measured(fetch_shingles(documents, materialize(heads, "heads")), SHINGLE_BYTES)

    star = members.where(F.col("rep") != F.col("leader")).where(_lengths_fit("n", "leader_n"))
    tried = materialize(star.select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    links = verify(tried, shingles)

    # The leader has met the whole bucket; two others from different components can still be tied.
    rest = members.where(F.col("rep") != F.col("leader")).select("bucket", "rep", "n")
    labels = materialize(components(links), "labels")
    rest = rest.join(broadcast_if_measured(labels.withColumnRenamed("node", "rep")), "rep", "left")
    rest = materialize(rest.withColumn("label", F.coalesce("label", "rep")), "rest")
    split = rest.groupBy("bucket").agg(
        F.count("*").alias("size"), F.min("label").alias("least"), F.max("label").alias("most")
    ).where("least < most")
    split = materialize(split.select("bucket", "size"), "split")
    rest = materialize(rest.join(broadcast_if_measured(split), "bucket"), "rest")
    small, large = rest.where(F.col("size") <= SMALL_BUCKET), rest.where(F.col("size") > SMALL_BUCKET)
    more = verify(small_bucket_pairs(small, tried), shingles)
    return join_labels(labels, more.union(large_bucket_links(large, shingles)))


def small_bucket_pairs(rest: DataFrame, tried: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of different components in buckets of at most SMALL_BUCKET members, without those tried."""
    one = F.struct("rep", "n", "label")
    groups = rest.groupBy("bucket").agg(F.sort_array(F.collect_list(one)).alias("all"))
    firsts = groups.select("all", F.explode("all").alias("x"))
    pairs = firsts.select("x", F.explode(F.filter("all", lambda y: y["rep"] > F.col("x.rep"))).alias("y")).where(
        F.col("x.label") != F.col("y.label")
    )
    fitting = pairs.where(_lengths_fit("x.n", "y.n")).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b"))
    known = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return fitting.distinct().join(broadcast_if_measured(known), ["a", "b"], "left_anti")


def _overlaps(texts: list[np.ndarray]) -> np.ndarray:
    """Number of shingles that each two of the texts share: products of slices of their incidence table."""
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    _, column, count = np.unique(np.concatenate(texts), return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    used = count[column] > 1
    owner, column = owner[used], shared[column[used]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(texts), len(texts)), np.float32)
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, TABLE_COLUMNS):
        lo, hi = np.searchsorted(column, (a, a + TABLE_COLUMNS))
        table = np.zeros((len(texts), TABLE_COLUMNS), np.float32)
        table[owner[lo:hi], column[lo:hi] - a] = 1
        total += table @ table.T
    return total


def tile_links(reps: list[int], labels: list[int], texts: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all texts of a tile that similar pairs connect; texts of one label are connected."""
    sizes = np.array([len(t) for t in texts], np.float32)
    common = _overlaps(texts)
    likely = common >= SIMILARITY * (sizes[:, None] + sizes[None, :] - common)
    parent: dict[int, int] = {x: x for x in labels}

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for i, j in zip(*(x.tolist() for x in np.nonzero(np.triu(likely, 1)))):
        x, y = root(labels[i]), root(labels[j])
        if x != y and similarity(texts[i], texts[j]) >= SIMILARITY:
            parent[x] = y
            found.append((reps[i], reps[j]))
    return found


def large_bucket_links(rest: DataFrame, shingles: DataFrame) -> DataFrame:
    """Links within larger buckets, stored.

    The members of a bucket are dealt to blocks of about TILE_MEMBERS; every two
    blocks meet in one tile, a task compares all texts of its tile by products
    of incidence tables, and returns no more links than connect them.
    """
    blocks = F.ceil(F.col("size") / TILE_MEMBERS).cast("int")
    dealt = rest.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    tiles = dealt.select("bucket", "rep", "label", "block", other.alias("other")).select(
        "bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "rep", "label"
    )

    def run(table: pa.Table) -> pa.Table:
        reps, labels = table.column("rep").to_pylist(), table.column("label").to_pylist()
        texts = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("shingles")]
        found = tile_links(reps, labels, texts) if len(set(labels)) > 1 else []
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    filled = tiles.join(shingles, "rep")
    return materialize(filled.groupBy("bucket", "i", "j").applyInArrow(run, "a bigint, b bigint"), "links")


def classify(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, key, class_id, copy_of, n_shingles, kept``, stored on the way."""
    rows = materialize(sketch_documents(documents), "sketches")
    worded = rows.where("digest is not null")
    reps = worded.groupBy("digest").agg(
        F.min(_head()).alias("head"), F.first("n").alias("n"), F.first("sketches").alias("sketches"),
        F.first("few").alias("few"),
    )
    reps = materialize(
        reps.select(
            "digest", F.monotonically_increasing_id().alias("rep"), F.col("head.doc_id").alias("head_doc_id"),
            F.col("head.key").alias("head_key"), "head", "n", "sketches", "few",
        ),
        "reps",
    )
    labels = broadcast_if_measured(materialize(near_labels(documents, reps), "labels"))
    grouped = reps.select("rep", "digest", "head").join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    grouped = materialize(grouped.drop("rep"), "labels")
    # A text without links is the first of its class.
    tied = grouped.where(F.col("label").isNotNull())
    first = broadcast_if_measured(materialize(tied.groupBy("label").agg(F.min("head").alias("first")), "first"))
    classes = grouped.join(first, "label", "left").select("digest", "head", F.coalesce("first", "head").alias("first"))
    classes = materialize(classes, "classes")
    joined = rows.drop("sketches", "few").join(classes, "digest", "left")
    kept = F.col("first").isNull() | (
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("key") == F.col("first.key"))
    )
    alone = F.col("first").isNull()
    return joined.select(
        "doc_id",
        "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("head.doc_id")).alias("copy_of"),
        F.col("n").cast("long").alias("n_shingles"),
        kept.alias("kept"),
    )


def near_duplicates(documents: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, class_id, copy_of, n_shingles``.

    ``class_id`` is the smallest id of all documents that a chain of near
    duplicates connects, ``copy_of`` the smallest id among those with the same
    words. Null texts and texts without words are a class of their own, even if
    they repeat. Repeated rows each get their row. A missing id is never the id
    of a class that has another one. Texts of one to four words are one
    shingle. Other columns are ignored.
    """
    return classify(documents).drop("key", "kept")


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each class, the one with the smallest id, with all columns; of equal rows of it, one.

    Documents without words all stay.
    """
    judged = materialize(classify(documents), "judged")
    key, doc_id = text_key(F.col("text")), F.col("doc_id").cast("bigint")

    def same(df: DataFrame) -> Column:
        return doc_id.eqNullSafe(df["_id"]) & (key == df["_key"])

    names = [F.col("doc_id").alias("_id"), F.col("key").alias("_key")]
    gone = materialize(judged.where("not kept").select(*names).distinct(), "gone")
    repeated = judged.where("kept and n_shingles > 0").groupBy("doc_id", "key").count().where("count > 1")
    repeated = materialize(repeated.select(*names), "repeated")
    stay = documents.join(broadcast_if_measured(gone), same(gone), "left_anti")
    if repeated.isEmpty():
        return stay
    few = broadcast_if_measured(repeated)
    twin = free_name(stay, "twin")
    once = stay.join(few, same(repeated), "left_semi").withColumn(twin, key).dropDuplicates(["doc_id", twin])
    return stay.join(few, same(repeated), "left_anti").union(once.drop(twin))
