"""Token ids as binary files: frequency-ranked ids in whole bytes, with separate control bytes.

An id is written as its rank by frequency over all documents (the most frequent
id is rank 0), in as few whole bytes as the rank needs: one to four, little
endian. How many is told by two bits, four ids to a control byte, the first id
in the lowest bits. Control bytes and rank bytes of a block lie apart, so a
reader finds the place of every id by one table lookup and a running sum.

Layout of a folder::

    ranks.u32             the id of every rank, unsigned 32-bit little endian
    manifest              a Parquet table of the shards
    shard-<part>-<number>-<writer>.ids

and of a shard, all numbers little endian::

    magic  LPKIDS01
    block  u32 ids, u32 rank bytes, control bytes, rank bytes      (repeated)
    index  an Arrow stream with the columns doc_id and n_ids
    tail   u64 offset of the index, u64 ids, magic

Shards hold whole documents and follow each other by part and number in
ascending order of the document id. Files of a lost or repeated task stay
behind unlisted: the manifest, which Spark commits, names the shards that count.
"""

from __future__ import annotations

import json
import os
import re
import struct
import uuid
from array import array
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import cache, lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lapakdw.llm.bpe import piece_starts, text_slices
from lapakdw.runtime import MAX_PARTITIONS, materialize, new_scratch, sql_conf

MAGIC = b"LPKIDS01"
TAIL = struct.Struct("<QQ8s")
BLOCK = struct.Struct("<II")
RANKS, LISTED = "ranks.u32", "manifest"

# Fixed value: the id behind the last one of every document.
END_ID = 0

# Ids of a block and of a shard, and about as many a partition of the ordered ids should have at least.
BLOCK_IDS = 1 << 18
SHARD_IDS = 1 << 25
PART_IDS = 1 << 20
# Characters encoded at once; longer texts are cut where pieces are sure to begin.
ENCODE_CHARS = 1_000_000
# Pieces a task remembers twice of, the newer and the older ones, and the longest it remembers.
CACHE_PIECES = 300_000
CACHE_CHARS = 64
# Bytes of ids in an Arrow batch that a task hands over.
BATCH_BYTES = 8_000_000
# Documents whose ids are handled at once.
BATCH_ROWS = 1000

CUT = re.compile(r"(?<=\S)(?= [A-Za-z])")
MANIFEST = "part int, shard int, path string, n_docs bigint, n_ids bigint, n_bytes bigint"


@cache
def _lengths() -> np.ndarray:
    """The lengths of the four ids of every control byte."""
    return ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3).astype(np.uint8) + 1


def pack(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and rank bytes of unsigned 32-bit numbers."""
    ranks = np.ascontiguousarray(ranks, "<u4")
    codes = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    padded = np.zeros((-(-len(codes) // 4), 4), np.uint8)
    padded.reshape(-1)[: len(codes)] = codes
    control = padded[:, 0] | padded[:, 1] << 2 | padded[:, 2] << 4 | padded[:, 3] << 6
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[np.arange(4) <= codes[:, None]].tobytes()


def unpack(control: bytes, spelled: bytes, n: int) -> np.ndarray:
    """The numbers again: a table gives their lengths, the running sum the places, one gather the values."""
    widths = _lengths().take(np.frombuffer(control, np.uint8), axis=0).ravel()[:n]
    ends = np.cumsum(widths, dtype=np.int64)
    words = np.ndarray(len(spelled), "<u4", spelled + b"\0\0\0", strides=(1,))
    masks = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)
    return words.take(ends - widths) & masks.take(widths)


def _flat(column: pa.Array, kind: str = "u1") -> tuple[np.ndarray, np.ndarray]:
    """All values of a column of byte strings one behind the other, and how many each row has."""
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    values = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    values = np.ascontiguousarray(values).view(kind)
    return values, np.diff(offsets).astype(np.int64) // values.itemsize


@lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def spelled_bytes() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: its own if it prints, else one from 256 on."""
    prints = [b for b in range(256) if chr(b).isprintable() and not chr(b).isspace() and b != 0xAD]
    others = (b for b in range(256) if b not in set(prints))
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def byte_places(text: str) -> np.ndarray:
    """Where each character begins in the UTF-8 bytes of a text, and behind them where the last one ends."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    places = np.zeros(len(codes) + 1, np.int64)
    np.cumsum(1 + (codes >= 0x80).astype(np.int8) + (codes >= 0x800) + (codes >= 0x10000), out=places[1:])
    return places


class Pieces(dict[str, bytes]):
    """The ids of pieces, merged when first asked for. Long pieces are merged every time."""

    def __init__(self, merge: Callable[[str], list], code: str, older: dict[str, bytes] | None = None) -> None:
        self.merge, self.code, self.older = merge, code, older or {}
        self.spell, self.id_of = spelled_bytes(), attrgetter("id")

    def next_generation(self) -> Pieces:
        """An empty one that takes over, piece by piece, what is still in use of this."""
        return Pieces(self.merge, self.code, dict(self))

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            if piece.isascii() and piece.isprintable():  # all but the space stand for themselves
                tokens = self.merge(piece.replace(" ", self.spell[32]))
            else:
                tokens = self.merge(piece.encode().decode("latin-1").translate(self.spell))
            ids = array(self.code, map(self.id_of, tokens)).tobytes()
        if len(piece) <= CACHE_CHARS:
            self[piece] = ids
        return ids


class Encoder:
    """The ids of texts by a tokenizer file, as the tokenizers library has them.

    The library merges; texts are cut into the pieces of its byte-level rule by
    the scan over code classes, and the ids of a piece are remembered, because
    cutting is most of the library's work. Texts with an added token in them, and
    files with other rules, go to the library whole.
    """

    def __init__(self, path: str) -> None:
        self.whole = tokenizer(path)
        rules = json.loads(self.whole.to_str())
        cut = rules["pre_tokenizer"] or {}
        self.by_pieces = (
            rules["normalizer"] is None
            and rules["model"]["type"] == "BPE"
            and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex")) == ("ByteLevel", False, True)
        )
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.kind = "<u2" if self.size() <= 1 << 16 else "<u4"
        self.known = Pieces(self.whole.model.tokenize, "H" if self.kind == "<u2" else "I")

    def rest(self) -> None:
        """Drop the older pieces; the newer ones serve the worker's next task."""
        self.known.older = {}

    def size(self) -> int:
        return self.whole.get_vocab_size(with_added_tokens=True)

    def _bytes(self, ids: Sequence[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _pieces(self, whole: str, starts: np.ndarray) -> tuple[np.ndarray, bytes]:
        """Where the ids of each piece begin, and the ids of all. Arrow finds equal pieces, which are asked for once."""
        spelled, cuts = whole.encode(), np.append(starts, len(whole)).astype(np.int64)
        places = cuts if len(spelled) == len(whole) else byte_places(whole).take(cuts)
        buffers = [None, pa.py_buffer(places), pa.py_buffer(spelled)]
        which = pa.Array.from_buffers(pa.large_string(), len(starts), buffers).dictionary_encode().indices
        # They are numbered in the order of their first places.
        first = np.flatnonzero(np.diff(np.maximum.accumulate(which.to_numpy()), prepend=-1))
        different = [whole[a:b] for a, b in zip(cuts.take(first).tolist(), cuts.take(first + 1).tolist())]
        ids = pa.array(list(map(self.known.__getitem__, different)), pa.large_binary())
        values, lengths = _flat(ids.take(which))
        upto = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(lengths, out=upto[1:])
        return upto, values.tobytes()

    def texts(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little endian, two bytes each where the vocabulary allows it."""
        odd = [i for i, t in enumerate(texts) if not self.by_pieces or any(token in t for token in self.added)]
        asked = dict(zip(odd, self.whole.encode_batch([texts[i] for i in odd], add_special_tokens=False)))
        plain = ["" if i in asked else t for i, t in enumerate(texts)]
        lengths = np.array([len(t) for t in plain], np.int64)
        ends = np.cumsum(lengths)
        whole = "".join(plain)
        starts = piece_starts(whole, (ends - lengths)[lengths > 0])
        if len(self.known) > CACHE_PIECES:
            self.known = self.known.next_generation()
        upto, coded = self._pieces(whole, starts)
        first, last = np.searchsorted(starts, ends - lengths), np.searchsorted(starts, ends)
        found = [coded[a:b] for a, b in zip(upto.take(first).tolist(), upto.take(last).tolist())]
        for i, encoding in asked.items():
            found[i] = self._bytes(encoding.ids)
        return found


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of a worker. Reading the rules anew, and the first pieces, would cost every task."""
    return Encoder(path)


def stretches(text: str, most: int = ENCODE_CHARS) -> Iterator[str]:
    """A text in parts that encode to the same ids as the whole.

    A piece always begins at a single space between another character and a
    letter. A text without such places stays whole.
    """
    begin = 0
    while len(text) - begin > most:
        cut = CUT.search(text, begin + most)
        if cut is None:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


def encode_ids(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id`` and ``ids``: the ids of every text with ``END_ID`` behind them, as ``Encoder`` writes them."""
    schema = f"doc_id {docs.schema[key].dataType.simpleString()}, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path)
        end = np.array([END_ID], encoder.kind).tobytes()
        for batch in batches:
            for a, b, texts in text_slices(batch.column(1), ENCODE_CHARS):
                if b - a > 1 or len(texts[0]) <= ENCODE_CHARS:
                    ids = encoder.texts(texts)
                else:
                    ids = [b"".join(encoder.texts([part])[0] for part in stretches(texts[0]))]
                coded = pa.array([i + end for i in ids], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), coded], names=["doc_id", "ids"])
        encoder.rest()

    return docs.select(F.col(key).alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def id_counts(coded: DataFrame, size: int, kind: str) -> DataFrame:
    """``id`` and ``n``: how often each id below ``size`` occurs. Tasks count in an array of that size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int64)
        for batch in batches:
            for a in range(0, batch.num_rows, BATCH_ROWS):
                counts += np.bincount(_flat(batch.column(0).slice(a, BATCH_ROWS), kind)[0], minlength=size)
        found = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(counts[found])], names=["id", "n"])

    return coded.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, and the path in it. Hadoop writes local paths with one slash as well."""
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class ShardWriter:
    """Writes one shard: documents go in one after the other, ``close`` ends the file."""

    def __init__(self, path: str, doc_type: pa.DataType) -> None:
        self.path, self.doc_type = path, doc_type
        system, place = _open(path)
        self.out = system.open_output_stream(place)
        self.out.write(MAGIC)
        self.size = len(MAGIC)
        self.docs: list = []
        self.lengths: list[int] = []
        self.waiting: list[np.ndarray] = []
        self.held = self.ids = 0

    def add(self, doc_id: object, ranks: np.ndarray) -> None:
        self.docs.append(doc_id)
        self.lengths.append(len(ranks))
        self.ids += len(ranks)
        self.waiting.append(ranks)
        self.held += len(ranks)
        if self.held >= BLOCK_IDS:
            self._write_blocks(whole=False)

    def _write_blocks(self, whole: bool) -> None:
        ranks = np.concatenate(self.waiting) if self.waiting else np.zeros(0, np.uint32)
        upto = len(ranks) if whole else len(ranks) // BLOCK_IDS * BLOCK_IDS
        for a in range(0, upto, BLOCK_IDS):
            part = ranks[a : min(a + BLOCK_IDS, upto)]
            control, spelled = pack(part)
            self.out.write(BLOCK.pack(len(part), len(spelled)) + control + spelled)
            self.size += BLOCK.size + len(control) + len(spelled)
        self.waiting = [ranks[upto:]]
        self.held = len(ranks) - upto

    def close(self) -> None:
        self._write_blocks(whole=True)
        index = pa.RecordBatch.from_arrays(
            [pa.array(self.docs, self.doc_type), pa.array(self.lengths, pa.int64())], names=["doc_id", "n_ids"]
        )
        stream = pa.BufferOutputStream()
        with pa.ipc.new_stream(stream, index.schema) as writer:
            writer.write_batch(index)
        told = stream.getvalue().to_pybytes() + TAIL.pack(self.size, self.ids, MAGIC)
        self.out.write(told)
        self.out.close()
        self.size += len(told)


def read_shard(path: str, id_of: np.ndarray) -> Iterator[tuple[object, np.ndarray]]:
    """The documents of a shard in order, each with its ids. Holds a block and a document at a time."""
    system, place = _open(path)
    with system.open_input_file(place) as file:
        size = file.size()
        file.seek(max(size - TAIL.size, 0))
        index_at, total, magic = TAIL.unpack(file.read(TAIL.size)) if size >= TAIL.size else (0, 0, b"")
        file.seek(0)
        if magic != MAGIC or file.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{path} is not a file of token ids")
        file.seek(index_at)
        index = pa.ipc.open_stream(file.read(size - TAIL.size - index_at)).read_all()
        if pc.sum(index["n_ids"]).as_py() != total:
            raise ValueError(f"{path} has an index of other documents")
        file.seek(len(MAGIC))
        held, at = np.zeros(0, np.uint32), len(MAGIC)
        for doc_id, n in zip(index["doc_id"].to_pylist(), index["n_ids"].to_pylist()):
            parts, got = [held], len(held)
            while got < n:
                if at >= index_at:
                    raise ValueError(f"{path} ends before its last document")
                count, spelled = BLOCK.unpack(file.read(BLOCK.size))
                control = -(-count // 4)
                parts.append(id_of.take(unpack(file.read(control), file.read(spelled), count)))
                got, at = got + count, at + BLOCK.size + control + spelled
            whole = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, whole[:n]
            held = whole[n:]
        if at != index_at or len(held):
            raise ValueError(f"{path} holds more ids than its documents")


@dataclass(frozen=True)
class TokenFiles:
    """A folder of shards. ``doc_type`` is the SQL type of the document ids."""

    spark: SparkSession
    folder: str
    doc_type: str = "bigint"

    @property
    def manifest(self) -> DataFrame:
        return self.spark.read.schema(MANIFEST).parquet(f"{self.folder}/{LISTED}")

    def placed(self) -> DataFrame:
        """The manifest with ``start``: the ids of all shards before each. One row per shard."""
        before = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
        return self.manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def read(self) -> DataFrame:
        """``doc_id, start, ids`` of every document: the ids before it, and its own as unsigned 32-bit little endian."""
        shards = self.manifest.count()
        spread = self.placed().repartitionByRange(max(1, min(shards, MAX_PARTITIONS)), "part", "shard")
        ranks = f"{self.folder}/{RANKS}"

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            id_of, docs, starts, ids, held = None, [], [], [], 0

            def flush() -> pa.RecordBatch:
                columns = [pa.array(docs, pa_kind), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())]
                return pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "ids"])

            for batch in batches:
                for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if id_of is None:
                        system, place = _open(ranks)
                        with system.open_input_file(place) as file:
                            id_of = np.frombuffer(file.read(), "<u4")
                    for doc_id, found in read_shard(path, id_of):
                        docs.append(doc_id)
                        starts.append(start)
                        ids.append(found.astype("<u4").tobytes())
                        start += len(found)
                        held += 4 * len(found)
                        if held >= BATCH_BYTES or len(docs) >= 10_000:
                            yield flush()
                            docs, starts, ids, held = [], [], [], 0
            if docs:
                yield flush()

        pa_kind = _arrow(self.doc_type)
        return spread.select("path", "start").mapInArrow(run, f"doc_id {self.doc_type}, start bigint, ids binary")


def _arrow(kind: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import DataType

    return to_arrow_type(DataType.fromDDL(kind))


def _ranked(
    batches: Iterator[pa.RecordBatch], rank_of: np.ndarray, id_kind: str
) -> Iterator[tuple[object, np.ndarray]]:
    """Documents with the ranks of their ids."""
    for batch in batches:
        for a in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(a, BATCH_ROWS)
            ids, lengths = _flat(part.column(1), id_kind)
            ranks, ends = rank_of.take(ids), np.cumsum(lengths)
            for doc_id, begin, end in zip(part.column(0).to_pylist(), (ends - lengths).tolist(), ends.tolist()):
                yield doc_id, ranks[begin:end]


def write_token_files(
    docs: DataFrame, path: str, folder: str, key: str = "doc_id", text: str = "text", shard_ids: int = SHARD_IDS
) -> TokenFiles:
    """Encode a text column with the tokenizer file ``path`` and write the ids to ``folder``.

    Documents are written in ascending order of ``key``, nulls first; those of
    one key in an order that depends on their ids alone. A null text has the end
    id alone; repeated rows are written each; other columns are ignored. An
    empty table gives a folder without shards. A text may be of any length; a
    shard ends behind the document that fills it, and a document is one value in
    its task. ``folder`` must be seen by all executors.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    with sql_conf(spark, {"spark.sql.parquet.compression.codec": "zstd"}):
        coded = materialize(encode_ids(docs, path, key, text), "ids")
    encoder = Encoder(path)
    size, id_kind = encoder.size(), encoder.kind
    # At most one row per id of the vocabulary.
    counted = id_counts(coded, size, id_kind).orderBy(F.desc("n"), "id").collect()
    ranked = np.array([row["id"] for row in counted], "<u4")
    rank_of = np.zeros(size, np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    root = folder.rstrip("/")
    system, place = _open(root)
    system.create_dir(place, recursive=True)
    with _open(f"{root}/{RANKS}")[0].open_output_stream(f"{place}/{RANKS}") as out:
        out.write(ranked.tobytes())

    total = sum(row["n"] for row in counted)
    least = min(spark.sparkContext.defaultParallelism, -(-total // PART_IDS))
    parts = max(1, least, min(-(-total // shard_ids), MAX_PARTITIONS))
    ordered = coded.withColumn("_tie", F.xxhash64("ids")).repartitionByRange(parts, "doc_id", "_tie")
    ordered = ordered.sortWithinPartitions("doc_id", "_tie").select("doc_id", "ids")
    doc_type = _arrow(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, attempt = TaskContext.get().partitionId(), uuid.uuid4().hex
        shard, done = None, []
        for doc_id, ranks in _ranked(batches, rank_of, id_kind):
            if shard is None:
                shard = ShardWriter(f"{root}/shard-{part:06d}-{len(done):06d}-{attempt}.ids", doc_type)
            shard.add(doc_id, ranks)
            if shard.ids >= shard_ids:
                shard.close()
                done.append(shard)
                shard = None
        if shard is not None:
            shard.close()
            done.append(shard)
        columns = [
            pa.array([part] * len(done), pa.int32()),
            pa.array(range(len(done)), pa.int32()),
            pa.array([s.path for s in done], pa.string()),
            *(pa.array(v, pa.int64()) for v in ([len(s.docs) for s in done], [s.ids for s in done], [s.size for s in done])),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "shard", "path", "n_docs", "n_ids", "n_bytes"])

    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{root}/{LISTED}")
    return TokenFiles(spark, root, kind)


def file_digests(docs: DataFrame, path: str) -> DataFrame:
    """Write all documents and read them back: ``doc_id, start, n_tokens, ids_crc32``, see ``write_token_files``."""
    files = write_token_files(docs, path, new_scratch(docs.sparkSession, "tokens"))
    return files.read().select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )
