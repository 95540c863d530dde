"""Byte-level BPE: whole texts to token ids and back.

Texts are cut into pieces without a regular expression. Every code point is
looked up in a class table; a little lookahead turns the classes into letters
of a finite automaton; every letter is a function from state to state, and the
running composition of these functions, an associative scan over blocks of the
array, yields the state in front of every character and with it where pieces
begin. Pieces are merged pair by pair and kept in a bounded cache.

All of it runs inside Spark tasks on Arrow batches; vocabulary files are read
by each worker from a path that all of them have.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from lapakdw.llm.text import free_name

# Pieces a worker remembers twice of, the newer and the older ones, and the longest it remembers.
CACHE_PIECES = 75_000
CACHE_CHARS = 64
# Bits of a token id.
ID_BITS = 32
# Characters, or bytes of text, handled at once.
CHUNK_CHARS = 1_000_000
# Every so many pieces the place of the piece is kept.
OFFSET_EVERY = 64

# Classes of code points.
LETTER, NUMBER, OTHER, APOSTROPHE, SPACE, BLANK = range(6)
# Letters of the automaton. A short mark is an apostrophe with one matching character behind it, a long
# mark one with two. Last: a white space character in front of something else; inner: any other.
L, N, O, SHORT, LONG, SPACE_LAST, BLANK_LAST, INNER = range(8)  # noqa: E741
KINDS = 8
# States: a piece just ended; in a run of letters, numbers, others; behind a leading space; in white
# space; one or two characters of a contraction to come.
FRESH, IN_L, IN_N, IN_O, LED, IN_BLANK, ONE, TWO = range(8)
STATES = 8

# What may follow the apostrophe of a contraction.
SHORT_ENDS, LONG_ENDS = "stmd", ("re", "ve", "ll")


def _next(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a piece begins at this character.

    Only letters follow in a contraction, and no letter follows inner white
    space; what such pairs would yield does not matter and is kept simple.
    """
    if kind == L and state in (TWO, ONE):
        return (ONE if state == TWO else FRESH), False
    if kind in (SHORT, LONG):
        if state in (IN_O, LED):
            return IN_O, False
        return (ONE if kind == SHORT else TWO), True
    run = {L: IN_L, N: IN_N, O: IN_O}.get(kind)
    if run is not None:
        return run, state not in (run, LED)
    if kind == INNER:
        return IN_BLANK, state != IN_BLANK
    return (LED if kind == SPACE_LAST else FRESH), True


class Monoid:
    """All functions from state to state that kinds compose to, numbered, with their composition table."""

    def __init__(self) -> None:
        step = [tuple(_next(s, k)[0] for s in range(STATES)) for k in range(KINDS)]
        # The first character of a text acts as if the state were FRESH, whatever came before.
        step += [(step[k][FRESH],) * STATES for k in range(KINDS)]
        found = {tuple(range(STATES)): 0}
        todo = list(found)
        for f in todo:
            for g in step:
                h = tuple(g[x] for x in f)
                if h not in found:
                    found[h] = len(found)
                    todo.append(h)
        functions = list(found)
        self.size = len(functions)
        self.of_kind = np.array([found[g] for g in step], np.uint8)
        self.product = np.array(
            [found[tuple(g[x] for x in f)] for f in functions for g in functions], np.uint8
        )  # first f, then g
        self.from_fresh = np.array([f[FRESH] for f in functions], np.uint8)
        self.begins = np.array([_next(s, k)[1] for s in range(STATES) for k in range(KINDS)], bool)

    def compose(self, f: np.ndarray, g: np.ndarray) -> np.ndarray:
        return self.product.take(f.astype(np.uint16) * np.uint16(self.size) + g)

    def scan(self, elements: np.ndarray, block: int = 128) -> np.ndarray:
        """Composition of all elements up to and including each."""
        n = len(elements)
        if n <= 1:
            return elements
        rows = -(-n // block)
        padded = np.zeros(rows * block, np.uint8)
        padded[:n] = elements
        a = np.ascontiguousarray(padded.reshape(rows, block).T)
        for j in range(1, block):
            a[j] = self.compose(a[j - 1], a[j])
        if rows > 1:
            a[:, 1:] = self.compose(np.broadcast_to(self.scan(a[-1], block)[:-1], (block, rows - 1)), a[:, 1:])
        return a.T.ravel()[:n]


@cache
def monoid() -> Monoid:
    return Monoid()


@cache
def code_classes() -> np.ndarray:
    """Class of every code point, as the Unicode tables of the tokenizer library have them."""
    import tiktoken

    single = {bytes([i]): i for i in range(256)}
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (i for i in range(0x110000) if not 0xD800 <= i < 0xE000)))
    for pattern, value in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        probe = tiktoken.Encoding("probe", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        matched = bytes(probe.encode_ordinary(every)).decode("utf-8")
        table[np.frombuffer(matched.encode("utf-32-le"), "<u4")] = value
    table[ord(" ")], table[ord("'")] = SPACE, APOSTROPHE
    return table


def piece_starts(text: str, firsts: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts written one behind the other, of which ``firsts`` are the first characters."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    classes = code_classes().take(codes)
    blank = classes >= SPACE
    ends_before = np.zeros(n + 2, bool)  # a text begins here, or nothing is left
    ends_before[firsts] = True
    ends_before[n:] = True
    kinds = np.minimum(classes, O)
    followed = np.zeros(n, bool)
    followed[:-1] = ~blank[1:]
    followed &= ~ends_before[1 : n + 1]
    kinds[blank] = INNER
    kinds[(classes == SPACE) & followed] = SPACE_LAST
    kinds[(classes == BLANK) & followed] = BLANK_LAST
    for i in np.flatnonzero(classes == APOSTROPHE).tolist():
        if not ends_before[i + 1]:
            if text[i + 1] in SHORT_ENDS:
                kinds[i] = SHORT
            elif not ends_before[i + 2] and text[i + 1 : i + 3] in LONG_ENDS:
                kinds[i] = LONG
    m = monoid()
    letters = kinds.copy()
    letters[firsts] += KINDS
    after = m.from_fresh.take(m.scan(m.of_kind.take(letters)))
    before = np.empty(n, np.uint8)
    before[0] = FRESH
    before[1:] = after[:-1]
    before[firsts] = FRESH
    return np.flatnonzero(m.begins.take(before * np.uint8(KINDS) + kinds))


class Vocabulary:
    """Ranks of a vocabulary file, and the cached merging of pieces."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.tokens[rank] = token
        # Token of every two tokens that spell one together, by both their ids in one number.
        self.joined = {
            left << ID_BITS | right: rank
            for token, rank in self.rank.items()
            for i in range(1, len(token))
            if (left := self.rank.get(token[:i])) is not None and (right := self.rank.get(token[i:])) is not None
        }
        self.width = np.array([len(t) for t in self.tokens], np.int64)
        self.first = np.cumsum(self.width) - self.width
        self.spelled = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.single = [self.rank[bytes([i])] for i in range(256)]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drop the remembered pieces."""
        self.known, self.older = {}, {}

    def merge(self, piece: bytes) -> list[int]:
        """Join the neighbouring pair of smallest rank, the first of equals, until no pair has a rank."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > 2 * CACHE_CHARS:
            return self._merge_long(piece)
        joined, none = self.joined.get, 1 << 60
        ids = [self.single[b] for b in piece]
        pairs = [joined(x << ID_BITS | y, none) for x, y in zip(ids, ids[1:])]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            ids[i] = least  # the rank of a token is its id
            del ids[i + 1], pairs[i]
            if i < len(pairs):
                pairs[i] = joined(least << ID_BITS | ids[i + 1], none)
            if i:
                pairs[i - 1] = joined(ids[i - 1] << ID_BITS | least, none)
        return ids

    def _merge_long(self, piece: bytes) -> list[int]:
        """The same with a heap, for pieces of any length."""
        n = len(piece)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        end = list(range(1, n + 1))  # of the part that begins here; 0 once it is gone
        heap: list[tuple[int, int, int]] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (r := self.rank.get(piece[i : end[j]])) is not None:
                heapq.heappush(heap, (r, i, end[j]))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i] if end[i] else n
            if j >= n or end[j] != stop:
                continue
            end[i], end[j] = stop, 0
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            offer(i)
            if left[i] >= 0:
                offer(left[i])
        return [self.rank[piece[i : end[i]]] for i in range(n) if end[i]]

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Token ids of each piece as little-endian 32-bit numbers."""
        if len(self.known) > CACHE_PIECES:
            self.known, self.older = {}, self.known  # what is still in use is taken over piece by piece
        known, older = self.known, self.older
        once = {}
        for piece in set(pieces).difference(known):
            ids = older.get(piece) or array("i", self.merge(piece.encode("utf-8"))).tobytes()
            (known if len(piece) <= CACHE_CHARS else once)[piece] = ids
        return [known.get(p) or once[p] for p in pieces] if once else list(map(known.__getitem__, pieces))

    def encode_texts(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
        """Ids of all texts, where each text's ids end, and per text the kept places: character and token of pieces."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        begins = ends - lengths
        whole = "".join(texts)
        starts = piece_starts(whole, begins[lengths > 0])
        at = starts.tolist()
        pieces = [whole[a:b] for a, b in zip(at, [*at[1:], len(whole)])]
        coded = self.encode_pieces(pieces)
        ids = np.frombuffer(b"".join(coded), "<i4")
        upto = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, coded), np.int64, len(coded)) // 4, out=upto[1:])
        first, last = np.searchsorted(starts, begins), np.searchsorted(starts, ends)
        chars = [starts[a:b:OFFSET_EVERY] - s for a, b, s in zip(first, last, begins)]
        tokens = [upto[a:b:OFFSET_EVERY] - upto[a] for a, b in zip(first, last)]
        return ids, upto[last], chars, tokens

    def decode(self, ids: Sequence[int]) -> bytes:
        """The bytes of the ids: for every byte its place among the spelled tokens, and one lookup for all."""
        ids = np.asarray(ids, np.int64)
        if len(ids) > CHUNK_CHARS:
            return b"".join(self.decode(ids[a : a + CHUNK_CHARS]) for a in range(0, len(ids), CHUNK_CHARS))
        width = self.width.take(ids)
        shift = self.first.take(ids) - (np.cumsum(width) - width)
        return self.spelled.take(np.repeat(shift, width) + np.arange(width.sum())).tobytes()

    def gives_back(self, ids: np.ndarray, offsets: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether the ids of each text decode to its bytes."""
        decoded = self.decode(ids)
        upto = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(self.width.take(ids), out=upto[1:])
        at = upto.take(offsets).tolist()
        return [decoded[a:b] == t.encode("utf-8") for a, b, t in zip(at, at[1:], texts)]

    def decode_from(self, ids: Sequence[int], chars: Sequence[int], tokens: Sequence[int], start: int, end: int) -> str:
        """The characters ``start`` to ``end`` of a text, decoded from the nearest kept places around them."""
        if not len(chars) or end <= start:
            return ""
        a = max(int(np.searchsorted(chars, start, "right")) - 1, 0)
        b = int(np.searchsorted(chars, end))
        stop = tokens[b] if b < len(tokens) else len(ids)
        return self.decode(ids[tokens[a] : stop]).decode("utf-8")[start - chars[a] : end - chars[a]]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _lists(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def text_slices(column: pa.Array, most: int = CHUNK_CHARS) -> Iterator[tuple[int, int, list[str]]]:
    """Stretches of rows (begin, end, texts) with about ``most`` bytes of text; a longer text is one of its own.

    Only one stretch at a time becomes Python strings. A null is an empty text.
    """
    begin = size = 0
    for i, length in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if i > begin and size + length > most:
            yield begin, i, [t or "" for t in column.slice(begin, i - begin).to_pylist()]
            begin, size = i, 0
        size += length
    if begin < len(column):
        yield begin, len(column), [t or "" for t in column.slice(begin).to_pylist()]


def encode(
    df: DataFrame, path: str, text: str = "text", keep: Sequence[str] | None = None, verify: str | None = None
) -> DataFrame:
    """Encode a text column: the columns ``keep`` (all but the text by default), ``ids``, ``piece_chars``, ``piece_tokens``.

    ``ids`` are the token ids of the whole text, without special tokens; the
    other two tell at which character and at which token every
    ``OFFSET_EVERY``-th piece begins. A null text is encoded as the empty one,
    with no ids. Rows are handled one by one and keep their number. A clash of
    a kept name with a new one is an error. ``verify`` names a further column:
    whether decoding the ids gives back the bytes of the text, found out in the
    same task.
    """
    names = [c for c in df.columns if c != text] if keep is None else list(keep)
    new = ["ids", "piece_chars", "piece_tokens"]
    told = [] if verify is None else [verify]
    if clash := set(names) & {*new, *told}:
        raise ValueError(f"columns {sorted(clash)} exist already")
    taken = df.select(*names, df[text].alias(free_name(df, "text_")))
    fields = [taken.schema[name] for name in names]
    fields += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in new]
    schema = T.StructType(fields + [T.StructField(n, T.BooleanType()) for n in told])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for a, b, texts in text_slices(batch.column(len(names))):
                ids, ends, chars, tokens = vocab.encode_texts(texts)
                offsets = np.zeros(b - a + 1, np.int32)
                offsets[1:] = ends
                columns = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                columns += [pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), _lists(chars), _lists(tokens)]
                if told:
                    columns.append(pa.array(vocab.gives_back(ids, offsets, texts), pa.bool_()))
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *new, *told])
        vocab.forget()  # workers outlive their tasks, and later stages need the memory

    return taken.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Add the bytes that an array of ids stands for; null where the array is null."""
    schema = T.StructType([*df.schema.fields, T.StructField(name, T.BinaryType())])
    names = list(df.columns)
    place = names.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                column = part.column(place)
                numbers = column.flatten().to_numpy()
                data = vocab.decode(numbers)
                bytes_upto = np.concatenate([[0], np.cumsum(vocab.width.take(numbers))])
                lengths = pc.fill_null(column.value_lengths(), 0).to_numpy()
                offsets = bytes_upto[np.concatenate([[0], np.cumsum(lengths)])]
                buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data)]
                spelled = pa.Array.from_buffers(pa.large_binary(), len(column), buffers).cast(pa.binary())
                found = pc.if_else(column.is_valid(), spelled, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, found], names=[*names, name])

    return df.mapInArrow(run, schema)
