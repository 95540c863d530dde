"""Secret scans: fixed patterns, and runs of characters that a tokenizer vocabulary spells out poorly.

A vocabulary learnt from ordinary text covers words, names and numbers in few
tokens; random strings need nearly a token for every one or two characters.
Runs with few characters per token are reported, unless they are labelled
digests, UUIDs or other well-known identifiers.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapakdw.llm.bpe import Vocabulary, text_slices, vocabulary
from lapakdw.llm.text import let

# The base patterns, and how long a finding must be.
ASSIGN = re.compile(
    r"""(?a:(?i:(password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16

# Kinds, in the order in which spans that start together are told.
KINDS = ("assign", "access", "hex", "random")

# A random string has this many characters or more, and at most this many of them per token. Words, also
# foreign and invented ones, have more; hexadecimal text has about 1.7, base 64 about 1.5.
RANDOM_CHARS = 20
CHARS_PER_TOKEN = 1.9
# A longer run is also judged, and reported, in even cuts of about this size.
WINDOW_CHARS = 64

# Text just in front of a run that makes it a known digest, if the run has the form of one.
LABELLED = re.compile(
    r"""(?ai:\b(?:md5|sha-?(?:1|224|256|384|512)|blake2[bs]?|digest|checksum|integrity|etag|commit|rev(?:ision)?|sri|crc32|uuid|guid|doi|isbn|issn|arxiv|urn|build|hash)["']?\s{0,3}[:=#/-]?\s{0,3}["']?)$"""
)
# The digests of 16, 20, 24, 28, 32, 48 and 64 bytes in hexadecimal, and all but those of 24 in base 64,
# there with or without padding.
DIGEST = re.compile(
    r"(?a:(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{48}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}"
    r"|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{48}|[0-9A-F]{56}|[0-9A-F]{64}|[0-9A-F]{96}|[0-9A-F]{128}"
    r"|[A-Za-z0-9+/_-]{22}(?:==)?|[A-Za-z0-9+/_-]{27}=?|[A-Za-z0-9+/_-]{38}(?:==)?|[A-Za-z0-9+/_-]{43}=?"
    r"|[A-Za-z0-9+/_-]{64}|[A-Za-z0-9+/_-]{86}(?:==)?)$)"
)
UUID = re.compile(r"(?ai:[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})$")
SRI = re.compile(r"(?a:sha(?:256|384|512)-[A-Za-z0-9+/]{40,90}={0,2})$")
DATED = re.compile(r"(?a:\d{4}-?\d\d-?\d\d(?:[T_-]?[\d.+Z-]*)?)$")
# The same where they stand between separators of a longer run.
EMBEDDED = re.compile(
    r"""(?a:(?<![A-Za-z0-9])(?:(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})|sha(?:256-[A-Za-z0-9+/]{43}=?|384-[A-Za-z0-9+/]{64}|512-[A-Za-z0-9+/]{86}={0,2})|(?:19|20)\d\d(?P<dash>[-/_]?)(?:0[1-9]|1[0-2])(?P=dash)(?:0[1-9]|[12]\d|3[01])(?:[T_-]\d{2,6}Z?)?)(?![A-Za-z0-9]))"""
)

_HEX, _RUN, _ALNUM, _LETTER = 1, 2, 4, 8
_flags = np.zeros(128, np.uint8)
for _c in map(ord, "0123456789abcdef"):
    _flags[_c] |= _HEX
for _c in map(ord, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"):
    _flags[_c] |= _RUN | (_ALNUM if chr(_c).isalnum() else 0) | (_LETTER if chr(_c).isalpha() else 0)


def _runs(inside: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the runs of true values that are long enough."""
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return zip(starts[long].tolist(), ends[long].tolist())


def known_identifier(text: str, start: int, end: int) -> bool:
    """Is this run a labelled digest, a UUID, an integrity value, a date, a number or a line of marks?"""
    run = text[start:end]
    if not re.search("[A-Za-z]", run):
        return True
    if UUID.match(run) or SRI.match(run) or DATED.match(run):
        return True
    return DIGEST.match(run) is not None and LABELLED.search(text, max(0, start - 24), start) is not None


def chars_per_token(vocab: Vocabulary, run: str) -> float:
    return len(run) / max(1, len(vocab.merge(run.encode("utf-8"))))


def _poor_windows(vocab: Vocabulary, run: str) -> Iterator[tuple[int, int]]:
    """Every window of the run's tokens, of RANDOM_CHARS or just more, that holds a letter and has few characters per token.

    A window is widened up to the separators around it, as a secret does not end amid letters and digits.
    """
    width = vocab.width.take(vocab.merge(run.encode("utf-8")))
    ends = np.cumsum(width)
    starts = ends - width
    last = np.searchsorted(ends, starts + RANDOM_CHARS)
    first = np.flatnonzero(last < len(ends))
    last = last[first]
    a, b = starts[first], ends[last]
    codes = np.frombuffer(run.encode("utf-8"), np.uint8)
    letters = np.concatenate([[0], np.cumsum(_flags.take(codes) & _LETTER > 0)])
    poor = (b - a <= CHARS_PER_TOKEN * (last - first + 1)) & (letters[b] > letters[a])
    place = np.arange(len(codes))
    mark = _flags.take(codes) & _ALNUM == 0
    back = np.maximum.accumulate(np.where(mark, place, 0))  # the start, or the separator in front
    ahead = np.minimum.accumulate(np.where(mark, place + 1, len(codes))[::-1])[::-1]  # behind the next separator
    yield from zip(back[a[poor]].tolist(), ahead[b[poor] - 1].tolist())


def _judged_parts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """What UUIDs, integrity values and dates between separators leave of a run, if it is long enough."""
    at = start
    for m in EMBEDDED.finditer(text, start, end):
        if m.start() - at >= RANDOM_CHARS:
            yield at, m.start()
        at = m.end()
    if end - at >= RANDOM_CHARS:
        yield at, end


def _random_spans(vocab: Vocabulary, text: str, start: int, end: int) -> Iterator[tuple[str, int, int]]:
    """Stretches of a run that the vocabulary spells out poorly, joined where they overlap or touch.

    The run is judged in even cuts of about WINDOW_CHARS, and in overlapping windows of about RANDOM_CHARS, so
    that neither words in front nor the place of a cut hide a secret.
    """
    if known_identifier(text, start, end):
        return
    count = max(1, (end - start) // WINDOW_CHARS)
    cuts = [start + (end - start) * i // count for i in range(count + 1)]
    poor = [(a, b) for a, b in zip(cuts, cuts[1:]) if chars_per_token(vocab, text[a:b]) <= CHARS_PER_TOKEN]
    for a, b in _judged_parts(text, start, end):
        poor += [(a + x, a + y) for x, y in _poor_windows(vocab, text[a:b])]
    held: tuple[int, int] | None = None
    for a, b in sorted(poor):
        if held and a <= held[1]:
            held = (held[0], max(held[1], b))
        else:
            if held:
                yield "random", *held
            held = (a, b)
    if held:
        yield "random", *held


def _without(runs: list[tuple[int, int]], base: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What sorted base spans leave of sorted runs, if it is long enough."""
    k = 0
    for start, end in runs:
        while k < len(base) and base[k][1] <= start:
            k += 1
        at, j = start, k
        while j < len(base) and base[j][0] < end:
            if base[j][0] - at >= RANDOM_CHARS:
                yield at, base[j][0]
            at, j = max(at, base[j][1]), j + 1
        if end - at >= RANDOM_CHARS:
            yield at, end


def scan_texts(vocab: Vocabulary, texts: list[str]) -> list[list[tuple[str, int, int]]]:
    """Spans (kind, start, end) of each text: code points, end exclusive, by start and kind."""
    found: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    lengths = [len(t) + 1 for t in texts]
    whole = "\n".join([*texts, ""])  # a line break keeps the runs of neighbours apart
    codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    flags = _flags.take(np.minimum(codes, 127)) * (codes < 128)
    begins = np.cumsum([0, *lengths])

    def owner(start: int) -> tuple[int, int]:
        i = int(np.searchsorted(begins, start, "right")) - 1
        return i, int(begins[i])

    for a, b in _runs((flags & _HEX) > 0, HEX_CHARS):
        i, at = owner(a)
        found[i].append(("hex", a - at, b - at))
    runs: dict[int, list[tuple[int, int]]] = {}
    for a, b in _runs((flags & _RUN) > 0, RANDOM_CHARS):
        i, at = owner(a)
        runs.setdefault(i, []).append((a - at, b - at))
    for i, text in enumerate(texts):
        if "AKIA" in text:
            found[i] += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
        low = text.lower()
        if any(word in low for word in ASSIGN_WORDS):
            found[i] += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_CHARS]
        base = sorted((a, b) for _, a, b in found[i])
        for a, b in _without(runs.get(i, []), base):
            found[i] += _random_spans(vocab, text, a, b)
        found[i].sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return found


SPAN = T.StructType(
    [T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]
)


def find_secrets(df: DataFrame, path: str, text: str = "text", name: str = "spans") -> DataFrame:
    """Replace or add the column ``name``: an array of (kind, start, end), by start and kind.

    ``path`` is the vocabulary file. Whole texts are searched; null and empty
    texts have no spans. Rows keep their number and all other columns.
    """

    @F.arrow_udf(T.ArrayType(SPAN))
    def scan(column: pa.Array) -> pa.Array:
        vocab = vocabulary(path)
        rows: list[list[tuple[str, int, int]]] = []
        for _, _, texts in text_slices(column):
            rows += scan_texts(vocab, texts)
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        return pa.array([[dict(zip(("kind", "start", "end"), s)) for s in spans] for spans in rows], kind)

    return df.withColumn(name, scan(F.col(text)))


def span_texts(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redact(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with every stretch of overlapping or touching spans replaced by ``mark``."""
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("upto"))

    # The text is bound by let: inside a lambda, a column name could be taken for an alias of the same select.
    def clean(t: Column) -> Column:
        def step(acc: Column, s: Column) -> Column:
            between = F.substring(t, acc["upto"] + 1, s["start"] - acc["upto"])
            fresh = (s["start"] > acc["upto"]) | (acc["done"] == "")
            done = F.when(fresh, F.concat(acc["done"], between, F.lit(mark))).otherwise(acc["done"])
            return F.struct(done.alias("done"), F.greatest(acc["upto"], s["end"]).alias("upto"))

        def finish(acc: Column) -> Column:
            return F.concat(acc["done"], F.substring(t, acc["upto"] + 1, F.char_length(t)))

        return F.aggregate(spans, start, step, finish)

    return F.when(F.size(spans) > 0, let(text, clean)).otherwise(text)
