"""Word and row-key expressions shared by the operators; built-in functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapakdw.runtime import MB

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A word is a run of digits, small letters and characters beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The same before A-Z are lower-cased.
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Largest measured size of a side that is broadcast by these operators.
BROADCAST_BYTES = 32 * MB


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text, in order; none where it is null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_ANY_CASE)).cast("long")


def text_key(text: Column) -> Column:
    """Tells rows of one id with different texts apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows: eight bytes a value, and what texts and arrays of numbers hold. One job."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            width += F.coalesce(F.octet_length(f.name), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            width += 8 * F.greatest(F.size(f.name), F.lit(0))
    return df.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def broadcast_if_measured(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a stored side for broadcast if one counting job finds it small; else leave it to the planner."""
    return F.broadcast(df) if measured_bytes(df) <= limit else df
