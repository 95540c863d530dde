"""Column expressions that turn raw text into typed values.

The rules follow the SQL dialect the results have to agree with, where it
differs from Spark's own casts: text such as ``12.5`` becomes a whole number by
rounding half away from zero, and doubles are rounded after scaling.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(15,2)"
AMOUNT = "decimal(18,2)"
_WIDE = "decimal(38,10)"


def to_int(col: Column, dtype: str = "int") -> Column:
    """Text to whole number; malformed text is an error."""
    return F.coalesce(col.try_cast(dtype), F.round(col.cast(_WIDE), 0).cast(dtype))


def try_int(col: Column, dtype: str = "int") -> Column:
    """Text to whole number; malformed text is NULL."""
    return F.coalesce(col.try_cast(dtype), F.round(col.try_cast(_WIDE), 0).try_cast(dtype))


def try_double(col: Column) -> Column:
    return col.try_cast("double")


def to_money(col: Column) -> Column:
    return col.cast(MONEY)


def is_blank(col: Column) -> Column:
    """NULL or the empty string, never NULL itself."""
    return F.coalesce(col == "", F.lit(True))


def code(col: Column) -> Column:
    """A dictionary code: trimmed, upper case."""
    return F.upper(F.trim(col))


def yes(col: Column) -> Column:
    """True for 'ya' in any case or padding; anything else, NULL included, is false."""
    return F.coalesce(F.lower(F.trim(col)) == "ya", F.lit(False))


def business_date(col: Column, local_tz: str | None = None) -> Column:
    """Calendar date of a time text.

    By default the date is taken as written. With ``local_tz``, texts that end
    in 'Z' are read as UTC and moved to that zone first.
    """
    if local_tz is None:
        return col.cast("date")
    stamp = F.regexp_replace(col, "Z$", "").cast("timestamp_ntz")
    moved = F.convert_timezone(F.lit("UTC"), F.lit(local_tz), stamp)
    return F.when(col.endswith("Z"), moved).otherwise(stamp).cast("date")


def round_half(col: Column, digits: int) -> Column:
    """Round a double to ``digits`` places: scale, round half away from zero, scale back."""
    scale = float(10**digits)
    return F.round(col * F.lit(scale), 0) / F.lit(scale)


def ratio(over: Column, under: Column) -> Column:
    """Division in doubles; a zero divisor gives NULL."""
    return over.cast("double") / F.nullif(under.cast("double"), F.lit(0.0))


def percent(over: Column, under: Column) -> Column:
    """``100 * over / under`` in doubles; a zero divisor gives NULL."""
    return F.lit(100.0) * over.cast("double") / F.nullif(under.cast("double"), F.lit(0.0))
