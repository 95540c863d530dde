"""Price history as type 2 versions, and the lookup of the version valid on a day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapakdw.operators.ranges import (
    COPIES,
    COPY,
    FOLLOWING,
    RANGE_ROWS,
    START,
    cut_ranges,
    repeat_copies,
    walk_ranges,
)
from lapakdw.operators.unknown import UNKNOWN_SK
from lapakdw.runtime import broadcast_if_small, broadcast_up_to_limit, row_bytes

OPEN_END = "9999-12-31"

# Most versions of one key that a line is held against.
CANDIDATES = 366


def scd2_versions(
    df: DataFrame,
    key: str,
    start: str,
    sk: str,
    first_day: str,
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """Versions of ``key`` ordered by ``start``, with ``valid_from``, ``valid_to``, ``is_current`` and a dense key.

    A version ends the day before the next one starts. Of several rows with the
    same start only the last keeps a period; the others end before they begin.
    A missing start sorts last and counts from ``first_day``.

    The next version is the next row of the overall order, so a key with very
    many versions is spread over ranges like any other stretch of rows.
    """
    ranges = cut_ranges(df, [key, start], range_rows)
    rows = repeat_copies(walk_ranges(ranges, [key, start]), ranges.spread)
    following = F.when(F.col(FOLLOWING)[key].eqNullSafe(F.col(key)), F.col(FOLLOWING)[start])
    next_start = F.when(F.col(COPY) < F.col(COPIES) - 1, F.col(start)).otherwise(following)
    return rows.select(
        (F.col(START) + F.col(COPY) + 1).alias(sk),
        *df.columns,
        F.coalesce(F.col(start).cast("date"), F.lit(first_day).cast("date")).alias("valid_from"),
        F.coalesce(F.date_sub(next_start.cast("date"), 1), F.lit(OPEN_END).cast("date")).alias("valid_to"),
        next_start.isNull().alias("is_current"),
    )


class OverlapError(ValueError):
    """Several versions of a key are valid on one day."""


def overlapping_versions(versions: DataFrame, key: str) -> DataFrame:
    """``key`` and the number of its versions that start before an earlier one has ended.

    Versions without a period do not count. Overlaps come from rows without a
    start, which count from the first day and have no end.
    """
    earlier = Window.partitionBy(key).orderBy("valid_from", "valid_to").rowsBetween(Window.unboundedPreceding, -1)
    over = F.col("valid_from") <= F.max("valid_to").over(earlier)
    marked = versions.where("valid_from <= valid_to").withColumn("_over", over)
    return marked.groupBy(key).agg(F.count_if("_over").alias("overlaps")).where("overlaps > 0")


def scd2_lookup(
    facts: DataFrame, versions: DataFrame, key: str, day: str, sk: str, overlap: str = "keep"
) -> DataFrame:
    """Add the key of the version valid on ``day``; -1 where there is none.

    An equi-join on the business key with the period as a further condition.
    Versions without a period cannot match and are left out. Where a key still
    has more than ``CANDIDATES`` versions, the calendar year joins the equi-key;
    versions that follow one another then meet a line at most as often as a year
    has days. Where several versions are valid on one day, a line comes out once
    for each; ``overlap="error"`` raises an ``OverlapError`` instead if any
    versions overlap. The versions are broadcast if their measured size allows;
    otherwise the join shuffles and adaptive execution splits the hot keys.
    """
    if overlap not in ("keep", "error"):
        raise ValueError(f"overlap is 'keep' or 'error', not {overlap!r}")
    if overlap == "error" and (found := overlapping_versions(versions, key).first()) is not None:
        raise OverlapError(f"{found['overlaps']} versions of {found[key]!r} overlap earlier ones")
    lookup = versions.where(F.col("valid_from") <= F.col("valid_to")).select(
        F.col(key).alias("_key"), F.col(sk).alias("_sk"), "valid_from", "valid_to"
    )
    per_key = lookup.groupBy("_key").agg(
        F.count("*").alias("versions"),
        F.sum(row_bytes(lookup)).alias("bytes"),
        F.max(F.year("valid_from")).alias("year"),
    )
    most, size, last_year = per_key.agg(F.max("versions"), F.sum("bytes"), F.max("year")).first()
    match = (F.col(key) == F.col("_key")) & F.col(day).between(F.col("valid_from"), F.col("valid_to"))
    if (most or 0) > CANDIDATES:
        lookup, match = _by_year(lookup, match, day, last_year)
        lookup = broadcast_if_small(lookup)
    else:
        lookup = broadcast_up_to_limit(lookup, size or 0)
    return (
        facts.join(lookup, match, "left")
        .withColumn(sk, F.coalesce(F.col("_sk"), F.lit(UNKNOWN_SK)))
        .drop("_key", "_sk", "_year", "valid_from", "valid_to")
    )


def _by_year(lookup: DataFrame, match: Column, day: str, last_year: int) -> tuple[DataFrame, Column]:
    """A row per version and year it covers, and the join condition with the year in it.

    No version starts after ``last_year``, so all later days count as that year
    and open-ended versions stop there.
    """

    def year(date: str) -> Column:
        return F.least(F.year(date), F.lit(last_year))

    yearly = lookup.withColumn("_year", F.explode(F.sequence(year("valid_from"), year("valid_to"))))
    return yearly, match & (year(day) == F.col("_year"))


def code_lookup(facts: DataFrame, dim: DataFrame, value: Column, key: str, sk: str) -> DataFrame:
    """Add the surrogate key whose business key equals ``value``; -1 where there is none."""
    lookup = dim.select(F.col(key).alias("_key"), F.col(sk).alias("_sk"))
    return (
        facts.join(lookup, value == F.col("_key"), "left")
        .withColumn(sk, F.coalesce(F.col("_sk"), F.lit(UNKNOWN_SK)))
        .drop("_key", "_sk")
    )
