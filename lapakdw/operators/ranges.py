"""Dense numbering and neighbour lookup over a total order, without one big sort task.

A window without a partition puts the whole table into one task. Here the
distinct rows are cut into contiguous key ranges, each range is ordered on its
own, and a table with one row per range carries the totals and the first row of
the following range across the cuts. Identical rows travel as one row with a
count, so any number of copies of a row cost one row until the very end.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapakdw.runtime import broadcast_up_to_limit, materialize

# Up to this many rows the order is made in one range (one task sorts it).
RANGE_ROWS = 1_000_000

# Copies of one row written out by one task.
COPY_CHUNK = 100_000

RANGE, COPIES, COPY = "_range", "_copies", "_copy"
START, FOLLOWING = "_start", "_following"


def nulls_last(columns: list[str]) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def total_order(df: DataFrame, order: list[str]) -> list[str]:
    """The order columns, then every other column as a tie-breaker."""
    return [*order, *(c for c in df.columns if c not in order)]


@dataclass(frozen=True)
class Ranges:
    """Distinct rows with their count, each in a numbered stretch of the order."""

    frame: DataFrame
    order: list[str]
    single: bool
    # Whether some row has more copies than one task should write out.
    spread: bool = False


def cut_ranges(df: DataFrame, order: list[str], range_rows: int = RANGE_ROWS) -> Ranges:
    """Count equal rows and cut the order into stretches of about ``range_rows`` rows."""
    full = total_order(df, order)
    counted = df.groupBy(*full).agg(F.count("*").alias(COPIES))
    rows = df.count()
    if rows <= range_rows:
        return Ranges(counted.withColumn(RANGE, F.lit(0)), full, single=True)
    cut = counted.repartitionByRange(math.ceil(rows / range_rows), *nulls_last(full))
    # The cuts come from a sample, so they are fixed by writing them down.
    cut = materialize(cut.withColumn(RANGE, F.spark_partition_id()), "ranges")
    most = cut.agg(F.max(COPIES).alias("most")).first()["most"]
    return Ranges(cut, full, single=False, spread=most > COPY_CHUNK)


def walk_ranges(ranges: Ranges, carry: list[str]) -> DataFrame:
    """Add ``_start`` (rows before this one) and ``_following`` (``carry`` of the next distinct row)."""
    local = Window.partitionBy(RANGE).orderBy(*nulls_last(ranges.order))
    before = F.sum(COPIES).over(local.rowsBetween(Window.unboundedPreceding, -1))
    walked = ranges.frame.select(
        "*",
        F.coalesce(before, F.lit(0)).alias(START),
        F.lead(F.struct(*carry)).over(local).alias(FOLLOWING),
    )
    if ranges.single:
        return walked
    # One row per range: the table's rows divided by the rows per range.
    sortable = F.struct(*(part for c in ranges.order for part in (F.col(c).isNull().alias(f"{c}_null"), F.col(c))))
    edges = ranges.frame.groupBy(RANGE).agg(F.sum(COPIES).alias("_rows"), F.min(sortable).alias("_first"))
    across = Window.orderBy(RANGE)
    skipped = F.sum("_rows").over(across.rowsBetween(Window.unboundedPreceding, -1))
    edges = edges.select(
        RANGE,
        F.coalesce(skipped, F.lit(0)).alias("_skipped"),
        F.lead("_first").over(across).alias("_next"),
    )
    edges = materialize(edges, "edges")
    size = edges.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0]
    beyond = F.when(F.col("_next").isNotNull(), F.struct(*(F.col("_next")[c].alias(c) for c in carry)))
    return (
        walked.join(broadcast_up_to_limit(edges, size or 0), RANGE)
        .withColumn(START, F.col(START) + F.col("_skipped"))
        .withColumn(FOLLOWING, F.coalesce(F.col(FOLLOWING), beyond))
        .drop("_skipped", "_next")
    )


def repeat_copies(walked: DataFrame, spread: bool) -> DataFrame:
    """Write every row out as often as it was counted; ``_copy`` numbers the copies from 0.

    With ``spread``, chunks of one much-copied row go to different tasks first.
    """
    last_chunk = F.floor((F.col(COPIES) - 1) / COPY_CHUNK)
    chunks = walked.withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), last_chunk)))
    if spread:
        chunks = chunks.repartition(START, "_chunk")
    lo = F.col("_chunk") * COPY_CHUNK
    hi = F.least(lo + COPY_CHUNK, F.col(COPIES)) - 1
    return chunks.withColumn(COPY, F.explode(F.sequence(lo, hi))).drop("_chunk")


def surrogate_key(df: DataFrame, order: list[str], name: str, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Dense 1..N key in the order of the business key, nulls last.

    Rows that agree on the business key are ordered by their other columns, so
    a rebuild gives the same keys.
    """
    ranges = cut_ranges(df, order, range_rows)
    numbered = repeat_copies(walk_ranges(ranges, order[:1]), ranges.spread)
    return numbered.select((F.col(START) + F.col(COPY) + 1).alias(name), *df.columns)
