"""Line de-duplication and the gate that lets only consistent headers through."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapakdw.runtime import fits_broadcast, measured_bytes, scan_bytes
from lapakdw.sources.raw import ITEM_COLUMNS

HEADER_KEY = "transaction_id"

# Header field -> name of its count in the report.
CHECKED = {
    "outlet_id": "outlet_count",
    "tanggal_waktu": "tanggal_count",
    "status": "status_count",
    "total_bayar": "total_bayar_count",
}


def items_dedup(items: DataFrame) -> DataFrame:
    """Lines that agree in all columns, once. The shuffle is on all columns, so a hot header spreads."""
    return items.select(*ITEM_COLUMNS).distinct()


# Lines looked at to find heavy header ids, about, and how many of them make an id heavy.
SAMPLED_LINES = 1_000_000
HEAVY_LINES = 1_000
# Most header ids that are treated as heavy: all that can hold a thousandth of the sample.
MOST_HEAVY = SAMPLED_LINES // HEAVY_LINES
# Bytes of file that a line takes at least, about.
LINE_BYTES = 16


def heavy_headers(items: DataFrame) -> list[str]:
    """Header ids that hold about a thousandth of all lines or more, from a sample of the id column. One small job."""
    lines = scan_bytes(items) / LINE_BYTES
    share = min(1.0, SAMPLED_LINES / lines) if lines else 1.0
    ids = items.select(HEADER_KEY).where(F.col(HEADER_KEY).isNotNull())
    counted = ids.sample(share, seed=1).groupBy(HEADER_KEY).agg(F.count("*").alias("lines"))
    found = counted.where(F.col("lines") >= HEAVY_LINES).orderBy(F.desc("lines"), HEADER_KEY).limit(MOST_HEAVY)
    return [row[HEADER_KEY] for row in found.collect()]


def lines_of_headers(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines that agree in all columns once, joined with the header of their id; lines without one drop out.

    ``headers`` is a stored table with one row per id. One shuffle of the lines
    serves both steps. If the headers are measured small, they are broadcast:
    lines without one go first, the others meet in a shuffle on all columns,
    which combines copies within each task and spreads the lines of any header.
    Otherwise lines are shuffled by header id, joined where they arrive and
    de-duplicated there. The join comes first: its sort makes use of any order
    in which lines arrive, and fewer of them are left to group. Whole joined rows
    are grouped, which agree where lines do: a grouping by the columns of lines
    would hold the others twice in memory. Lines of ids
    that a sample finds heavy go the first way, with their few headers
    broadcast, so no task gets all lines of such an id.
    """
    lines = items.select(*ITEM_COLUMNS).where(F.col(HEADER_KEY).isNotNull())

    def spread(some: DataFrame, few: DataFrame) -> DataFrame:
        known = some.join(F.broadcast(few.select(HEADER_KEY)), HEADER_KEY, "left_semi")
        return known.distinct().join(F.broadcast(few), HEADER_KEY)

    if fits_broadcast(measured_bytes(headers)):
        return spread(lines, headers)

    def together(some: DataFrame) -> DataFrame:
        return some.repartition(HEADER_KEY).join(headers, HEADER_KEY).distinct()

    heavy = heavy_headers(items)
    if not heavy:
        return together(lines)
    is_heavy = F.col(HEADER_KEY).isin(*heavy)
    light = together(lines.where(~is_heavy))
    return light.unionByName(spread(lines.where(is_heavy), headers.where(is_heavy)))


def _bounds(transactions: DataFrame) -> DataFrame:
    """Per header id the smallest and the largest value of each checked field."""
    lo = [F.min(field).alias(field) for field in CHECKED]
    hi = [F.max(field).alias(f"_max_{field}") for field in CHECKED]
    return transactions.groupBy(HEADER_KEY).agg(*lo, *hi)


def header_check(transactions: DataFrame) -> DataFrame:
    """Per header id: number of different values of each checked field, nulls not counted.

    One scan. Rows that agree in id and a value become one within each task;
    values are then counted in two steps, by id and value and by id, so an id
    with very many values is spread over tasks as well.
    """
    counts = (F.count_distinct(F.col(field)).alias(name) for field, name in CHECKED.items())
    return transactions.groupBy(HEADER_KEY).agg(*counts)


def transactions_clean(transactions: DataFrame) -> DataFrame:
    """One row per header id whose checked fields each have exactly one value.

    "One value" is the same as "smallest equals largest", and a field that is
    NULL throughout fails both, so one aggregation does the check and the
    collapse.
    """
    one_value = reduce(lambda a, b: a & b, (F.col(f) == F.col(f"_max_{f}") for f in CHECKED))
    return (
        _bounds(transactions.where(F.col(HEADER_KEY).isNotNull()))
        .where(one_value)
        .select(HEADER_KEY, *CHECKED)
    )
