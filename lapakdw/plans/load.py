"""Loading the warehouse: full rebuild, append, row counts and the idempotency report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapakdw.functions.columns import business_date
from lapakdw.operators.ranges import RANGE_ROWS
from lapakdw.plans import dims as d
from lapakdw.plans.fact import FACT, fact_transaksi_item
from lapakdw.plans.warehouse import (
    DIM_DATE,
    DIM_OUTLET,
    DIM_PRODUCT,
    DIM_STATUS,
    MONTH,
    TABLES,
    YEAR,
    Warehouse,
    partition_columns,
)
from lapakdw.runtime import MAX_PARTITIONS, literal_rows, shuffle_settings, sql_conf
from lapakdw.sources.raw import RawSales, Slice, slice_sales


class QualityGateError(RuntimeError):
    """A blocking data-quality test did not come out as expected."""


def write_full(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replace the table at ``path``; running it again gives the same rows."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_append(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Add the rows to the table at ``path``; running it again doubles them."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def by_month(fact: DataFrame) -> DataFrame:
    """The fact with its partition columns, laid out for writing.

    Rebalancing puts each month into as few evenly filled files as its size
    needs: small months share a task, a month that holds much of the table is
    split over many. Inside a file the lines are sorted by outlet, so a report
    on a few outlets skips the pages of the others.
    """
    fact = fact.withColumns(partition_columns(F.col("date_sk")))
    laid_out = fact.hint("rebalance", F.col(YEAR), F.col(MONTH))
    return laid_out.sortWithinPartitions(YEAR, MONTH, "outlet_sk", "date_sk")


Writer = Callable[..., None]


def build_warehouse(
    raw: RawSales,
    path: str,
    *,
    calendar: tuple[str | dt.date, str | dt.date] | None = d.CALENDAR,
    first_day: str = d.FIRST_PRICE_DAY,
    local_tz: str | None = None,
    part: str | Slice | None = None,
    gate: DataFrame | None = None,
    write: Writer = write_full,
    range_rows: int = RANGE_ROWS,
    max_partitions: int = MAX_PARTITIONS,
    overlap: str = "keep",
    keep: int = 2,
) -> Warehouse:
    """Build and store all tables in dependency order.

    ``calendar`` is the first and last day of the date dimension; lines of other
    days get the Unknown day. None takes all years that have a transaction.
    ``part`` restricts the raw tables to a slice. ``local_tz`` moves 'Z' times to
    a zone before the date is taken. ``gate`` is a data-quality report; the load
    stops before the first write if one of its blocking tests is off.
    ``write`` is ``write_full`` or ``write_append``. Either way the load goes to a
    folder of its own and counts as a whole, by one commit, when all tables are
    written; if it fails, the warehouse is what it was. The newest ``keep``
    commits stay readable, older ones are removed. ``max_partitions`` bounds the shuffle partitions of each table's build. ``overlap`` says what
    overlapping price versions do: repeat a line for each, or stop the load.
    """
    if gate is not None:
        off = [row["name"] for row in gate.where("gate").select("name").collect()]
        if off:
            raise QualityGateError(f"blocking tests not as expected: {', '.join(sorted(off))}")
    if part is not None:
        raw = slice_sales(raw, part)
    spark = raw.items.sparkSession
    wh = Warehouse(spark, path).begin(whole=write is not write_append)

    def sized(*frames: DataFrame):
        return sql_conf(spark, shuffle_settings(spark, *frames, max_partitions=max_partitions))

    def store(df: DataFrame, name: str, *partition_by: str) -> None:
        write(df, wh.location(name), partition_by)
        wh.add(name)

    try:
        dates = d.dim_date(spark, *calendar) if calendar else d.calendar(years_of(raw.transactions, local_tz))
        store(dates.coalesce(1), DIM_DATE)
        with sized(raw.products):
            store(d.dim_product(raw.products, first_day, range_rows), DIM_PRODUCT)
        with sized(raw.outlets):
            store(d.dim_outlet(raw.outlets, range_rows), DIM_OUTLET)
        store(d.dim_status(spark), DIM_STATUS)
        with sized(raw.items, raw.transactions):
            store(by_month(fact_transaksi_item(raw, wh.dims, local_tz, overlap)), FACT, YEAR, MONTH)
        wh.finish()
    except BaseException:
        wh.abandon()
        raise
    wh.vacuum(keep)
    return Warehouse(spark, path)


def years_of(transactions: DataFrame, local_tz: str | None = None) -> DataFrame:
    """First day of the first and last day of the last year that has a transaction: one row, columns a and b."""
    day = business_date(F.col("tanggal_waktu"), local_tz)
    return transactions.agg(F.min(day).alias("a"), F.max(day).alias("b")).select(
        F.trunc("a", "year").alias("a"), F.date_sub(F.add_months(F.trunc("b", "year"), 12), 1).alias("b")
    )


def load_counts(wh: Warehouse, tables: Iterable[str] = TABLES) -> DataFrame:
    """Rows per table. Parquet answers this from its footers."""
    counts = [wh.table(t).agg(F.count("*").alias("rows")).select(F.lit(t).alias("table"), "rows") for t in tables]
    return reduce(DataFrame.unionByName, counts)


def compare_counts(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two row-count reports side by side; ``idempotent`` where they agree."""
    both = first.select("table", F.col("rows").alias("run_1")).join(
        second.select("table", F.col("rows").alias("run_2")), "table", "full"
    )
    return both.withColumn("idempotent", F.col("run_1").eqNullSafe(F.col("run_2")))


def load_idempotency(run: Callable[[], Warehouse]) -> DataFrame:
    """Load twice and compare the row counts. The first counts are fixed before the second run."""
    reports = []
    for _ in range(2):
        wh = run()
        counted = [tuple(row) for row in load_counts(wh).collect()]
        reports.append(literal_rows(wh.spark, {"table": "string", "rows": "bigint"}, counted))
    return compare_counts(*reports)


def warehouse_integrity(stored: Warehouse | DataFrame) -> DataFrame:
    """Rows of the fact, rows without a date key, and three verdicts: the fact exists, has rows, and all have a date.

    Takes a warehouse, whose fact may be missing, or the fact itself.
    """
    if isinstance(stored, Warehouse):
        if not stored.has(FACT):
            schema = {"rows": "bigint", "without_date": "bigint", "has_rows": "boolean", "all_dated": "boolean", "fact_exists": "boolean"}
            return literal_rows(stored.spark, schema, [(None, None, False, False, False)])
        stored = stored.table(FACT)
    counted = stored.agg(F.count("*").alias("rows"), F.count_if(F.col("date_sk").isNull()).alias("without_date"))
    return counted.select(
        "rows",
        "without_date",
        (F.col("rows") > 0).alias("has_rows"),
        (F.col("without_date") == 0).alias("all_dated"),
        F.lit(True).alias("fact_exists"),
    )
