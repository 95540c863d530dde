"""Small raw tables and plan text for the tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lapakdw.sources.raw import HEADER_COLUMNS, ITEM_COLUMNS, OUTLET_COLUMNS, PRODUCT_COLUMNS, RawSales


def texts(spark: SparkSession, columns: list[str], rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def headers(spark, *rows):
    return texts(spark, HEADER_COLUMNS, list(rows))


def items(spark, *rows):
    return texts(spark, ITEM_COLUMNS, list(rows))


def products(spark, *rows):
    return texts(spark, PRODUCT_COLUMNS, list(rows))


def outlets(spark, *rows):
    return texts(spark, OUTLET_COLUMNS, list(rows))


def small_shop(spark) -> RawSales:
    """Two outlets, three products, and one of every kind of dirt."""
    return RawSales(
        transactions=headers(
            spark,
            ("T1", "OUT-A", "C1", "2025-01-10 09:00:00", "PAID", "20000"),
            ("T2", "OUT-A", None, "2025-02-10T09:00:00", " paid ", "10000"),
            ("T2", "OUT-A", None, "2025-02-10T09:00:00", " paid ", "10000"),  # identical copy
            ("T3", "OUT-B", "C2", "2025-01-31T20:00:00Z", "VOID", "5000"),  # status not in the dictionary
            ("T4", "OUT-B", "C2", "2025-03-01 10:00:00", "PAID", "7000"),  # conflicting copy below
            ("T4", "OUT-B", "C2", "2025-03-01 10:00:00", "CANCELLED", "7000"),
            ("T5", None, "C3", "2025-03-02 10:00:00", "PAID", "7000"),  # outlet missing throughout
            ("T6", "OUT-B", "C3", "2025-03-03 10:00:00", "PAID", "8000"),  # outlet missing once
            ("T6", None, "C3", "2025-03-03 10:00:00", "PAID", "8000"),
            ("T7", "OUT-X", "C3", "2031-01-01 10:00:00", "REFUNDED", "9000"),  # unknown outlet and day
            ("T8", "OUT-A", "C3", "2025-03-04 10:00:00", "PAID", "1000"),  # no items
        ),
        items=items(
            spark,
            ("T1", "1", "P1", "2", "10000", "0"),
            ("T1", "1", "P1", "2", "10000", "0"),  # identical copy
            ("T1", "1", "P1", "3", "10000", "0"),  # same natural key, other content
            ("T2", "1", "P1", "1", "10000.50", "500.25"),
            ("T2", "2", "P2", "-1", "4000", "0"),  # return
            ("T3", "1", "P2", "1", "5000", "0"),
            ("T4", "1", "P1", "1", "7000", "0"),
            ("T5", "1", "P1", "1", "7000", "0"),
            ("T6", "1", "P-none", "1", "8000", "0"),  # no such product
            ("T7", "1", "P1", "1", "9000", "0"),
            ("T9", "1", "P1", "1", "1", "0"),  # no header
            (None, "1", "P1", "1", "1", "0"),
        ),
        products=products(
            spark,
            ("P1", "Teh", "Minuman", "10000", "2025-01-01", "ya"),
            ("P1", "Teh", "Minuman", "11000", "2025-02-01", " YA "),
            ("P2", "Kue", "Snack", "4000", "2025-02-05", "tidak"),
            ("P3", "Kopi", "Minuman", "6000", None, None),
        ),
        outlets=outlets(
            spark,
            ("OUT-B", "Dua", "Bandung", "outlet", "tidak", "2023-11-01"),
            ("OUT-A", "Satu", "Bandung", "outlet", "Ya ", "2023-03-01"),
        ),
    )


def plan(df: DataFrame) -> str:
    """The physical plan as planned before any stage has run."""
    return df._jdf.queryExecution().executedPlan().toString()
