"""The four dimensions."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapakdw.functions.columns import to_money, yes
from lapakdw.operators.ranges import RANGE_ROWS, surrogate_key
from lapakdw.operators.scd import OPEN_END, scd2_versions
from lapakdw.operators.unknown import UNKNOWN_SK, with_unknown
from lapakdw.runtime import literal_rows

# The calendar, the first day used for a missing price start, and
# the texts of the Unknown members.
CALENDAR = ("2024-01-01", "2027-12-31")
FIRST_PRICE_DAY = "2024-01-01"
UNKNOWN_DAY = "1900-01-01"
UNKNOWN_TEXT = "TIDAK DIKETAHUI"
UNKNOWN_PRODUCT = "PRD-UNKNOWN"
UNKNOWN_OUTLET = "OUT-UNKNOWN"
UNKNOWN_STATUS = "UNKNOWN"
UNKNOWN_CATEGORY = "tidak diketahui"

# The status dictionary
# (code, label, final category, counts as revenue).
STATUSES = [
    ("PAID", "Lunas / Dibayar", "selesai", True),
    ("PENDING", "Menunggu Pembayaran", "proses", False),
    ("CANCELLED", "Dibatalkan", "batal", False),
    ("REFUNDED", "Dikembalikan / Retur", "batal", False),
    ("PARTIAL", "Pembayaran Sebagian", "proses", False),
]


def dim_date(spark: SparkSession, start: str | dt.date = CALENDAR[0], end: str | dt.date = CALENDAR[1]) -> DataFrame:
    """One row per day, both ends included, and the Unknown day."""
    bounds = spark.range(0, 1, 1, 1).select(F.lit(start).cast("date").alias("a"), F.lit(end).cast("date").alias("b"))
    return calendar(bounds)


def calendar(bounds: DataFrame) -> DataFrame:
    """The date dimension over the first and last day in the one-row frame ``bounds`` (columns a, b)."""
    days = bounds.select(F.explode(F.sequence("a", "b")).alias("d"))
    d = F.col("d")
    weekday = F.dayofweek(d) - 1
    dim = days.select(
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_sk"),
        d.alias("full_date"),
        F.year(d).alias("tahun"),
        F.quarter(d).alias("triwulan"),
        F.month(d).alias("bulan"),
        F.date_format(d, "MMMM").alias("nama_bulan"),
        F.weekofyear(d).alias("pekan_iso"),
        F.dayofmonth(d).alias("hari"),
        weekday.alias("hari_ke"),
        F.date_format(d, "EEEE").alias("nama_hari"),
        weekday.isin(0, 6).alias("akhir_pekan"),
    )
    return with_unknown(
        dim,
        {
            "date_sk": UNKNOWN_SK,
            "full_date": UNKNOWN_DAY,
            "tahun": 1900,
            "triwulan": 0,
            "bulan": 0,
            "nama_bulan": UNKNOWN_TEXT,
            "pekan_iso": 0,
            "hari": 0,
            "hari_ke": -1,
            "nama_hari": UNKNOWN_TEXT,
            "akhir_pekan": False,
        },
    )


def day_of(date_sk: Column) -> Column:
    """The day of a date key, that of the Unknown day for -1, NULL for a key that names no day."""
    year, month, day = (F.floor(date_sk / 10000), F.floor(date_sk / 100) % 100, date_sk % 100)
    year, month, day = (part.cast("int") for part in (year, month, day))
    known = F.when(
        month.between(1, 12) & day.between(1, 31) & (day <= F.dayofmonth(F.last_day(F.make_date(year, month, F.lit(1))))),
        F.make_date(year, month, day),
    )
    return F.when(date_sk == UNKNOWN_SK, F.lit(UNKNOWN_DAY).cast("date")).when(date_sk > 0, known)


def day_columns(date_sk: Column) -> dict[str, Column]:
    """What the calendar says of a date key, computed from the key."""
    known, day = date_sk != UNKNOWN_SK, day_of(date_sk)
    month = (F.floor(date_sk / 100) % 100).cast("int")
    return {
        "full_date": day,
        "tahun": F.when(known, F.floor(date_sk / 10000)).otherwise(1900).cast("int"),
        "triwulan": F.when(known, F.floor((month + 2) / 3)).otherwise(0).cast("int"),
        "bulan": F.when(known, month).otherwise(0),
        "akhir_pekan": known & F.dayofweek(day).isin(1, 7),
    }


@dataclass(frozen=True)
class Span:
    """First and last key of a calendar that has every day between them, once.

    Such a calendar need not be joined, whatever its size: the key of a day and
    all columns of a key are computed, and the span says which days it has.
    """

    first: int
    last: int

    def key(self, day: Column) -> Column:
        """The key of a day; -1 where there is none."""
        key = F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)
        return F.when(key.between(self.first, self.last), key).otherwise(UNKNOWN_SK)

    def holds(self, date_sk: Column) -> Column:
        """Whether the calendar has a row for the key."""
        known = date_sk.between(self.first, self.last) & day_of(date_sk).isNotNull()
        return (date_sk == UNKNOWN_SK) | known


def calendar_span(dates: DataFrame) -> Span | None:
    """The span of a calendar; None if it lacks days or has some more than once. One small job."""
    known = F.col("date_sk") != UNKNOWN_SK
    days = F.when(known, F.col("full_date"))
    first, last, rows, different, length, unknown = dates.agg(
        F.min(F.when(known, F.col("date_sk"))),
        F.max(F.when(known, F.col("date_sk"))),
        F.count(days),
        F.count_distinct(days),
        F.datediff(F.max(days), F.min(days)) + 1,
        F.count_if(~known),
    ).first()
    whole = rows > 0 and rows == different == length and unknown == 1
    return Span(first, last) if whole else None


def dim_product(
    products: DataFrame, first_day: str = FIRST_PRICE_DAY, range_rows: int = RANGE_ROWS
) -> DataFrame:
    """Price history (type 2) with the Unknown product."""
    versions = scd2_versions(products, "product_id", "harga_berlaku_dari", "product_sk", first_day, range_rows)
    dim = versions.select(
        "product_sk",
        "product_id",
        "nama_produk",
        "kategori",
        to_money(F.col("harga_satuan")).alias("harga_satuan"),
        "valid_from",
        "valid_to",
        "is_current",
        yes(F.col("aktif")).alias("is_aktif"),
    )
    return with_unknown(
        dim,
        {
            "product_sk": UNKNOWN_SK,
            "product_id": UNKNOWN_PRODUCT,
            "nama_produk": UNKNOWN_TEXT,
            "kategori": UNKNOWN_TEXT,
            "harga_satuan": 0,
            "valid_from": UNKNOWN_DAY,
            "valid_to": OPEN_END,
            "is_current": True,
            "is_aktif": False,
        },
    )


def dim_outlet(outlets: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Outlet master (type 1: the newest load replaces the last) with the Unknown outlet."""
    dim = surrogate_key(outlets, ["outlet_id"], "outlet_sk", range_rows).select(
        "outlet_sk",
        "outlet_id",
        "nama_outlet",
        "kota",
        "tipe",
        yes(F.col("aktif")).alias("is_aktif"),
        F.col("dibuka_sejak").cast("date").alias("dibuka_sejak"),
    )
    return with_unknown(
        dim,
        {
            "outlet_sk": UNKNOWN_SK,
            "outlet_id": UNKNOWN_OUTLET,
            "nama_outlet": UNKNOWN_TEXT,
            "kota": UNKNOWN_TEXT,
            "tipe": UNKNOWN_TEXT,
            "is_aktif": False,
            "dibuka_sejak": UNKNOWN_DAY,
        },
    )


def dim_status(spark: SparkSession) -> DataFrame:
    """Status dictionary (type 0) with the Unknown status: six rows, keys in code order."""
    rows = [(sk, *row) for sk, row in enumerate(sorted(STATUSES), start=1)]
    rows.append((UNKNOWN_SK, UNKNOWN_STATUS, UNKNOWN_TEXT, UNKNOWN_CATEGORY, False))
    return literal_rows(
        spark,
        {
            "status_sk": "bigint",
            "status_code": "string",
            "label_indonesia": "string",
            "kategori_final": "string",
            "berdampak_pendapatan": "boolean",
        },
        rows,
    )
