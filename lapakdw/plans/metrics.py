"""Analytic queries and metrics over the star schema.

The fact is read for the columns and months a query needs, days are computed
from their keys, dimensions that are small are broadcast, and the groups are summed within each task
before they are shuffled, so a large outlet or month costs one row per task.
``total_bayar_trx`` repeats on every line of a header and is never summed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapakdw.functions.columns import percent, ratio, round_half
from lapakdw.plans.dims import calendar_span, day_of
from lapakdw.plans.warehouse import YEAR, Star
from lapakdw.runtime import broadcast_if_small


@dataclass(frozen=True)
class Scope:
    """Outlets and calendar year a report covers."""

    # The standard report covers these outlets and this year.
    outlets: tuple[str, ...] = ("OUT-A", "OUT-B", "OUT-C")
    year: int = 2025


STANDARD = Scope()

RETURNED = "qty < 0"


def sales(star: Star, scope: Scope | None = None, status: Column | None = None) -> DataFrame:
    """Fact lines with their day and outlet, and with the status where a condition is set on it.

    Day and outlet decide which lines count. The filter on the partition year
    repeats part of that, where files can be skipped.
    """
    fact, outlets = star.dated(), star.outlet
    if scope is not None:
        fact = fact.where(F.col("tahun") == scope.year)
        outlets = outlets.where(F.col("outlet_id").isin(*scope.outlets))
        if YEAR in fact.columns:
            fact = fact.where(F.col(YEAR) == scope.year)
    if status is not None:
        fact = fact.join(star.status.where(status).select("status_sk"), "status_sk")
    return fact.join(outlets.select("outlet_sk", "outlet_id"), "outlet_sk")


def is_paid() -> Column:
    return F.col("status_code") == "PAID"


def is_final() -> Column:
    return F.col("kategori_final") == "selesai"


def q01_basket(star: Star, scope: Scope = STANDARD) -> DataFrame:
    """Basket size: lines and value per paid transaction, weekdays against weekends, returns left out."""
    day_kind = F.when(F.col("akhir_pekan"), "akhir_pekan").otherwise("hari_kerja")
    baskets = (
        sales(star, scope, is_paid())
        .where("qty > 0")
        .groupBy(F.col("outlet_id").alias("outlet"), day_kind.alias("jenis_hari"))
        .agg(
            F.count_distinct(F.col("transaction_id")).alias("jumlah_transaksi"),
            F.count("*").alias("_lines"),
            F.sum("subtotal_rupiah").alias("_value"),
        )
    )
    trx = F.col("jumlah_transaksi")
    return baskets.select(
        "outlet",
        "jenis_hari",
        "jumlah_transaksi",
        round_half(ratio(F.col("_lines"), trx), 2).alias("item_per_transaksi"),
        round_half(ratio(F.col("_value"), trx), 0).alias("nilai_per_transaksi"),
    ).orderBy("outlet", "jenis_hari")


def _monthly(star: Star, scope: Scope, status: Column) -> DataFrame:
    return (
        sales(star, scope, status)
        .groupBy("outlet_id", "tahun", "bulan")
        .agg(F.sum("subtotal_rupiah").alias("omzet_bersih"))
    )


def _with_growth(monthly: DataFrame) -> DataFrame:
    """Add the month before and the change in percent. A window holds the months of one outlet."""
    in_time = Window.partitionBy("outlet_id").orderBy("tahun", "bulan")
    last, now = F.col("omzet_bulan_lalu"), F.col("omzet_bersih")
    return monthly.withColumn("omzet_bulan_lalu", F.lag("omzet_bersih").over(in_time)).withColumn(
        "pertumbuhan_mom_pct", round_half(percent(now - last, last), 1)
    )


def q02_mom_rank(star: Star, scope: Scope = STANDARD) -> DataFrame:
    """Monthly net revenue per outlet, its growth on the month before, and the month's rank."""
    by_size = Window.partitionBy("outlet_id").orderBy(F.col("omzet_bersih").desc_nulls_last())
    ranked = _with_growth(_monthly(star, scope, is_paid())).withColumn("peringkat_bulan", F.rank().over(by_size))
    return ranked.select(
        F.col("outlet_id").alias("outlet"),
        "tahun",
        "bulan",
        "omzet_bersih",
        "omzet_bulan_lalu",
        "pertumbuhan_mom_pct",
        "peringkat_bulan",
    ).orderBy("outlet", "tahun", "bulan")


def m02_mom_growth(star: Star, scope: Scope = STANDARD) -> DataFrame:
    """Monthly net revenue of final sales and its growth; the first month has none."""
    return (
        _with_growth(_monthly(star, scope, is_final()))
        .select("outlet_id", "tahun", "bulan", "omzet_bersih", "omzet_bulan_lalu", "pertumbuhan_mom_pct")
        .orderBy("outlet_id", "tahun", "bulan")
    )


def _returns(star: Star, scope: Scope) -> DataFrame:
    """Lines and returned lines per outlet and quarter, whatever the status of the header."""
    back = F.expr(RETURNED)
    value = F.coalesce(F.sum(F.when(back, F.col("subtotal_rupiah"))), F.lit(0).cast("decimal(28,2)"))
    return (
        sales(star, scope)
        .groupBy("outlet_id", "triwulan")
        .agg(
            F.count("*").alias("lines"),
            F.count_if(back).alias("returned"),
            (-F.abs(value)).alias("value"),
        )
        .withColumn("share", round_half(percent(F.col("returned"), F.col("lines")), 2))
        .orderBy("outlet_id", "triwulan")
    )


def q03_return_rate(star: Star, scope: Scope = STANDARD) -> DataFrame:
    """Return rate per outlet and quarter."""
    return _returns(star, scope).select(
        F.col("outlet_id").alias("outlet"),
        "triwulan",
        F.col("lines").alias("baris_item"),
        F.col("returned").alias("baris_retur"),
        F.col("share").alias("pct_baris_retur"),
        F.col("value").alias("nilai_retur_rp"),
    )


def m03_return_ratio(star: Star, scope: Scope = STANDARD) -> DataFrame:
    """The return rate under its metric names."""
    return _returns(star, scope).select(
        "outlet_id",
        "triwulan",
        F.col("lines").alias("total_baris_item"),
        F.col("returned").alias("baris_retur"),
        F.col("share").alias("rasio_retur_pct"),
        F.col("value").alias("nilai_retur_rupiah"),
    )


def m01_daily_revenue(star: Star, scope: Scope | None = None) -> DataFrame:
    """Net revenue of final sales per day and outlet; days without sales have no row."""
    return (
        sales(star, scope, is_final())
        .groupBy(F.col("full_date").alias("tanggal"), "outlet_id")
        .agg(F.sum("subtotal_rupiah").alias("omzet_rupiah"))
        .orderBy("tanggal", "outlet_id")
    )


def monthly_net_revenue(star: Star, scope: Scope = STANDARD) -> DataFrame:
    """Net revenue per outlet and month in whole rupiah, with the counts to audit it by."""
    return (
        sales(star, scope, is_paid())
        .groupBy(F.col("outlet_id").alias("outlet"), "tahun", "bulan")
        .agg(
            F.round(F.sum("subtotal_rupiah"), 0).cast("bigint").alias("omzet_bersih_rp"),
            F.count_distinct(F.col("transaction_id")).alias("jumlah_transaksi"),
            F.count("*").alias("jumlah_baris_item"),
            F.count_if(F.expr(RETURNED)).alias("jumlah_baris_retur"),
        )
        .orderBy("outlet", "tahun", "bulan")
    )


def alert_entities_per_day(fact: DataFrame, dates: DataFrame | None = None) -> DataFrame:
    """Number of different places on alert per day.

    With a calendar, only its days count; without one, every key that names a
    day, and the Unknown day. The day is computed from the key.
    """
    alerts = fact.where(F.col("is_siaga") == 1)
    span = None if dates is None else calendar_span(dates)
    if dates is not None and span is None:
        alerts = alerts.join(broadcast_if_small(dates.select("date_sk", "full_date")), "date_sk")
    else:
        held = F.lit(True) if span is None else span.holds(F.col("date_sk"))
        alerts = alerts.where(held).withColumn("full_date", day_of(F.col("date_sk"))).where("full_date IS NOT NULL")
    return (
        alerts.groupBy(F.col("full_date").alias("tanggal"))
        .agg(F.count_distinct(F.col("wilayah_sk")).alias("desa_siaga"))
        .orderBy("tanggal")
    )
