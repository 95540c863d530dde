"""Every operator as a query over a folder of the driver's Parquet tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapakdw.functions.columns import business_date, code
from lapakdw.operators import headers as h
from lapakdw.operators.ranges import surrogate_key
from lapakdw.operators.unknown import with_unknown
from lapakdw.plans import dims as d
from lapakdw.plans import dq, fact, load, metrics
from lapakdw.plans import profile as p
from lapakdw.plans.warehouse import MONTH, TABLES, YEAR, Warehouse
from lapakdw.runtime import materialize, new_scratch, shuffle_settings, sql_conf
from lapakdw.sources import standin
from lapakdw.sources.raw import HEADER_COLUMNS, Slice, read_raw, register_raw, slice_filter
from lapakdw.sources.standin import StandinViews

Query = Callable[[SparkSession, str], DataFrame]

# Bindings of the reports to the driver's tables.
FIRST_DAY = "1995-01-01"
SCOPE = metrics.Scope(outlets=("NATION_0", "NATION_1", "NATION_2"), year=1997)
HALF_YEAR = Slice("t2", "three outlets, six months", outlets=SCOPE.outlets, start="1997-01-01", end="1997-07-01")

_warehouses: dict[tuple, Warehouse] = {}


def load_into(spark: SparkSession, sf_dir: str, path: str) -> Warehouse:
    """Build the warehouse over a folder of driver tables."""
    return load.build_warehouse(standin.raw_sales(spark, sf_dir), path, calendar=None, first_day=FIRST_DAY)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse over a folder, built once per application and state of the folder."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    size, listing = files.getContentSummary(path), files.listFiles(path, True)
    newest = 0
    while listing.hasNext():
        newest = max(newest, listing.next().getModificationTime())
    key = (spark.sparkContext.applicationId, sf_dir, size.getLength(), size.getFileCount(), newest)
    if key not in _warehouses:
        _warehouses[key] = load_into(spark, sf_dir, new_scratch(spark, "warehouse"))
    return _warehouses[key]


def plain(df: DataFrame) -> DataFrame:
    """Money as double, for comparison across engines. Sums are exact decimals until here."""
    money = {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    return df.withColumns(money) if money else df


# Sources, sinks and load


def _export(df: DataFrame, path: str) -> None:
    """Write a raw table as CSV, its texts unchanged."""
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def q_read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "csv")
    _export(standin.transactions(spark, sf_dir), path)
    return read_raw(spark, path, HEADER_COLUMNS)


def q_register_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_scratch(spark, "csv")
    views = StandinViews(spark, sf_dir)
    for name in ("raw_transactions", "raw_transaction_items", "raw_products", "raw_outlets"):
        _export(views[name], f"{folder}/{name.removeprefix('raw_')}.csv")
    rows = [
        spark.table(view).select(F.lit(view).alias("view"), F.concat_ws("|", *_shown(spark.table(view))).alias("row"))
        for view in register_raw(spark, folder)
    ]
    return reduce(DataFrame.unionByName, rows)


def _shown(df: DataFrame) -> list[Column]:
    """Every column as text, a missing one as such."""
    return [F.coalesce(F.col(c), F.lit("NULL")) for c in df.columns]


def q_slice_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slice_filter(standin.transactions(spark, sf_dir), HALF_YEAR)


def q_write_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored, path = warehouse(spark, sf_dir).table(fact.FACT), new_scratch(spark, "full")
    with sql_conf(spark, shuffle_settings(spark, stored)):
        for _ in range(2):
            load.write_full(load.by_month(stored), path, (YEAR, MONTH))
    return spark.read.parquet(path).groupBy(YEAR, MONTH).agg(F.count("*").alias("rows"))


def q_write_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh, copy = warehouse(spark, sf_dir), Warehouse(spark, new_scratch(spark, "append"))

    def run() -> Warehouse:
        for name in TABLES:
            load.write_append(wh.table(name), copy.location(name))
        return copy

    return load.load_idempotency(run)


def q_load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.load_counts(warehouse(spark, sf_dir))


def q_load_idempotency(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch(spark, "twice")
    return load.load_idempotency(lambda: load_into(spark, sf_dir, path))


def q_warehouse_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load.warehouse_integrity(warehouse(spark, sf_dir))


# Dimensions


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar of all years that have a transaction."""
    return d.calendar(load.years_of(standin.transactions(spark, sf_dir)))


def q_dim_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(d.dim_product(standin.products(spark, sf_dir), FIRST_DAY))


def q_dim_outlet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return d.dim_outlet(standin.outlets(spark, sf_dir))


def q_dim_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status dictionary with the number of raw headers that carry each status."""
    used = fact.status_lookup(standin.transactions(spark, sf_dir), d.dim_status(spark))
    used = used.groupBy("status_sk").agg(F.count("*").alias("_rows"))
    counted = d.dim_status(spark).join(used, "status_sk", "left")
    return counted.withColumn("jumlah_header", F.coalesce("_rows", F.lit(0))).drop("_rows")


def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    stamped = standin.transactions(spark, sf_dir).select(h.HEADER_KEY, "tanggal_waktu", "status")
    return surrogate_key(stamped, [h.HEADER_KEY], "header_sk")


def q_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = {"nim": "-1", "nama": d.UNKNOWN_TEXT, "angkatan": None, "status": d.UNKNOWN_TEXT}
    return with_unknown(standin.mahasiswa(spark, sf_dir), unknown)


# Fact


def q_items_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.items_dedup(standin.transaction_items(spark, sf_dir))


def q_header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.header_check(standin.transactions(spark, sf_dir))


def q_transactions_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return h.transactions_clean(standin.transactions(spark, sf_dir))


def q_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(warehouse(spark, sf_dir).table(fact.FACT).drop(YEAR, MONTH))


def q_scd2_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price version of every line of a consistent header."""
    headers = h.transactions_clean(standin.transactions(spark, sf_dir)).select(
        h.HEADER_KEY, business_date(F.col("tanggal_waktu")).alias("tanggal")
    )
    lines = h.lines_of_headers(standin.transaction_items(spark, sf_dir), materialize(headers, "headers"))
    priced = fact.product_lookup(lines, warehouse(spark, sf_dir).dims.product, "tanggal")
    return priced.select(h.HEADER_KEY, "item_id", "product_id", "tanggal", "product_sk")


def q_status_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = standin.transactions(spark, sf_dir).select(h.HEADER_KEY, "status")
    return fact.status_lookup(raw, warehouse(spark, sf_dir).dims.status).withColumn(
        "status_code", code(F.col("status"))
    )


def q_grain_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    wh = warehouse(spark, sf_dir)
    return fact.grain_guard(wh.table(fact.FACT), wh.dims.status).agg(F.count("*").alias("violations"))


# Metrics


def _report(build: Callable) -> Query:
    return lambda spark, sf_dir: plain(build(warehouse(spark, sf_dir).star, SCOPE))


def q_daily_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(metrics.m01_daily_revenue(warehouse(spark, sf_dir).star))


def q_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.alert_entities_per_day(standin.fact_prakiraan_cuaca(spark, sf_dir))


# Profiling

PROFILE_QUERIES: dict[str, p.Totals | p.Listing | p.Count] = {
    "prof_rows_unique": p.PROFILES["t2"][0],
    "prof_dup_keys": p.PROFILES["t2"][1],
    "prof_blank_and_variants": p.Totals(
        "raw_transactions", {"customer_kosong": p.blanks("customer_id"), "varian_status": p.distinct("status")}
    ),
    "prof_null_key": p.Totals("raw_transactions", {"baris": p.rows, "customer_null": p.nulls("customer_id")}),
    "prof_blank_join_keys": p.FIRST_LOOK[1],
    "prof_dup_grain": p.FIRST_LOOK[2],
    "prof_date_format": p.PROFILES["t1"][5],
    "prof_out_of_range": p.PROFILES["t1"][6],
    "prof_utc_variants": p.PROFILES["t2"][2],
    "prof_utc_vs_local": p.FIRST_LOOK[5],
    "prof_header_without_item": p.PROFILES["t2"][3],
    "prof_negative_qty": p.PROFILES["t2"][4],
    "prof_fk_orphan": p.PROFILES["t2"][5],
    "prof_price_variants": p.PROFILES["t2"][6],
    "prof_value_range": p.FIRST_LOOK[3],
    "prof_domain_freq": p.FIRST_LOOK[4],
    "prof_rows_entities": p.PROFILES["t3"][0],
    "prof_blank_column": p.PROFILES["t3"][1],
    "prof_zero_share": p.PROFILES["t3"][2],
    "prof_code_desc_freq": p.PROFILES["t3"][3],
    "prof_text_min_and_batches": p.PROFILES["t3"][4],
    "prof_tz_offset": p.PROFILES["t3"][5],
    "prof_hierarchy": p.PROFILES["t3"][6],
}


def _profile(question: p.Totals | p.Listing | p.Count) -> Query:
    return lambda spark, sf_dir: question.frame(StandinViews(spark, sf_dir))


def q_run_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p.run_profiles(StandinViews(spark, sf_dir), {**p.PROFILES, "awal": p.FIRST_LOOK})


# Data-quality tests

# Query name -> name of the standard test.
DQ_QUERIES = {
    "dq_nim_duplikat": "nim_duplikat",
    "dq_presensi_duplikat_grain": "presensi_duplikat_grain",
    "dq_tanggal_format_lain": "tanggal_presensi_format_lain",
    "dq_nilai_di_luar_rentang": "nilai_di_luar_rentang",
    "dq_status_di_luar_domain": "status_presensi_di_luar_domain",
    "dq_angkatan_kosong": "mahasiswa_angkatan_kosong",
    "dq_transaction_id_duplikat": "transaction_id_duplikat",
    "dq_item_fk_orphan": "item_fk_orphan",
    "dq_timestamp_utc_tanpa_zona": "timestamp_utc_tanpa_zona",
    "dq_transaksi_tanpa_item": "transaksi_tanpa_item",
    "dq_qty_negatif_bukan_refund": "qty_negatif_bukan_refund",
    "dq_harga_tidak_positif": "harga_satuan_tidak_positif",
    "dq_duplikat_grain_desa_slot": "duplikat_grain_desa_slot",
    "dq_curah_hujan_negatif": "curah_hujan_negatif",
    "dq_kolom_kosong": "kolom_vs_kosong_seluruhnya",
    "dq_desc_multi_code": "deskripsi_cuaca_dipakai_lebih_dari_satu_kode",
    "dq_nilai_nol": "curah_hujan_nol_tidak_wajar",
    "dq_time_index_sebagai_jam": "time_index_sebagai_jam",
}


def _dq(spec: dq.DqSpec) -> Query:
    return lambda spark, sf_dir: dq.check(spark, StandinViews(spark, sf_dir), spec)


def q_run_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.run_dq(spark, StandinViews(spark, sf_dir)).drop("note")


def queries() -> dict[str, Query]:
    specs = {spec.name: spec for spec in dq.SPECS}
    return {
        "read_raw": q_read_raw,
        "register_raw": q_register_raw,
        "slice_filter": q_slice_filter,
        "write_full": q_write_full,
        "write_append": q_write_append,
        "load_counts": q_load_counts,
        "load_idempotency": q_load_idempotency,
        "warehouse_integrity": q_warehouse_integrity,
        "dim_date": q_dim_date,
        "dim_product_scd2": q_dim_product,
        "dim_outlet_scd1": q_dim_outlet,
        "dim_status_scd0": q_dim_status,
        "surrogate_key": q_surrogate_key,
        "with_unknown": q_with_unknown,
        "items_dedup": q_items_dedup,
        "header_check": q_header_check,
        "transactions_clean": q_transactions_clean,
        "fact_transaksi_item": q_fact,
        "scd2_lookup": q_scd2_lookup,
        "status_lookup": q_status_lookup,
        "fact_grain_guard": q_grain_guard,
        "q01_basket": _report(metrics.q01_basket),
        "q02_mom_rank": _report(metrics.q02_mom_rank),
        "q03_return_rate": _report(metrics.q03_return_rate),
        "m01_daily_revenue": q_daily_revenue,
        "m02_mom_growth": _report(metrics.m02_mom_growth),
        "m03_return_ratio": _report(metrics.m03_return_ratio),
        "monthly_net_revenue": _report(metrics.monthly_net_revenue),
        "alert_entities_per_day": q_alerts,
        "run_profile": q_run_profile,
        **{name: _profile(question) for name, question in PROFILE_QUERIES.items()},
        "run_dq": q_run_dq,
        **{name: _dq(specs[test]) for name, test in DQ_QUERIES.items()},
    }
