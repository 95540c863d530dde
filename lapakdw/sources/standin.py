"""Raw text tables derived from the driver's Parquet tables.

They carry the dirt of real extracts: repeated and conflicting headers, headers
without items, unknown products, negative quantities, padded codes, 'Z' times,
several price versions and mixed date formats.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapakdw.runtime import broadcast_if_small
from lapakdw.sources.raw import RawSales


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _money_text(col):
    return col.cast("decimal(15,2)").cast("string")


def _hour_text(col):
    return F.concat(F.substring(col.cast("string"), 1, 13), F.lit(":00:00"))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    # Two numbers a customer: broadcast up to the measured limit, so that orders need no shuffle.
    customers = broadcast_if_small(_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    key = F.col("o_orderkey")
    late = (F.col("o_orderdate") + F.expr("INTERVAL '20' HOUR")).cast("string")
    open_status = F.when(key % 5 == 0, "VOID").otherwise("PENDING")
    paid_status = F.when(key % 3 == 0, " paid ").otherwise("PAID")
    status = (
        F.when(F.col("o_orderstatus") == "F", paid_status)
        .when(F.col("o_orderstatus") == "O", open_status)
        .otherwise("PARTIAL")
    )
    # Copies of a header come from one pass over the joined rows: the header itself,
    # an identical copy for some keys, and a conflicting copy for others.
    none = F.array().cast("array<string>")
    statuses = F.concat(
        F.array(status),
        F.when(key % 71 == 0, F.array(status)).otherwise(none),
        F.when(key % 97 == 0, F.array(F.lit("CANCELLED"))).otherwise(none),
    )
    return orders.join(customers, F.col("c_custkey") == F.col("o_custkey")).select(
        key.cast("string").alias("transaction_id"),
        F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("outlet_id"),
        F.when(key % 4 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(key % 7 == 0, F.concat(F.replace(late, F.lit(" "), F.lit("T")), F.lit("Z")))
        .otherwise(F.col("o_orderdate").cast("string"))
        .alias("tanggal_waktu"),
        F.explode(statuses).alias("status"),
        _money_text(F.col("o_totalprice")).alias("total_bayar"),
    )


def transaction_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = _table(spark, sf_dir, "lineitem")
    returned = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1)
    discount = F.col("l_extendedprice").cast("decimal(15,2)") * F.col("l_discount").cast("decimal(15,2)")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") + F.lit(0.000001))
    return line.select(
        F.col("l_orderkey").cast("string").alias("transaction_id"),
        F.col("l_linenumber").cast("string").alias("item_id"),
        F.when(F.col("l_orderkey") % 503 == 0, "PRD-X")
        .otherwise(F.concat(F.lit("PRD-"), F.col("l_partkey").cast("string")))
        .alias("product_id"),
        (F.when(returned, -1).otherwise(1) * F.col("l_quantity").cast("int")).cast("string").alias("qty"),
        price.cast("int").cast("string").alias("harga_satuan"),
        _money_text(discount).alias("diskon"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    price = F.col("p_retailprice").cast("decimal(15,2)")
    first = F.struct(
        price.cast("string").alias("harga_satuan"),
        F.when(key % 10 == 9, "1996-06-01").otherwise("1995-01-01").alias("harga_berlaku_dari"),
        F.when(key % 8 == 0, " Tidak").otherwise("YA ").alias("aktif"),
    )
    second = F.struct(
        _money_text(price + 50).alias("harga_satuan"),
        F.lit("1998-01-01").alias("harga_berlaku_dari"),
        F.lit("ya").alias("aktif"),
    )
    # Some products also have a price without a start, beside one or two that have one.
    undated = F.struct(
        _money_text(price + 75).alias("harga_satuan"),
        F.lit(None).cast("string").alias("harga_berlaku_dari"),
        F.lit("ya").alias("aktif"),
    )
    versions = F.filter(
        F.array(first, F.when(key % 4 == 0, second), F.when((key % 50).isin(7, 8), undated)),
        lambda v: v.isNotNull(),
    )
    return (
        _table(spark, sf_dir, "part")
        .select(
            F.concat(F.lit("PRD-"), key.cast("string")).alias("product_id"),
            F.col("p_name").alias("nama_produk"),
            F.col("p_type").alias("kategori"),
            F.explode(versions).alias("v"),
        )
        .select("product_id", "nama_produk", "kategori", "v.harga_satuan", "v.harga_berlaku_dari", "v.aktif")
    )


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _table(spark, sf_dir, "nation"), _table(spark, sf_dir, "region")
    return nation.join(region, F.col("r_regionkey") == F.col("n_regionkey"))


def outlets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select(
        F.col("n_name").alias("outlet_id"),
        F.col("n_name").alias("nama_outlet"),
        F.col("r_name").alias("kota"),
        F.lit("outlet").alias("tipe"),
        F.when(F.col("n_nationkey") == 24, "tidak").otherwise("ya").alias("aktif"),
        F.lit("1995-01-01").alias("dibuka_sejak"),
    )


def mahasiswa(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    cohort = F.when(key % 3 == 0, "2024").when(key % 3 == 1, "2023").otherwise("2022")
    return _table(spark, sf_dir, "customer").select(
        key.cast("string").alias("nim"),
        F.col("c_name").alias("nama"),
        F.when(key % 43 != 0, cohort).alias("angkatan"),
        F.when(key % 2 == 0, F.col("c_mktsegment")).otherwise(F.lower("c_mktsegment")).alias("status"),
    )


def presensi(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.substring(F.col("ts").cast("string"), 1, 10)
    slashed = F.concat_ws("/", F.substring(day, 9, 2), F.substring(day, 6, 2), F.substring(day, 1, 4))
    kind = F.col("event_type")
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("nim"),
        kind.alias("kode_mk"),
        F.when(F.col("event_id") % 20 == 0, slashed).otherwise(day).alias("tanggal"),
        F.when(kind == "view", "Hadir ")
        .when(kind == "click", "h")
        .when(kind == "signup", "IZIN")
        .when(kind == "error", "sakit")
        .otherwise("telat")
        .alias("status"),
    )


def nilai(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("nim"),
        F.col("event_type").alias("kode_mk"),
        F.when(F.col("event_id") % 501 == 0, "-5")
        .when(F.col("event_id") % 503 == 0, "abc")
        .otherwise(F.floor("value").cast("int").cast("string"))
        .alias("nilai_angka"),
    )


def prakiraan_cuaca(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, seq = F.col("event_type"), F.col("event_id")
    offset = F.when(F.col("user_id") % 5 == 0, F.expr("INTERVAL '8' HOUR")).otherwise(F.expr("INTERVAL '7' HOUR"))
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("adm4"),
        _hour_text(F.col("ts")).alias("local_datetime"),
        _hour_text(F.col("ts") - offset).alias("utc_datetime"),
        F.when(F.col("value") < 20, "0")
        .when(seq % 997 == 0, "-1")
        .otherwise(F.floor("value").cast("int").cast("string"))
        .alias("tp"),
        F.when(seq % 2 == 0, "").alias("vs"),
        F.when(kind == "view", "0")
        .when(kind == "click", "1")
        .when(kind == "signup", "2")
        .when(kind == "error", "61")
        .otherwise("3")
        .alias("weather"),
        F.when(kind.isin("view", "click"), "Cerah")
        .when(kind == "signup", "Cerah Berawan")
        .when(kind == "error", "Hujan Ringan")
        .otherwise("Berawan")
        .alias("weather_desc"),
        F.concat((seq % 37).cast("string"), F.lit("-"), (seq % 37 + 1).cast("string")).alias("time_index"),
        F.substring(F.col("ts").cast("string"), 1, 10).alias("analysis_date"),
    )


def desa(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _places(spark, sf_dir).select(
        F.col("n_nationkey").cast("string").alias("kode"),
        F.col("n_name").alias("desa"),
        F.col("r_name").alias("kecamatan"),
    )


def fact_prakiraan_cuaca(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.date_format(F.col("ts").cast("date"), "yyyyMMdd").cast("int").alias("date_sk"),
        F.col("user_id").alias("wilayah_sk"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_siaga"),
    )


_VIEWS = {
    "raw_transactions": transactions,
    "raw_transaction_items": transaction_items,
    "raw_products": products,
    "raw_outlets": outlets,
    "raw_mahasiswa": mahasiswa,
    "raw_presensi": presensi,
    "raw_nilai": nilai,
    "raw_prakiraan_cuaca": prakiraan_cuaca,
    "raw_desa": desa,
}


class StandinViews(Mapping[str, DataFrame]):
    """``raw_*`` frames by view name, each made when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self._spark, self._dir = spark, sf_dir
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = _VIEWS[name](self._spark, self._dir)
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(_VIEWS)

    def __len__(self) -> int:
        return len(_VIEWS)


def raw_sales(spark: SparkSession, sf_dir: str) -> RawSales:
    return RawSales(
        transactions=transactions(spark, sf_dir),
        items=transaction_items(spark, sf_dir),
        products=products(spark, sf_dir),
        outlets=outlets(spark, sf_dir),
    )
