"""A third of the rows under one key: the results stay exact and the work is split."""

import re

import pytest
from pyspark.sql import functions as F

from lapakdw.operators import scd
from lapakdw.operators.checks import matching_pairs, orphan_rows
from lapakdw.operators.headers import heavy_headers, items_dedup, lines_of_headers, transactions_clean
from lapakdw.operators.scd import scd2_lookup
from lapakdw.plans import dims as d
from lapakdw.plans.fact import Dims, fact_transaksi_item
from lapakdw.runtime import materialize, measured_bytes, shuffle_settings, sql_conf
from lapakdw.sources.raw import RawSales
from tests.helpers import outlets, plan, products

TINY_PARTITIONS = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "8",
}


def lines(spark, n=30_000):
    """Lines of which a third belong to header 'HOT', half of those identical copies."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(0, n, 1, 16).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("T"), (i % 5000).cast("string"))).alias("transaction_id"),
        F.when(hot & (i % 2 == 0), "1").otherwise(i.cast("string")).alias("item_id"),
        F.lit("P").alias("product_id"),
        F.lit("1").alias("qty"),
        F.lit("1000").alias("harga_satuan"),
        F.lit("0").alias("diskon"),
    )


def heads(spark):
    names = spark.range(0, 5000, 1, 4).select(F.concat(F.lit("T"), F.col("id").cast("string")).alias("transaction_id"))
    names = names.unionByName(spark.range(1).select(F.lit("HOT").alias("transaction_id")))
    fixed = {"outlet_id": "OUT-A", "customer_id": "C", "tanggal_waktu": "2025-01-01 09:00:00", "status": "PAID", "total_bayar": "1"}
    return names.select("transaction_id", *(F.lit(v).alias(k) for k, v in fixed.items()))


def hot_shop(spark):
    return RawSales(
        transactions=heads(spark),
        items=lines(spark),
        products=products(spark, ("P", "Teh", "Minuman", "1000", "2024-01-01", "ya")),
        outlets=outlets(spark, ("OUT-A", "Satu", "Bandung", "outlet", "ya", "2023-03-01")),
    )


def final_plan(df):
    df.collect()
    return plan(df)


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_header_is_split_and_lines_stay_exact(spark, monkeypatch, broadcast):
    """Lines are shuffled once for de-duplication and join; those of the hot header by all their columns."""
    if not broadcast:
        monkeypatch.setattr("lapakdw.runtime.BROADCAST_BYTES", -1)
        assert heavy_headers(lines(spark)) == ["HOT"]
    settings = {**shuffle_settings(spark, lines(spark)), **TINY_PARTITIONS}
    shop = hot_shop(spark)
    dims = Dims(d.dim_date(spark), d.dim_product(shop.products), d.dim_outlet(shop.outlets), d.dim_status(spark))
    with sql_conf(spark, settings):
        df = fact_transaksi_item(shop, dims)
        text = plan(df)
        found = df.select("transaction_id", "item_id").toPandas()
    by_all = [t for t in text.splitlines() if re.search(r"Exchange hashpartitioning\(.*item_id.*\), ENSURE", t)]
    assert len(by_all) == 1 and "transaction_id" in by_all[0]
    assert text.count("REPARTITION_BY_COL") == (0 if broadcast else 1)
    expected = lines(spark).select("transaction_id", "item_id").toPandas().drop_duplicates()
    assert len(found) == len(expected)
    assert set(found.itertuples(index=False, name=None)) == set(expected.itertuples(index=False, name=None))


def test_lines_without_a_kept_header_are_dropped_before_the_shuffle(spark):
    """A slice of a few headers reads all lines but shuffles only its own."""
    kept = heads(spark).where("transaction_id IN ('T1', 'T2')").select("transaction_id", "status")
    text = plan(lines_of_headers(lines(spark), kept))
    semi, shuffle = text.index("LeftSemi"), text.index("Exchange hashpartitioning")
    assert semi > shuffle and text.count("Exchange hashpartitioning") == 1  # the plan reads from the bottom
    assert "LeftSemi" in text[shuffle:]
    assert lines_of_headers(lines(spark), kept).count() == 8


def test_one_shuffle_by_header_id_without_heavy_ids(spark, monkeypatch):
    monkeypatch.setattr("lapakdw.runtime.BROADCAST_BYTES", -1)
    even = lines(spark).where("transaction_id <> 'HOT'")
    assert heavy_headers(even) == []
    with sql_conf(spark, TINY_PARTITIONS):
        df = lines_of_headers(even, materialize(heads(spark), "heads"))
        text = plan(df)
        of_lines = [t for t in text.splitlines() if "Exchange" in t and "Range" not in t]
        assert len(of_lines) == 2  # the lines, and the headers to meet them
        assert df.count() == even.distinct().count()


def test_lines_meet_their_headers_before_copies_are_grouped(spark, monkeypatch):
    monkeypatch.setattr("lapakdw.runtime.BROADCAST_BYTES", -1)
    even = lines(spark).where("transaction_id <> 'HOT'")
    keyed = materialize(heads(spark).select("transaction_id", F.lit(7).alias("outlet_sk")), "heads")
    df = lines_of_headers(even, keyed)
    text = plan(df)
    assert text.index("HashAggregate") < text.index("Join")  # read from the bottom
    found = sorted(map(tuple, df.select(*even.columns, "outlet_sk").collect()))
    assert found == sorted((*row, 7) for row in even.distinct().collect())


def test_grouping_lines_holds_no_column_twice(spark, monkeypatch):
    monkeypatch.setattr("lapakdw.runtime.BROADCAST_BYTES", -1)
    even = lines(spark).where("transaction_id <> 'HOT'")
    keyed = materialize(heads(spark).select("transaction_id", F.lit(7).alias("outlet_sk")), "heads")
    df = lines_of_headers(even.unionByName(even), keyed)
    grouping = [t for t in plan(df).splitlines() if "HashAggregate" in t]
    assert grouping and all("functions=[]" in t for t in grouping)
    assert df.count() == even.distinct().count()


def test_copies_of_lines_are_dropped_before_the_shuffle(spark):
    text = plan(items_dedup(lines(spark)))
    assert text.count("Exchange") == 1
    final, shuffle, partial = (m.start() for m in re.finditer("HashAggregate|Exchange", text))
    assert final < shuffle < partial
    spread = text[shuffle:].splitlines()[0]
    hashed = re.search(r"hashpartitioning\((.*?), 4\)", spread).group(1).split(", ")
    assert len(hashed) == 6


def sales_of_hot_product(spark):
    day = F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 300).cast("int"))
    return spark.range(0, 30_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise((F.col("id") % 500).cast("string")).alias("product_id"),
        day.alias("day"),
        F.repeat(F.lit("x"), 40).alias("pad"),
    )


def hot_versions(spark, days):
    """A version of HOT every ``days`` days of 2025, and one version of every other product."""
    n = F.col("id")
    count = 300 // days
    start = F.lit("2025-01-01").cast("date")
    return spark.range(0, 500 + count, 1, 2).select(
        F.when(n < count, "HOT").otherwise((n - count).cast("string")).alias("product_id"),
        n.alias("product_sk"),
        F.when(n < count, F.date_add(start, (n * days).cast("int")))
        .otherwise(F.lit("2025-03-01").cast("date"))
        .alias("valid_from"),
        F.when(n < count - 1, F.date_add(start, (n * days + days - 1).cast("int")))
        .otherwise(F.lit("9999-12-31").cast("date"))
        .alias("valid_to"),
    )


def check_hot_product(df, days):
    found = {(r.product_id, r.day, r.product_sk) for r in df.collect()}
    assert df.count() == 30_000
    for product, when, sk in found:
        offset = (when - when.replace(month=1, day=1)).days
        if product == "HOT":
            assert sk == offset // days
        else:
            assert sk == (int(product) + 300 // days if offset >= 59 else -1)


def test_hot_product_lookup_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("lapakdw.runtime.BROADCAST_BYTES", -1)
    sales = sales_of_hot_product(spark)
    with sql_conf(spark, {**shuffle_settings(spark, sales), **TINY_PARTITIONS}):
        df = scd2_lookup(sales, hot_versions(spark, 30), "product_id", "day", "product_sk")
        text = final_plan(df)
        assert "SortMergeJoin" in text and "skew=true" in text
        check_hot_product(df, 30)


def test_product_with_many_versions_is_joined_by_year(spark, monkeypatch):
    monkeypatch.setattr(scd, "CANDIDATES", 20)
    df = scd2_lookup(sales_of_hot_product(spark), hot_versions(spark, 3), "product_id", "day", "product_sk")
    assert "BroadcastHashJoin" in plan(df) and "_year" in plan(df)
    check_hot_product(df, 3)


def test_year_join_equals_plain_join(spark, monkeypatch):
    days = spark.createDataFrame(
        [("A", f"{y}-{m:02d}-15") for y in (1899, 1999, 2003, 2004, 2009, 2010, 2011, 2024, 9999) for m in (1, 7)]
        + [("B", "2005-01-01"), (None, "2005-01-01"), ("A", None)],
        "product_id string, day string",
    ).select("product_id", F.col("day").cast("date").alias("day"))
    versions = spark.createDataFrame(
        [
            (1, "A", "2000-01-01", "2003-06-30"), (2, "A", "2003-07-01", "2008-12-31"),
            (3, "A", "2009-01-01", "2009-07-14"), (4, "A", "2009-07-15", "2010-01-15"),
            (5, "A", "2010-01-16", "9999-12-31"), (6, "A", "2024-01-01", "9999-12-31"),
            (7, "A", "2024-01-01", "2023-12-31"), (-1, "U", "1900-01-01", "9999-12-31"),
        ],
        "product_sk long, product_id string, a string, b string",
    ).selectExpr("product_sk", "product_id", "CAST(a AS DATE) AS valid_from", "CAST(b AS DATE) AS valid_to")

    def found():
        return sorted(map(repr, scd2_lookup(days, versions, "product_id", "day", "product_sk").collect()))

    plain = found()
    assert len(plain) == days.count() + 4  # versions 5 and 6 overlap from 2024 on
    monkeypatch.setattr(scd, "CANDIDATES", 2)
    assert found() == plain


def test_hot_key_on_both_sides_is_counted_without_pairs(spark):
    n = F.col("id")
    key = F.when(n % 3 == 0, "HOT").otherwise((n % 1000).cast("string")).alias("k")
    # 100,000 x 100,000 pairs under one key: only a count can answer this.
    left, right = spark.range(0, 300_000, 1, 8).select(key), spark.range(0, 300_000, 1, 8).select(key)
    per_key = left.groupBy("k").count().toPandas()["count"]
    assert matching_pairs(left, right, "k").first()[0] == int((per_key**2).sum())


def test_orphans_are_grouped_before_the_join(spark):
    n = F.col("id")
    child = spark.range(0, 9000, 1, 4).select(
        F.when(n % 3 == 0, "HOT").when(n % 3 == 1, (n % 50).cast("string")).alias("k")
    )
    parent = spark.range(0, 40, 1, 2).select(F.col("id").cast("string").alias("k"))
    parent = parent.unionByName(parent)
    df = orphan_rows(child, parent, "k")
    expected = sum(1 for i in range(9000) if i % 3 != 1 or i % 50 >= 40)
    assert df.first()[0] == expected
    below_join = plan(df).split("LeftOuter")[1]
    assert "partial_count(1)" in below_join


def test_hot_header_copies_are_combined_before_the_shuffle(spark):
    n = F.col("id")
    raw = spark.range(0, 9000, 1, 4).select(
        F.when(n % 3 == 0, "HOT").otherwise(n.cast("string")).alias("transaction_id"),
        F.lit("OUT-A").alias("outlet_id"),
        F.lit("2025-01-01").alias("tanggal_waktu"),
        F.lit("PAID").alias("status"),
        F.lit("1").alias("total_bayar"),
    )
    df = transactions_clean(raw)
    assert df.count() == 6001
    text = plan(df)
    assert text.index("Exchange") < text.index("partial_min")


@pytest.mark.parametrize("text, size", [("ab", 16 + 2 + 8), ("", 16 + 8)])
def test_measured_size(spark, text, size):
    df = spark.range(10).select(F.lit(text).alias("a"), F.col("id"))
    assert measured_bytes(df) == 10 * size
