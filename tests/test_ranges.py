import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from lapakdw.operators import ranges
from lapakdw.operators.ranges import nulls_last, surrogate_key, total_order
from lapakdw.operators.scd import scd2_versions
from tests.helpers import plan, products


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k string, v string")


def by_window(df, order, name):
    window = Window.orderBy(*nulls_last(total_order(df, order)))
    return df.select(F.row_number().over(window).cast("bigint").alias(name), *df.columns)


def same_rows(left, right):
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


@pytest.fixture(scope="module")
def mixed(spark):
    """Keys out of order, a key that holds a third of the rows, copies, and missing keys."""
    rng = random.Random(7)
    rows = [(f"K{rng.randrange(400):04d}", str(rng.randrange(50))) for _ in range(600)]
    rows += [("HOT", str(i % 200)) for i in range(300)] + [(None, "x"), (None, None), ("K0001", None)]
    rng.shuffle(rows)
    return keyed(spark, rows).repartition(6)


def test_one_range_equals_row_number(mixed):
    assert same_rows(surrogate_key(mixed, ["k"], "sk"), by_window(mixed, ["k"], "sk"))


@pytest.mark.parametrize("range_rows", [37, 250])
def test_many_ranges_equal_row_number(mixed, range_rows):
    assert same_rows(surrogate_key(mixed, ["k"], "sk", range_rows), by_window(mixed, ["k"], "sk"))


def test_much_copied_row_is_written_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(ranges, "COPY_CHUNK", 10)
    df = keyed(spark, [("A", "1")] * 95 + [(f"B{i}", "1") for i in range(50)])
    numbered = surrogate_key(df, ["k"], "sk", range_rows=20)
    assert "hashpartitioning(_start" in plan(numbered)
    assert same_rows(numbered, by_window(df, ["k"], "sk"))


def test_keys_are_dense_and_repeatable(mixed):
    first = surrogate_key(mixed, ["k"], "sk", 100).collect()
    second = surrogate_key(mixed.repartition(3), ["k"], "sk", 100).collect()
    assert sorted(r.sk for r in first) == list(range(1, mixed.count() + 1))
    assert sorted(map(repr, first)) == sorted(map(repr, second))


def test_many_ranges_need_no_single_partition_of_rows(mixed):
    text = plan(surrogate_key(mixed, ["k"], "sk", 100))
    # The only single partition is the one over the table of ranges.
    assert text.count("SinglePartition") <= 1


def versions(spark, df, range_rows=ranges.RANGE_ROWS):
    return scd2_versions(df, "product_id", "harga_berlaku_dari", "sk", "2024-01-01", range_rows)


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    rows = []
    for p in range(60):
        for _ in range(rng.randrange(1, 5)):
            day = rng.choice([None, *(f"2025-{m:02d}-01" for m in range(1, 13))])
            rows.append((f"P{p:03d}", f"n{p}", "c", str(rng.randrange(3)), day, "ya"))
    rows += [("P-HOT", "hot", "c", str(i % 7), f"2025-{1 + i % 12:02d}-{1 + i % 28:02d}", "ya") for i in range(150)]
    rows += [("P000", "n0", "c", "1", "2025-01-01", "ya")] * 5
    rng.shuffle(rows)
    return products(spark, *rows).repartition(5)


@pytest.mark.parametrize("range_rows", [1_000_000, 23])
def test_versions_equal_the_window_form(spark, history, range_rows):
    order = total_order(history, ["product_id", "harga_berlaku_dari"])
    within = Window.partitionBy("product_id").orderBy(*nulls_last(order[1:]))
    nxt = F.lead("harga_berlaku_dari").over(within)
    expected = history.select(
        F.row_number().over(Window.orderBy(*nulls_last(order))).cast("bigint").alias("sk"),
        *history.columns,
        F.coalesce(F.col("harga_berlaku_dari").cast("date"), F.lit("2024-01-01").cast("date")).alias("valid_from"),
        F.coalesce(F.date_sub(nxt.cast("date"), 1), F.lit("9999-12-31").cast("date")).alias("valid_to"),
        nxt.isNull().alias("is_current"),
    )
    assert same_rows(versions(spark, history, range_rows), expected)


def test_periods_of_dated_versions_do_not_overlap(spark, history):
    dated = history.where("harga_berlaku_dari IS NOT NULL")
    kept = versions(spark, dated, 23).where("valid_from <= valid_to").alias("a")
    other = kept.alias("b")
    overlap = kept.join(
        other,
        (F.col("a.product_id") == F.col("b.product_id"))
        & (F.col("a.sk") < F.col("b.sk"))
        & (F.col("a.valid_to") >= F.col("b.valid_from"))
        & (F.col("b.valid_to") >= F.col("a.valid_from")),
    )
    assert overlap.count() == 0
    current = kept.where("is_current").groupBy("product_id").count()
    assert current.where("count <> 1").count() == 0
    assert current.count() == dated.select("product_id").distinct().count()


def test_same_day_versions_keep_one_period(spark):
    df = products(
        spark,
        ("P", "a", "c", "1", "2025-01-01", "ya"),
        ("P", "a", "c", "2", "2025-01-01", "ya"),
        ("P", "a", "c", "3", "2025-03-01", "ya"),
    )
    rows = versions(spark, df).orderBy("sk").collect()
    assert [(str(r.valid_from), str(r.valid_to), r.is_current) for r in rows] == [
        ("2025-01-01", "2024-12-31", False),
        ("2025-01-01", "2025-02-28", False),
        ("2025-03-01", "9999-12-31", True),
    ]
