import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lapakdw.operators.headers import header_check, items_dedup, transactions_clean
from lapakdw.operators.scd import scd2_lookup
from lapakdw.plans import dims as d
from lapakdw.plans.fact import Dims, fact_transaksi_item, grain_guard
from tests.helpers import headers, items, products, small_shop


@pytest.fixture(scope="module")
def shop(spark):
    return small_shop(spark)


@pytest.fixture(scope="module")
def shop_dims(spark, shop):
    return Dims(d.dim_date(spark), d.dim_product(shop.products), d.dim_outlet(shop.outlets), d.dim_status(spark))


@pytest.fixture(scope="module")
def fact_rows(shop, shop_dims):
    return fact_transaksi_item(shop, shop_dims).collect()


def of(rows, trx):
    return sorted((r for r in rows if r.transaction_id == trx), key=lambda r: (r.item_id, r.qty))


def test_items_dedup_keeps_rows_that_differ(shop):
    assert items_dedup(shop.items).count() == shop.items.count() - 1


def test_header_check_counts_values_not_nulls(shop):
    counts = {r.transaction_id: tuple(r)[1:] for r in header_check(shop.transactions).collect()}
    assert counts["T2"] == (1, 1, 1, 1)
    assert counts["T4"] == (1, 1, 2, 1)
    assert counts["T5"] == (0, 1, 1, 1)
    assert counts["T6"] == (1, 1, 1, 1)


def test_header_gate(shop):
    clean = {r.transaction_id: r for r in transactions_clean(shop.transactions).collect()}
    assert sorted(clean) == ["T1", "T2", "T3", "T6", "T7", "T8"]
    assert clean["T6"].outlet_id == "OUT-B"


def test_header_gate_agrees_with_the_counts(spark, shop):
    extra = headers(spark, (None, "OUT-A", None, "2025-01-01", "PAID", "1"), ("T9", "OUT-A", None, None, "PAID", "1"))
    both = shop.transactions.unionByName(extra)
    ones = header_check(both).where(
        "outlet_count = 1 AND tanggal_count = 1 AND status_count = 1 AND total_bayar_count = 1"
    )
    expected = {r.transaction_id for r in ones.collect()} - {None}
    assert {r.transaction_id for r in transactions_clean(both).collect()} == expected


def test_lines_of_clean_headers_once(fact_rows):
    assert sorted(r.transaction_id for r in fact_rows) == ["T1", "T1", "T2", "T2", "T3", "T6", "T7"]
    assert [r.qty for r in of(fact_rows, "T1")] == [2, 3]


def test_measures(fact_rows):
    sale, back = of(fact_rows, "T2")
    assert sale.subtotal_rupiah == Decimal("9500.25")
    assert sale.total_bayar_trx == Decimal("10000.00")
    assert (back.qty, back.subtotal_rupiah) == (-1, Decimal("-4000.00"))


def test_price_version_of_the_day(fact_rows):
    assert {r.product_sk for r in of(fact_rows, "T1")} == {1}  # first price of P1
    assert of(fact_rows, "T2")[0].product_sk == 2  # second price of P1
    assert of(fact_rows, "T3")[0].product_sk == -1  # sold before the first price of P2
    assert of(fact_rows, "T6")[0].product_sk == -1  # no such product


def test_unknown_members(fact_rows, shop_dims):
    statuses = {r.status_sk: r.status_code for r in shop_dims.status.collect()}
    assert statuses[of(fact_rows, "T2")[0].status_sk] == "PAID"
    assert of(fact_rows, "T3")[0].status_sk == -1
    far = of(fact_rows, "T7")[0]
    assert (far.date_sk, far.outlet_sk) == (-1, -1)
    assert all(None not in (r.date_sk, r.product_sk, r.outlet_sk, r.status_sk) for r in fact_rows)


def test_utc_times_stay_on_their_written_day_unless_moved(shop, shop_dims, fact_rows):
    assert of(fact_rows, "T3")[0].date_sk == 20250131
    moved = fact_transaksi_item(shop, shop_dims, local_tz="Asia/Jakarta").collect()
    assert of(moved, "T3")[0].date_sk == 20250201
    assert of(moved, "T1")[0].date_sk == 20250110


def test_additivity_is_recorded(shop, shop_dims):
    schema = fact_transaksi_item(shop, shop_dims).schema
    assert schema["total_bayar_trx"].metadata == {"additivity": "SEMI-ADDITIVE"}
    assert schema["qty"].metadata == {"additivity": "ADDITIVE"}


def test_malformed_quantity_stops_the_build(spark, shop, shop_dims):
    bad = items(spark, ("T1", "9", "P1", "two", "1", "0"))
    raw = type(shop)(shop.transactions, bad, shop.products, shop.outlets)
    with pytest.raises(PySparkException):
        fact_transaksi_item(raw, shop_dims).collect()


def test_grain_guard(spark, shop, shop_dims):
    fact = fact_transaksi_item(shop, shop_dims)
    assert [tuple(r) for r in grain_guard(fact, shop_dims.status).collect()] == [("T1", 1, 2)]
    assert grain_guard(fact.where("qty <> 3"), shop_dims.status).count() == 0


def test_missing_price_starts_overlap_like_other_open_versions(spark):
    dim = d.dim_product(
        products(
            spark,
            ("P", "a", "c", "1", "2025-01-01", "ya"),
            ("P", "a", "c", "2", None, "ya"),
        )
    )
    day = spark.createDataFrame([("P", dt.date(2025, 5, 1))], "product_id string, day date")
    assert {r.product_sk for r in scd2_lookup(day, dim, "product_id", "day", "product_sk").collect()} == {1, 2}


def test_dimensions(shop_dims):
    dates = shop_dims.date
    assert dates.count() == 1461 + 1
    row = dates.where("date_sk = 20241230").first()
    assert (row.pekan_iso, row.nama_bulan, row.nama_hari, row.hari_ke, row.akhir_pekan, row.triwulan) == (
        1, "December", "Monday", 1, False, 4,
    )
    assert dates.where("akhir_pekan AND hari_ke NOT IN (0, 6)").count() == 0
    assert dates.where("date_sk = -1").first().nama_hari == "TIDAK DIKETAHUI"
    outlets = {r.outlet_id: r for r in shop_dims.outlet.collect()}
    assert (outlets["OUT-A"].outlet_sk, outlets["OUT-A"].is_aktif) == (1, True)
    assert (outlets["OUT-B"].outlet_sk, outlets["OUT-B"].is_aktif) == (2, False)
    assert outlets["OUT-UNKNOWN"].outlet_sk == -1
    codes = {r.status_code: r.status_sk for r in shop_dims.status.collect()}
    assert codes == {"CANCELLED": 1, "PAID": 2, "PARTIAL": 3, "PENDING": 4, "REFUNDED": 5, "UNKNOWN": -1}
    third = shop_dims.product.where("product_id = 'P3'").first()
    assert (str(third.valid_from), third.is_current, third.is_aktif) == ("2024-01-01", True, False)
    assert shop_dims.product.where(F.col("product_sk") == -1).first().product_id == "PRD-UNKNOWN"


DIRTY = [("T21", "OUT-A", "C", "0001-01-01 09:00:00", "PAID", "1"), ("T22", "OUT-A", "C", "9999-12-31 09:00:00", "PAID", "1")]


def test_days_are_computed_whatever_the_calendar(spark, shop):
    """Two mistyped years make a calendar of 3.65 million days, which no join has to carry."""
    from lapakdw.plans import metrics
    from lapakdw.plans.load import years_of
    from lapakdw.plans.warehouse import Star
    from tests.helpers import plan

    more = items(spark, ("T21", "1", "P1", "1", "10", "0"), ("T22", "1", "P1", "1", "20", "0"))
    raw = type(shop)(shop.transactions.unionByName(headers(spark, *DIRTY)), shop.items.unionByName(more), shop.products, shop.outlets)
    dates = d.calendar(years_of(raw.transactions))
    dims = Dims(dates, d.dim_product(raw.products), d.dim_outlet(raw.outlets), d.dim_status(spark))
    assert d.calendar_span(dates) == d.Span(10101, 99991231)
    fact = fact_transaksi_item(raw, dims)
    keys = {r.transaction_id: r.date_sk for r in fact.select("transaction_id", "date_sk").distinct().collect()}
    assert (keys["T21"], keys["T22"], keys["T1"], keys["T7"]) == (10101, 99991231, 20250110, 20310101)
    daily = metrics.m01_daily_revenue(Star.of(fact, dims))
    found = {(r.tanggal.isoformat(), r.outlet_id) for r in daily.collect()}
    assert {("0001-01-01", "OUT-A"), ("9999-12-31", "OUT-A"), ("2025-01-10", "OUT-A")} <= found
    assert "full_date" not in "".join(t for t in plan(daily).splitlines() if "Join" in t or "BroadcastExchange" in t)


def test_calendars_with_gaps_or_copies_are_joined(spark):
    """Lines of a missing day are of the Unknown day; a day that is there twice counts twice."""
    from lapakdw.plans.fact import date_lookup

    dates = d.dim_date(spark, "2025-01-01", "2025-01-31")
    days = spark.createDataFrame([(dt.date(2025, 1, i),) for i in (1, 2, 3)] + [(dt.date(2024, 1, 1),), (None,)], "day date")

    def keys(calendar):
        return sorted(r.date_sk for r in date_lookup(days, calendar, "day").collect())

    assert d.calendar_span(dates) == d.Span(20250101, 20250131)
    assert keys(dates) == [-1, -1, 20250101, 20250102, 20250103]
    gap = dates.where("date_sk <> 20250102")
    assert d.calendar_span(gap) is None and keys(gap) == [-1, -1, -1, 20250101, 20250103]
    twice = dates.unionByName(dates.where("date_sk = 20250103"))
    assert d.calendar_span(twice) is None and keys(twice).count(20250103) == 2
    both = gap.unionByName(dates.where("date_sk = 20250103"))  # as many rows as days
    assert d.calendar_span(both) is None and keys(both) == [-1, -1, -1, 20250101, 20250103, 20250103]


def test_computed_columns_are_those_of_the_calendar(spark):
    dates = d.dim_date(spark, "1999-12-25", "2024-03-02")
    told = dates.select("date_sk", *(c.alias(f"c_{n}") for n, c in d.day_columns(F.col("date_sk")).items()), *d.day_columns(F.lit(1)))
    off = [f"NOT (c_{n} <=> {n})" for n in d.day_columns(F.lit(1))]
    assert told.count() == dates.count() and told.where(" OR ".join(off)).count() == 0
    odd = spark.createDataFrame([(20250230,), (20251301,), (20250100,), (0,), (-5,), (None,)], "k int")
    assert [r[0] for r in odd.select(d.day_of(F.col("k"))).collect()] == [None] * 6
    assert odd.where(d.Span(20250101, 20251231).holds(F.col("k"))).count() == 0
