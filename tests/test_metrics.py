import datetime as dt
from decimal import Decimal

import pytest

from lapakdw.plans import dims as d
from lapakdw.plans import metrics as m
from lapakdw.plans.fact import Dims
from lapakdw.plans.load import build_warehouse
from lapakdw.plans.warehouse import Star
from tests.helpers import outlets, plan, small_shop

PAID, PENDING = 2, 4
SCOPE = m.Scope(outlets=("OUT-A", "OUT-B"), year=2025)


@pytest.fixture(scope="module")
def star(spark):
    """Saturday 2025-01-04, Monday 2025-01-06, February, March, and a line outside the year."""
    rows = [
        (20250104, 1, PAID, "T1", "1", 2, "100.00"),
        (20250104, 1, PAID, "T1", "2", 1, "50.00"),
        (20250104, 1, PAID, "T1", "3", -1, "-30.00"),
        (20250106, 1, PAID, "T2", "1", 1, "80.00"),
        (20250106, 1, PAID, "T3", "1", 1, "81.00"),
        (20250210, 1, PAID, "T4", "1", -2, "0.00"),
        (20250310, 1, PAID, "T5", "1", 1, "70.50"),
        (20250310, 1, PENDING, "T6", "1", -1, "-5.00"),
        (20250110, 2, PAID, "T7", "1", 1, "9.00"),
        (20250110, 3, PAID, "T8", "1", 1, "900.00"),
        (20240110, 1, PAID, "T9", "1", 1, "900.00"),
    ]
    fact = spark.createDataFrame(
        [(*row[:-1], Decimal(row[-1])) for row in rows],
        "date_sk int, outlet_sk long, status_sk long, transaction_id string, item_id string, qty int,"
        " subtotal_rupiah decimal(18,2)",
    )
    shops = outlets(spark, *((f"OUT-{c}", c, "x", "x", "ya", "2023-01-01") for c in "ABC"))
    return Star.of(fact, Dims(d.dim_date(spark), None, d.dim_outlet(shops), d.dim_status(spark)))


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_basket(star):
    assert rows(m.q01_basket(star, SCOPE)) == [
        ("OUT-A", "akhir_pekan", 1, 2.0, 150.0),
        ("OUT-A", "hari_kerja", 3, 1.0, 77.0),
        ("OUT-B", "hari_kerja", 1, 1.0, 9.0),
    ]


def test_growth_and_rank(star):
    assert rows(m.q02_mom_rank(star, SCOPE)) == [
        ("OUT-A", 2025, 1, Decimal("281.00"), None, None, 1),
        ("OUT-A", 2025, 2, Decimal("0.00"), Decimal("281.00"), -100.0, 3),
        ("OUT-A", 2025, 3, Decimal("70.50"), Decimal("0.00"), None, 2),
        ("OUT-B", 2025, 1, Decimal("9.00"), None, None, 1),
    ]


def test_growth_without_rank(star):
    assert rows(m.m02_mom_growth(star, SCOPE)) == [r[:-1] for r in rows(m.q02_mom_rank(star, SCOPE))]


def test_return_rate_counts_every_status(star):
    expected = [("OUT-A", 1, 8, 3, 37.5, Decimal("-35.00")), ("OUT-B", 1, 1, 0, 0.0, Decimal("0.00"))]
    assert rows(m.q03_return_rate(star, SCOPE)) == expected
    ratio = m.m03_return_ratio(star, SCOPE)
    assert rows(ratio) == expected
    assert ratio.columns == [
        "outlet_id", "triwulan", "total_baris_item", "baris_retur", "rasio_retur_pct", "nilai_retur_rupiah",
    ]


def test_daily_revenue_has_no_empty_days(star):
    found = rows(m.m01_daily_revenue(star))
    assert (dt.date(2025, 1, 4), "OUT-A", Decimal("120.00")) in found
    assert (dt.date(2024, 1, 10), "OUT-A", Decimal("900.00")) in found
    assert len(found) == 7


def test_monthly_revenue_rounds_half_up(star):
    assert rows(m.monthly_net_revenue(star, SCOPE)) == [
        ("OUT-A", 2025, 1, 281, 3, 5, 1),
        ("OUT-A", 2025, 2, 0, 1, 1, 1),
        ("OUT-A", 2025, 3, 71, 1, 1, 0),
        ("OUT-B", 2025, 1, 9, 1, 1, 0),
    ]


def test_alerts(spark, star):
    fact = spark.createDataFrame(
        [(20250101, 1, 1), (20250101, 1, 1), (20250101, 2, 1), (20250101, 3, 0), (20250102, 1, 1), (19990101, 1, 1)],
        "date_sk int, wilayah_sk long, is_siaga int",
    )
    found = rows(m.alert_entities_per_day(fact, d.dim_date(spark)))
    assert found == [(dt.date(2025, 1, 1), 2), (dt.date(2025, 1, 2), 1)]


@pytest.mark.parametrize("report", [m.q01_basket, m.q02_mom_rank, m.q03_return_rate, m.monthly_net_revenue])
def test_dimensions_are_broadcast(star, report):
    text = plan(report(star, SCOPE))
    assert "SortMergeJoin" not in text and "NestedLoop" not in text and "Cartesian" not in text


def test_standard_scope():
    assert m.STANDARD == m.Scope(("OUT-A", "OUT-B", "OUT-C"), 2025)


def test_year_filter_reaches_the_scan(spark, sql_settings, tmp_path):
    sql_settings(spark__sql__maxMetadataStringLength="2000")
    wh = build_warehouse(small_shop(spark), str(tmp_path / "wh"))
    text = plan(m.q03_return_rate(wh.star))
    scan = next(t for t in text.splitlines() if "FileScan" in t and "subtotal_rupiah" in t)
    assert "PartitionFilters: [isnotnull(p_tahun" in scan
    assert "ReadSchema: struct<date_sk:int,outlet_sk:bigint,qty:int,subtotal_rupiah:decimal(18,2)>" in scan


def test_reports_start_no_job_while_they_are_planned(spark, star):
    tracker, group = spark.sparkContext.statusTracker(), "planning"
    spark.sparkContext.setJobGroup(group, group)
    for report in (m.q01_basket, m.q02_mom_rank, m.q03_return_rate, m.m02_mom_growth, m.monthly_net_revenue):
        report(star, SCOPE)
    assert list(tracker.getJobIdsForGroup(group)) == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_no_outlet_found(star):
    assert rows(m.q02_mom_rank(star, m.Scope(("OUT-Q",), 2025))) == []
