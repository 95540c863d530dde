import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lapakdw.operators.checks import (
    VIOLATIONS,
    RowRule,
    blank,
    cross_table,
    domain,
    duplicate_key,
    fd_violation,
    orphan,
    pattern,
    typed,
    value_range,
)
from lapakdw.plans.dq import SPECS, DqSpec, check, run_dq, verify_dq
from lapakdw.plans.load import QualityGateError, build_warehouse
from lapakdw.runtime import materialize
from tests.helpers import plan, small_shop, texts


@pytest.fixture(scope="module")
def views(spark):
    shop = small_shop(spark)
    return {
        "raw_transactions": shop.transactions,
        "raw_transaction_items": shop.items,
        "raw_products": shop.products,
        "v": texts(
            spark,
            ["a", "b", "n"],
            [
                ("x", "1", "5"), ("x", "2", "-5"), (" X ", "1", "101"),
                ("y", "1", "abc"), ("", None, None), (None, "1", "12.5"),
            ],
        ),
    }


def count(spark, views, rule):
    return check(spark, views, DqSpec("t", "t2", "warning", "pass", 0, rule)).first()[VIOLATIONS]


@pytest.mark.parametrize(
    "rule, expected",
    [
        (duplicate_key("v", "a"), 1),
        (duplicate_key("v", "a", "b"), 0),
        (pattern("v", "n", "%5"), 3),
        (value_range("v", lambda: typed("n", "int"), lambda v: (v > 100) | (v < 0)), 2),
        (value_range("v", lambda: typed("n", "int"), lambda v: v == 13), 1),  # 12.5 rounds away from zero
        (domain("v", "a", ("X",)), 2),
        (blank("v", "a"), 2),
        (fd_violation("v", "a", "b"), 1),
        (duplicate_key("raw_transactions", "transaction_id"), 3),
        (orphan("raw_transaction_items", "raw_products", "product_id"), 1),
        (orphan("raw_transactions", "raw_transaction_items", "transaction_id"), 1),
        (
            # T2 has two headers, so its one negative line counts twice.
            cross_table(
                "raw_transaction_items", lambda: typed("qty", "int") < 0,
                "raw_transactions", lambda: F.upper(F.trim("status")) != "REFUND", "transaction_id",
            ),
            2,
        ),
        ("SELECT count(*) FROM range(7) WHERE id > 4", 2),
    ],
)
def test_rules_count_violations(spark, views, rule, expected):
    assert count(spark, views, rule) == expected


def test_rules_that_expect_nothing_can_fail(spark):
    bad = {
        "raw_mahasiswa": texts(spark, ["nim"], [("1",), ("1",)]),
        "raw_transaction_items": texts(spark, ["harga_satuan"], [("0",), ("10",), ("-1",)]),
    }
    by_name = {s.name: s for s in SPECS}
    assert check(spark, bad, by_name["nim_duplikat"]).first()[0] == 1
    assert check(spark, bad, by_name["harga_satuan_tidak_positif"]).first()[0] == 2


def spec(name, rule, severity="blocking", expected="pass", rows=0, **more):
    return DqSpec(name, "t9", severity, expected, rows, rule, **more)


def test_report(spark, views):
    report = run_dq(
        spark,
        views,
        [
            spec("clean", blank("v", "b"), expected="fail", rows=1),
            spec("off", blank("v", "a"), expected="pass"),
            spec("off_warning", blank("v", "a"), severity="warning"),
            spec("odd", blank("v", "a"), severity="fatal"),
            spec("later", "SELECT count(*) FROM wh.fact", needs_warehouse=True),
            spec("broken", blank("v", "no_such_column")),
            spec("lost", duplicate_key("no_such_view", "a")),
            spec("also_broken", "SELECT nothing FROM nowhere", severity="warning"),
        ],
    )
    rows = {r.name: r for r in report.collect()}
    assert [r.name for r in report.collect()][:2] == ["clean", "off"]
    got = {n: (r.outcome, r.violations, r.matches_expected, r.rows_match, r.gate) for n, r in rows.items()}
    assert got == {
        "clean": ("FAIL", 1, True, True, False),
        "off": ("FAIL", 2, False, False, True),
        "off_warning": ("FAIL", 2, False, False, False),
        "odd": ("DITOLAK", None, None, None, False),
        "later": ("SKIP", None, None, None, False),
        "broken": ("ERROR", None, None, None, True),
        "lost": ("ERROR", None, None, None, True),
        "also_broken": ("ERROR", None, None, None, False),
    }
    assert rows["broken"].note and rows["odd"].note


def test_topic_selects_tests(spark, views):
    assert run_dq(spark, views, [spec("a", blank("v", "a"))], topic="t1").count() == 0


def test_row_rules_of_a_view_share_a_scan(spark, views):
    rules = [spec(f"r{i}", blank("v", c)) for i, c in enumerate("abn")]
    assert plan(run_dq(spark, views, rules)).count("Scan ExistingRDD") == 1


def test_a_test_that_breaks_on_the_data_is_an_error(spark, views):
    strict = RowRule("v", lambda: F.col("n").cast("int") > 0)
    rows = {r.name: r for r in verify_dq(spark, views, [spec("strict", strict), spec("fine", blank("v", "b"))])}
    assert (rows["strict"].outcome, rows["strict"].gate) == ("ERROR", True)
    assert (rows["fine"].outcome, rows["fine"].violations) == ("FAIL", 1)
    with pytest.raises(PySparkException):
        run_dq(spark, views, [spec("strict", strict)]).collect()


def test_gate_stops_the_load(spark, views, tmp_path):
    gate = run_dq(spark, views, [spec("off", blank("v", "a"))])
    with pytest.raises(QualityGateError, match="off"):
        build_warehouse(small_shop(spark), str(tmp_path / "wh"), gate=gate)
    assert not (tmp_path / "wh").exists()


def test_standard_list():
    assert [s.topic for s in SPECS] == ["t1"] * 6 + ["t2"] * 6 + ["t3"] * 6
    for topic in ("t1", "t2", "t3"):
        mine = [s for s in SPECS if s.topic == topic]
        assert {"blocking", "warning"} == {s.severity for s in mine}
        assert any(s.expected == "fail" for s in mine) and all(s.reason for s in mine)


def test_rules_on_keys_share_the_reading_of_a_table(spark, sf_dir, monkeypatch):
    """Orders and lines are each read at most twice: once for row rules, once for counts per key."""
    import lapakdw.operators.checks as checks
    from lapakdw.plans.profile import FIRST_LOOK, PROFILES, run_profiles
    from lapakdw.sources.standin import StandinViews

    stored = []

    def kept(df, label):
        stored.append(plan(df))
        return materialize(df, label)

    monkeypatch.setattr(checks, "materialize", kept, raising=False)
    for report in (
        lambda views: run_dq(spark, views),
        lambda views: run_profiles(views, {**PROFILES, "awal": FIRST_LOOK}),
    ):
        stored.clear()
        final = plan(report(StandinViews(spark, sf_dir)))
        for table in ("orders", "lineitem"):
            scans = [t for text in (final, *stored) for t in text.splitlines() if "FileScan" in t and f"/{table}.parquet" in t]
            assert 1 <= len(scans) <= 2, table


def test_rules_together_count_as_alone(spark, views):
    """Every kind of rule on keys, nulls and missing partners included, in one grouping and by itself."""
    from lapakdw.operators.checks import count_together, distinct_values

    rules = {
        "twice": duplicate_key("v", "a"),
        "twice_both": duplicate_key("v", "a", "b"),
        "different": distinct_values("v", "a"),
        "header_twice": duplicate_key("raw_transactions", "transaction_id"),
        "headers": distinct_values("raw_transactions", "transaction_id"),
        "no_product": orphan("raw_transaction_items", "raw_products", "product_id"),
        "no_line": orphan("raw_transactions", "raw_transaction_items", "transaction_id"),
        "no_header": orphan("raw_transaction_items", "raw_transactions", "transaction_id"),
        "returns": cross_table(
            "raw_transaction_items", lambda: typed("qty", "int") < 0,
            "raw_transactions", lambda: F.upper(F.trim("status")) != "REFUND", "transaction_id",
        ),
        "all_pairs": cross_table(
            "raw_transaction_items", lambda: F.lit(True), "raw_transactions", lambda: F.lit(True), "transaction_id"
        ),
    }
    alone = {name: rule.frame(views).first()[0] for name, rule in rules.items()}
    together = {r["name"]: r["value"] for r in count_together(views, rules).collect()}
    assert together == alone and together["no_header"] == 2
    nothing = {name: df.where("false") for name, df in views.items()}
    assert {r["value"] for r in count_together(nothing, rules).collect()} == {0}


def test_one_grouping_answers_all_rules_on_keys(spark, views):
    """The shuffle holds at most one row per task and key; no table of counts is stored, and no two are joined."""
    from lapakdw.operators.checks import KeyRule, count_together

    rules = {s.name: s.rule for s in SPECS if isinstance(s.rule, KeyRule) and s.topic == "t2"}
    text = plan(count_together(views, rules))
    assert "Join" not in text and "Expand" not in text
    assert text.count("Exchange hashpartitioning(_key") == 1 and text.count("Exchange") == 2
    assert text.count("Scan ExistingRDD") == 3
