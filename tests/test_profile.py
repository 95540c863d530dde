import json

import pytest

from lapakdw.functions.columns import is_blank, round_half, to_int, try_int, yes
from lapakdw.plans import profile as p
from pyspark.sql import functions as F
from tests.helpers import plan, small_shop, texts


@pytest.fixture(scope="module")
def views(spark):
    shop = small_shop(spark)
    weather = texts(
        spark,
        ["adm4", "vs", "tp", "weather", "weather_desc", "time_index", "analysis_date", "local_datetime", "utc_datetime"],
        [
            ("1", None, "0", "0", "Cerah", "11-12", "2025-01-01", "2025-01-01 07:00:00", "2025-01-01 00:00:00"),
            ("1", "", "0.0", "1", "Cerah", "9-10", "2025-01-01", "2025-01-01 08:00:00", "2025-01-01 00:00:00"),
            ("2", "5", "x", "1", "Cerah", "12-13", "2025-01-02", "bad", "2025-01-01 00:00:00"),
        ],
    )
    return {
        "raw_transactions": shop.transactions,
        "raw_transaction_items": shop.items,
        "raw_products": shop.products,
        "raw_prakiraan_cuaca": weather,
        "raw_desa": texts(spark, ["kode", "kecamatan"], [("1", "A"), ("2", "A"), ("3", "B")]),
    }


def test_sales_profile(views):
    found = {(r.urutan, r.tabel, r.metrik): r.nilai for r in p.run_profile(views, "t2").collect()}
    assert found == {
        (1, "raw_transactions", "baris"): "11",
        (1, "raw_transactions", "id_unik"): "8",
        (2, "raw_transactions", "id_duplikat"): "3",
        (3, "raw_transactions", "timestamp_utc"): "1",
        (3, "raw_transactions", "varian_status"): "5",
        (4, "raw_transactions", "tanpa_item"): "1",
        (5, "raw_transaction_items", "qty_negatif"): "1",
        (5, "raw_transaction_items", "baris"): "12",
        (6, "raw_transaction_items", "fk_orphan"): "1",
        (7, "raw_products", "varian_harga"): "4",
        (7, "raw_products", "produk"): "4",
    }


def test_weather_profile(views):
    found = {(r.urutan, r.metrik): r.nilai for r in p.run_profile(views, "t3").collect()}
    assert found == {
        (1, "baris"): "3",
        (1, "desa"): "2",
        (2, "vs_kosong"): "2",
        (3, "tp_nol"): "2",
        (3, "baris"): "3",
        (4, "kode=1|deskripsi=Cerah"): "2",
        (4, "kode=0|deskripsi=Cerah"): "1",
        (5, "time_index_contoh"): "11-12",
        (5, "analysis_date_unik"): "2",
        (6, "baris_selisih_7jam"): "1",
        (6, "baris"): "3",
        (7, "desa"): "3",
        (7, "kecamatan"): "2",
    }


def test_offset_is_a_parameter(views):
    question = p.Totals("raw_prakiraan_cuaca", {"n": p.at_offset("local_datetime", "utc_datetime", 8 * 3600)})
    assert question.frame(views).first().n == 1


def test_first_look(views):
    found = {(r.urutan, r.metrik): r.nilai for r in p.run_profile(views, p.FIRST_LOOK).collect()}
    assert found[(2, "customer_kosong")] == "2" and found[(2, "outlet_kosong")] == "2"
    assert found[(3, "duplikat")] == "1"
    assert (found[(4, "qty_min")], found[(4, "qty_max")]) == ("-1", "3")
    assert found[(4, "harga_max")] == "10001"  # 10000.50 rounds away from zero
    assert found[(5, "status=PAID")] == "6"
    assert (found[(6, "utc_tanpa_zona")], found[(6, "waktu_lokal")]) == ("1", "10")


def test_totals_of_a_table_share_a_scan(views):
    totals = [q for q in p.PROFILES["t3"] if isinstance(q, p.Totals) and q.table == "raw_prakiraan_cuaca"]
    assert len(totals) == 5
    assert plan(p.run_profile(views, totals)).count("Scan ExistingRDD") == 1


def test_json_sink(views, tmp_path):
    path = tmp_path / "profile"
    p.write_profile(p.run_profile(views, "t2"), str(path))
    lines = [json.loads(t) for f in path.glob("*.json") for t in f.read_text().splitlines()]
    assert {"urutan": 2, "tabel": "raw_transactions", "metrik": "id_duplikat", "nilai": "3"} in lines


@pytest.mark.parametrize(
    "text, number",
    [("12.5", 13), ("-12.5", -13), ("1e2", 100), (" 5 ", 5), (".5", 1), ("-0.5", -1), ("12.4999", 12),
     ("abc", None), ("", None), (None, None), ("99999999999", None)],
)
def test_whole_numbers_from_text(spark, text, number):
    df = spark.range(1).select(F.lit(text).cast("string").alias("t"))
    assert df.select(try_int(F.col("t"))).first()[0] == number
    if number is not None:
        assert df.select(to_int(F.col("t"))).first()[0] == number


def test_rounding_scales_first(spark):
    cases = [(1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (12.34, 1, 12.3)]
    for value, digits, expected in cases:
        assert spark.range(1).select(round_half(F.lit(value), digits)).first()[0] == expected


def test_blank_and_yes(spark):
    df = texts(spark, ["t"], [(None,), ("",), (" ",), ("Ya ",), ("tidak",)])
    assert [r[0] for r in df.select(is_blank(F.col("t"))).collect()] == [True, True, False, False, False]
    assert [r[0] for r in df.select(yes(F.col("t"))).collect()] == [False, False, False, True, False]


def test_keys_are_counted_without_multiplying_rows(spark, sf_dir):
    """Different values of a key are counted on its groups: no rows are multiplied for them, no table is read more than twice."""
    from lapakdw.sources.standin import StandinViews

    text = plan(p.run_profiles(StandinViews(spark, sf_dir), {"t2": p.PROFILES["t2"], "awal": p.FIRST_LOOK}))
    assert "gid" not in text  # what Spark calls the copy a row is for
    assert not any("Expand" in t and "|" not in t for t in text.splitlines())  # but of the totals, one row each
    for table in ("orders", "lineitem"):
        assert sum("FileScan" in t and f"/{table}.parquet" in t for t in text.splitlines()) == 2


def test_listings_beside_totals_of_nothing(spark):
    """A profile of empty tables has all its totals, as zeros, and lists no keys."""
    empty = {"raw_transactions": texts(spark, ["status", "transaction_id"], [])}
    questions = [
        p.frequencies("raw_transactions", {"status": "status"}),
        p.repeated("raw_transactions", "id_duplikat", "transaction_id"),
        p.Totals("raw_transactions", {"baris": p.rows, "varian_status": p.distinct("status")}),
    ]
    found = {(r.urutan, r.metrik): r.nilai for r in p.run_profile(empty, questions).collect()}
    assert found == {(2, "id_duplikat"): "0", (3, "baris"): "0", (3, "varian_status"): "0"}


def test_keys_that_are_no_texts_are_counted_alone(spark):
    numbers = {"raw_transactions": spark.createDataFrame([(1, "a"), (1, "b"), (None, "b")], "n int, status string")}
    questions = [p.repeated("raw_transactions", "n_duplikat", "n"), p.frequencies("raw_transactions", {"status": "status"})]
    found = {(r.urutan, r.metrik): r.nilai for r in p.run_profile(numbers, questions).collect()}
    assert found == {(1, "n_duplikat"): "1", (2, "status=b"): "2", (2, "status=a"): "1"}
