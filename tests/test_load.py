from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lapakdw import registry
from lapakdw.plans.fact import FACT, fact_transaksi_item
from lapakdw.plans.load import (
    build_warehouse,
    compare_counts,
    load_counts,
    load_idempotency,
    warehouse_integrity,
    write_append,
    write_full,
)
from lapakdw.plans.warehouse import MONTH, TABLES, YEAR, ConcurrentLoadError, Warehouse, partition_columns
from lapakdw.runtime import PARTITION_BYTES, clear_scratch, materialize, scan_bytes, scratch_paths, shuffle_settings
from tests.helpers import plan, small_shop

FACT_ROWS = 7


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return build_warehouse(small_shop(spark), str(tmp_path_factory.mktemp("wh")))


def content(wh: Warehouse) -> dict[str, tuple]:
    """Rows and an order-free hash of every table."""
    return {
        name: tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first())
        for name in TABLES
        for df in [wh.table(name)]
    }


def test_counts(stored):
    assert {r.table: r.rows for r in load_counts(stored).collect()} == {
        "dim_date": 1462,
        "dim_product": 5,
        "dim_outlet": 3,
        "dim_status_transaksi": 6,
        FACT: FACT_ROWS,
    }


def test_rebuild_gives_the_same_content(spark, stored, tmp_path):
    path = str(tmp_path / "wh")
    first = content(build_warehouse(small_shop(spark), path))
    assert first == content(stored)
    assert content(build_warehouse(small_shop(spark), path)) == first


def test_small_ranges_build_the_same_warehouse(spark, stored, tmp_path):
    assert content(build_warehouse(small_shop(spark), str(tmp_path / "wh"), range_rows=2)) == content(stored)


def test_large_dimensions_are_joined_by_shuffle_with_the_same_result(
    spark, stored, tmp_path, monkeypatch, sql_settings
):
    monkeypatch.setattr("lapakdw.runtime.BROADCAST_BYTES", -1)
    sql_settings(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1")
    fact = fact_transaksi_item(small_shop(spark), stored.dims)
    assert plan(fact).count("SortMergeJoin") == 2  # headers (stored with their outlets), products
    assert content(build_warehouse(small_shop(spark), str(tmp_path / "wh"))) == content(stored)


def test_idempotency_report(spark, tmp_path):
    full = load_idempotency(lambda: build_warehouse(small_shop(spark), str(tmp_path / "full")))
    assert {r.idempotent for r in full.collect()} == {True}
    appended = load_idempotency(
        lambda: build_warehouse(small_shop(spark), str(tmp_path / "append"), write=write_append)
    )
    rows = {r.table: (r.run_1, r.run_2, r.idempotent) for r in appended.collect()}
    assert rows["dim_status_transaksi"] == (6, 12, False)
    assert rows["dim_outlet"] == (3, 6, False)
    # The second run also meets every dimension row twice, so a line doubles
    # for every dimension it finds: all four for T1 and T2, two for T3 and T7, three for T6.
    assert rows[FACT] == (FACT_ROWS, FACT_ROWS + 4 * 16 + 4 + 8 + 4, False)


def test_compare_counts_sees_missing_tables(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "table string, rows long")
    two = spark.createDataFrame([("a", 1), ("c", 3)], "table string, rows long")
    rows = {r.table: (r.run_1, r.run_2, r.idempotent) for r in compare_counts(one, two).collect()}
    assert rows == {"a": (1, 1, True), "b": (2, None, False), "c": (None, 3, False)}


def test_integrity(spark, stored):
    assert tuple(warehouse_integrity(stored.table(FACT)).first()) == (FACT_ROWS, 0, True, True, True)
    undated = stored.table(FACT).withColumn("date_sk", F.lit(None).cast("int"))
    assert tuple(warehouse_integrity(undated).first()) == (FACT_ROWS, FACT_ROWS, True, False, True)
    assert tuple(warehouse_integrity(undated.where("false")).first()) == (0, 0, False, True, True)
    assert tuple(warehouse_integrity(stored).first()) == (FACT_ROWS, 0, True, True, True)
    assert tuple(warehouse_integrity(Warehouse(spark, "/tmp/no/such/warehouse")).first()) == (None, None, False, False, False)


def test_a_failed_load_leaves_the_old_warehouse(spark, stored, tmp_path, monkeypatch):
    path = str(tmp_path / "wh")
    before = content(build_warehouse(small_shop(spark), path))

    def broken(*args, **kwargs):
        raise RuntimeError("no fact today")

    monkeypatch.setattr("lapakdw.plans.load.fact_transaksi_item", broken)
    with pytest.raises(RuntimeError, match="no fact today"):
        build_warehouse(small_shop(spark), path)
    assert content(Warehouse(spark, path)) == before
    monkeypatch.undo()
    assert content(build_warehouse(small_shop(spark), path)) == before
    wh = Warehouse(spark, path)
    assert len(wh.commits()) == 2 and len(versions(path)) == 2  # what the failed load wrote is gone
    assert wh.vacuum() and len(wh.commits()) == 1 and len(versions(path)) == 1
    assert content(Warehouse(spark, path)) == before


def versions(path):
    return sorted(p.name for p in Path(path).glob("v-*"))


def test_a_failed_append_changes_nothing(spark, tmp_path, monkeypatch):
    """The fact comes last; without it the four dimensions that were written do not count either."""
    path = str(tmp_path / "wh")
    before = {r.table: r.rows for r in load_counts(build_warehouse(small_shop(spark), path)).collect()}

    def broken(df, folder, partition_by=()):
        if folder.endswith(FACT):
            raise RuntimeError("disk full")
        write_append(df, folder, partition_by)

    def append(write):
        monkeypatch.setattr("lapakdw.plans.load.write_append", write)
        return build_warehouse(small_shop(spark), path, write=write)

    with pytest.raises(RuntimeError, match="disk full"):
        append(broken)
    assert {r.table: r.rows for r in load_counts(Warehouse(spark, path)).collect()} == before
    assert len(versions(path)) == 1
    after = {r.table: r.rows for r in load_counts(append(write_append)).collect()}
    assert all(after[name] >= 2 * before[name] for name in TABLES)
    assert {r.table: r.rows for r in load_counts(Warehouse(spark, path, commit=1)).collect()} == before


def test_a_frame_opened_before_a_reload_still_reads(spark, tmp_path):
    path = str(tmp_path / "wh")
    opened = build_warehouse(small_shop(spark), path).table(FACT)
    first = sorted(map(tuple, opened.collect()))
    build_warehouse(small_shop(spark), path, first_day="2020-01-01")
    assert sorted(map(tuple, opened.collect())) == first
    build_warehouse(small_shop(spark), path)  # the first of three commits goes
    assert len(versions(path)) == 2 and sorted(Warehouse(spark, path).commits()) == [2, 3]
    build_warehouse(small_shop(spark), path, keep=1)
    assert len(versions(path)) == 1 and sorted(Warehouse(spark, path).commits()) == [4]


def test_commits_that_are_not_whole_do_not_count(spark, tmp_path):
    path = str(tmp_path / "wh")
    wh = build_warehouse(small_shop(spark), path)
    (tmp_path / "wh" / "_commits" / "00000002.json").write_text('{"tables": {"dim_date"')
    assert Warehouse(spark, path).commit == 1
    assert build_warehouse(small_shop(spark), path).commit == 3
    assert content(Warehouse(spark, path)) == content(wh)


def test_a_load_that_missed_a_commit_fails(spark, tmp_path):
    path = str(tmp_path / "wh")
    slow = Warehouse(spark, path).begin(whole=True)
    build_warehouse(small_shop(spark), path)
    with pytest.raises(ConcurrentLoadError):
        slow.finish()


def test_what_a_dead_load_left_goes_by_age(spark, tmp_path):
    path = str(tmp_path / "wh")
    wh = build_warehouse(small_shop(spark), path)
    write_append(spark.range(3), wh.begin(whole=True).location("dim_date"))
    assert len(versions(path)) == 2 and wh.vacuum(abandoned_hours=1) == []
    assert len(wh.vacuum(abandoned_hours=-1)) == 1 and len(versions(path)) == 1
    assert load_counts(Warehouse(spark, path)).count() == 5


def test_tables_without_commits_are_taken_over_by_an_append(spark, stored, tmp_path):
    bare = Warehouse(spark, str(tmp_path / "bare"))
    for name in TABLES:
        write_append(stored.table(name), bare.location(name))
    assert content(bare) == content(Warehouse(spark, bare.path))
    wh = build_warehouse(small_shop(spark), bare.path, write=write_append)
    assert wh.table("dim_outlet").count() == 6 and wh.table(FACT).count() > FACT_ROWS


def test_calendar_from_the_data_covers_every_day(spark, tmp_path):
    shop = small_shop(spark)
    wh = build_warehouse(shop, str(tmp_path / "wh"), calendar=None)
    years = [r.tahun for r in wh.dims.date.select("tahun").distinct().orderBy("tahun").collect()]
    assert years == [1900, *range(2025, 2032)]
    assert wh.table(FACT).where("date_sk = -1").count() == 0
    assert wh.table(FACT).where("date_sk = 20310101").count() == 1


def test_scratch_can_be_cleared(spark):
    path = materialize(spark.range(3).toDF("n"), "gone").inputFiles()[0]
    assert clear_scratch(spark) > 0
    assert not Path(path.removeprefix("file://")).exists()
    assert clear_scratch(spark) == 0


def test_partitions_follow_the_calendar(stored):
    fact, dates = stored.table(FACT), stored.dims.date
    off = fact.join(dates, "date_sk").where((F.col(YEAR) != F.col("tahun")) | (F.col(MONTH) != F.col("bulan")))
    assert off.count() == 0
    assert fact.where(F.col("date_sk") == -1).select(YEAR, MONTH).distinct().collect() == [(1900, 0)]


def test_partition_columns_of_every_day(stored):
    dates = stored.dims.date
    off = dates.withColumns(partition_columns(F.col("date_sk"))).where("p_tahun <> tahun OR p_bulan <> bulan")
    assert off.count() == 0


def test_year_filter_prunes_files(stored):
    text = plan(stored.table(FACT).where(F.col(YEAR) == 2025).select("qty"))
    assert "PartitionFilters: [isnotnull(p_tahun" in text
    assert "ReadSchema: struct<qty:int>" in text


def test_register(spark, stored):
    stored.register("wh_")
    assert spark.sql(f"SELECT count(*) FROM wh_{FACT} JOIN wh_dim_date USING (date_sk)").first()[0] == FACT_ROWS


def test_partition_count_follows_the_input(spark, stored, monkeypatch):
    fact = stored.table(FACT)
    assert scan_bytes(fact) > 0
    assert shuffle_settings(spark, fact)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "4"
    monkeypatch.setattr("lapakdw.runtime.scan_bytes", lambda *frames: 1000 * PARTITION_BYTES)
    assert shuffle_settings(spark, fact)["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "1000"
    monkeypatch.setattr("lapakdw.runtime.scan_bytes", lambda *frames: 10**15)
    large = shuffle_settings(spark, fact)
    assert large["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "200000"
    few = shuffle_settings(spark, fact, max_partitions=700)
    assert few["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == "700"
    assert large["spark.sql.adaptive.advisoryPartitionSizeInBytes"] == str(512 * 1024 * 1024)


def test_partitions_are_small_enough_to_sort_in_memory(spark, stored, monkeypatch, sql_settings):
    """The size of shuffled bytes alone must not merge partitions until their rows spill."""
    fact, kept = stored.table(FACT), "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    assert kept not in shuffle_settings(spark, fact)  # a small input
    monkeypatch.setattr("lapakdw.runtime.scan_bytes", lambda *frames: 2**30)
    settings = shuffle_settings(spark, fact)
    assert int(settings[kept]) == int(settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"]) >= 128
    assert shuffle_settings(spark, fact, max_partitions=50)[kept] == "50"
    sql_settings(**{kept: "7"})
    assert kept not in shuffle_settings(spark, fact)


def test_rewriting_the_fact_keeps_partitions_small(spark, sf_dir, monkeypatch):
    kept, seen = "spark.sql.adaptive.coalescePartitions.minPartitionNum", []
    registry.warehouse(spark, sf_dir)
    monkeypatch.setattr("lapakdw.runtime.scan_bytes", lambda *frames: 2**30)
    plain = write_full
    monkeypatch.setattr("lapakdw.plans.load.write_full", lambda *a: (seen.append(spark.conf.get(kept, None)), plain(*a)))
    found = registry.queries()["write_full"](spark, sf_dir)
    assert len(seen) == 2 and all(int(n or 0) >= 128 for n in seen)
    assert found.agg(F.sum("rows")).first()[0] == registry.warehouse(spark, sf_dir).table(FACT).count()


def test_sources_of_unknown_size_do_not_count(spark):
    assert scan_bytes(small_shop(spark).items) == 0


def test_chosen_partition_count_is_left_alone(spark, stored, sql_settings):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    sql_settings(**{key: "33"})
    assert key not in shuffle_settings(spark, stored.table(FACT))


def test_scratch_can_be_cleared_but_for_some(spark):
    clear_scratch(spark)
    kept, gone = (materialize(spark.range(3).toDF("n"), label) for label in ("kept", "gone"))
    first, last = scratch_paths(spark)
    assert clear_scratch(spark, keep=[first]) == 1 and scratch_paths(spark) == [first]
    assert kept.count() == 3 and not Path(gone.inputFiles()[0].removeprefix("file://")).exists()
