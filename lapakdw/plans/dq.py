"""Declarative data-quality tests: a count of violations, a severity and an expected outcome each."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lapakdw.functions.columns import code, try_int
from lapakdw.operators.checks import (
    VIOLATIONS,
    KeyRule,
    RowRule,
    Views,
    blank,
    count_together,
    cross_table,
    domain,
    duplicate_key,
    fd_violation,
    orphan,
    pattern,
    typed,
    value_range,
)
from lapakdw.runtime import literal_rows
from lapakdw.sources.raw import Slice, slice_views

SEVERITIES = ("blocking", "warning")
PASS, FAIL, SKIP, ERROR, REJECTED = "PASS", "FAIL", "SKIP", "ERROR", "DITOLAK"


@dataclass(frozen=True)
class DqSpec:
    """One test. ``rule`` is a rule, or SQL text over the registered views that returns one number."""

    name: str
    topic: str
    severity: str
    expected: str
    expected_rows: int
    rule: RowRule | KeyRule | str
    reason: str = ""
    scope: str = "source"
    needs_warehouse: bool = False


def _above_or_negative(limit):
    return lambda value: (value > limit) | (value < 0)


# The standard tests. Names, topics, severities, expected outcomes
# and row counts are those of the published test list.
SPECS = [
    DqSpec("nim_duplikat", "t1", "warning", "pass", 0,
           duplicate_key("raw_mahasiswa", "nim"),
           "one student number must mean one person"),
    DqSpec("presensi_duplikat_grain", "t1", "blocking", "fail", 4344,
           duplicate_key("raw_presensi", "nim", "kode_mk", "tanggal"),
           "repeated attendance rows double the attendance"),
    DqSpec("tanggal_presensi_format_lain", "t1", "blocking", "fail", 5812,
           pattern("raw_presensi", "tanggal", "__/__/____"),
           "dd/mm/yyyy texts do not parse as ISO dates"),
    DqSpec("nilai_di_luar_rentang", "t1", "blocking", "fail", 2,
           value_range("raw_nilai", lambda: typed("nilai_angka", "int"), _above_or_negative(100)),
           "grades run from 0 to 100"),
    DqSpec("status_presensi_di_luar_domain", "t1", "warning", "fail", 11819,
           domain("raw_presensi", "status", ("HADIR", "H", "IZIN", "SAKIT", "ALPA")),
           "attendance codes need one spelling before they are counted"),
    DqSpec("mahasiswa_angkatan_kosong", "t1", "blocking", "fail", 62,
           blank("raw_mahasiswa", "angkatan"),
           "slices are made by cohort"),
    DqSpec("transaction_id_duplikat", "t2", "blocking", "fail", 219,
           duplicate_key("raw_transactions", "transaction_id"),
           "repeated header ids count revenue twice"),
    DqSpec("item_fk_orphan", "t2", "blocking", "fail", 1,
           orphan("raw_transaction_items", "raw_products", "product_id"),
           "lines without a product need the Unknown member"),
    DqSpec("timestamp_utc_tanpa_zona", "t2", "warning", "fail", 2389,
           pattern("raw_transactions", "tanggal_waktu", "%Z"),
           "UTC and local times share a column"),
    DqSpec("transaksi_tanpa_item", "t2", "warning", "fail", 158,
           orphan("raw_transactions", "raw_transaction_items", "transaction_id"),
           "headers without lines never reconcile"),
    DqSpec("qty_negatif_bukan_refund", "t2", "warning", "fail", 621,
           cross_table(
               "raw_transaction_items", lambda: typed("qty", "int") < 0,
               "raw_transactions", lambda: code(F.col("status")) != "REFUND",
               "transaction_id",
           ),
           "a negative quantity is a return"),
    DqSpec("harga_satuan_tidak_positif", "t2", "blocking", "pass", 0,
           value_range("raw_transaction_items", lambda: typed("harga_satuan", "bigint"), lambda v: v <= 0),
           "zero or negative prices spoil every revenue figure"),
    DqSpec("duplikat_grain_desa_slot", "t3", "blocking", "pass", 0,
           duplicate_key("raw_prakiraan_cuaca", "adm4", "local_datetime"),
           "one forecast per village and slot"),
    DqSpec("curah_hujan_negatif", "t3", "blocking", "pass", 0,
           value_range("raw_prakiraan_cuaca", lambda: typed("tp", "double"), lambda v: v < 0),
           "rainfall is never negative"),
    DqSpec("kolom_vs_kosong_seluruhnya", "t3", "warning", "fail", 1156,
           blank("raw_prakiraan_cuaca", "vs"),
           "an empty column should be dropped or filled"),
    DqSpec("deskripsi_cuaca_dipakai_lebih_dari_satu_kode", "t3", "warning", "fail", 1,
           fd_violation("raw_prakiraan_cuaca", "weather_desc", "weather"),
           "a description shared by codes cannot be a key"),
    DqSpec("curah_hujan_nol_tidak_wajar", "t3", "warning", "fail", 812,
           value_range("raw_prakiraan_cuaca", lambda: typed("tp", "double"), lambda v: v == 0),
           "mostly dry slots make rainfall a poor only measure"),
    DqSpec("time_index_sebagai_jam", "t3", "warning", "fail", 625,
           value_range(
               "raw_prakiraan_cuaca",
               lambda: try_int(F.split_part(F.col("time_index"), F.lit("-"), F.lit(1))),
               lambda v: v > 23,
           ),
           "the index is an offset in hours, not a clock time"),
]


def check(spark: SparkSession, views: Views, spec: DqSpec) -> DataFrame:
    """The number of violations of one test: one row, column ``violations``."""
    if isinstance(spec.rule, str):
        number = spark.sql(spec.rule)
        return number.select(number[0].cast("bigint").alias(VIOLATIONS))
    return spec.rule.frame(views).select(F.col(VIOLATIONS).cast("bigint").alias(VIOLATIONS))


_LISTED = {
    "position": "int",
    "name": "string",
    "topic": "string",
    "severity": "string",
    "expected": "string",
    "expected_rows": "bigint",
    "preset": "string",
    "note": "string",
}


def _message(error: Exception) -> str:
    """Kind of the error and the first line of what it says, whole."""
    said = str(error).strip().splitlines()
    return f"{type(error).__name__}: {said[0]}" if said else type(error).__name__


def _folded(views: Views, view: str, specs: list[DqSpec]) -> DataFrame:
    """All row rules on one view in one scan, as (name, violations)."""
    counted = views[view].agg(*(s.rule.count().alias(s.name) for s in specs))
    names = [F.col(f"`{s.name}`") for s in specs]
    return counted.unpivot([], names, "name", VIOLATIONS)


def _counts(
    spark: SparkSession, views: Views, specs: list[DqSpec]
) -> tuple[list[DataFrame], dict[str, str]]:
    """Frames of (name, violations), and messages of tests that could not be planned."""
    frames: list[DataFrame] = []
    errors: dict[str, str] = {}
    by_view: dict[str, list[DqSpec]] = {}
    alone = [s for s in specs if not isinstance(s.rule, RowRule)]
    for spec in specs:
        if isinstance(spec.rule, RowRule):
            by_view.setdefault(spec.rule.view, []).append(spec)
    for view, group in by_view.items():
        try:
            frames.append(_folded(views, view, group))
        except (PySparkException, KeyError):
            alone.extend(group)
    together: dict[str, KeyRule] = {}
    for spec in alone:
        try:
            # Rules that work key by key go on together.
            if isinstance(spec.rule, KeyRule) and spec.rule.measure is not None and spec.rule.joins_others(views):
                together[spec.name] = spec.rule
            else:
                frames.append(check(spark, views, spec).select(F.lit(spec.name).alias("name"), VIOLATIONS))
        except (PySparkException, KeyError) as error:
            errors[spec.name] = _message(error)
    if together:
        frames.append(count_together(views, together).select("name", F.col("value").alias(VIOLATIONS)))
    return frames, errors


def run_dq(
    spark: SparkSession,
    views: Views,
    specs: Iterable[DqSpec] = SPECS,
    topic: str | None = None,
    has_warehouse: bool = False,
    failed: Mapping[str, str] | None = None,
    part: str | Slice | None = None,
) -> DataFrame:
    """One report row per test.

    Row rules on one view share a scan, and rules on keys of any views another
    scan of each and one grouping. A test with an unknown severity is rejected,
    one that needs a missing warehouse is skipped, and one that cannot run is an
    error. ``gate`` marks
    blocking tests that did not come out as expected or could not run.
    ``failed`` names tests already known to fail at run time. ``part`` restricts
    the views to a slice; tests that are SQL text read the registered views whole.
    """
    if part is not None:
        views = slice_views(views, part)
    chosen = [s for s in specs if topic is None or s.topic == topic]
    outcome: dict[str, str] = {}
    note: dict[str, str] = dict(failed or {})
    for spec in chosen:
        if spec.severity not in SEVERITIES:
            outcome[spec.name], note[spec.name] = REJECTED, "unknown severity"
        elif spec.needs_warehouse and not has_warehouse:
            outcome[spec.name], note[spec.name] = SKIP, "needs the warehouse"
        elif spec.name in note:
            outcome[spec.name] = ERROR
    frames, errors = _counts(spark, views, [s for s in chosen if s.name not in outcome])
    outcome.update(dict.fromkeys(errors, ERROR))
    note.update(errors)

    rows = [
        (i, s.name, s.topic, s.severity, s.expected, s.expected_rows, outcome.get(s.name), note.get(s.name))
        for i, s in enumerate(chosen)
    ]
    listed = literal_rows(spark, _LISTED, rows)
    if frames:
        # At most one row per test.
        counts = reduce(DataFrame.unionByName, frames)
        listed = listed.join(F.broadcast(counts), "name", "left")
    else:
        listed = listed.withColumn(VIOLATIONS, F.lit(None).cast("bigint"))
    found = F.when(F.col(VIOLATIONS) > 0, FAIL).when(F.col(VIOLATIONS).isNotNull(), PASS)
    report = listed.withColumn("outcome", F.coalesce("preset", found)).withColumn(
        "matches_expected",
        F.when(F.col("outcome").isin(PASS, FAIL), F.lower("outcome") == F.col("expected")),
    )
    stops = (F.col("outcome") == ERROR) | F.coalesce(~F.col("matches_expected"), F.lit(False))
    return report.select(
        "name",
        "topic",
        "severity",
        VIOLATIONS,
        "outcome",
        "expected",
        "matches_expected",
        "expected_rows",
        (F.col(VIOLATIONS) == F.col("expected_rows")).alias("rows_match"),
        ((F.col("severity") == "blocking") & stops).alias("gate"),
        "note",
    ).orderBy("position")


def verify_dq(
    spark: SparkSession,
    views: Views,
    specs: Iterable[DqSpec] = SPECS,
    topic: str | None = None,
    has_warehouse: bool = False,
    part: str | Slice | None = None,
) -> list[Row]:
    """Run the tests and return the report rows, one per test.

    Tests that are SQL text may well break on the data and are tried one by one
    first. The standard rules cannot break, so all others run once, together;
    only if a rule of one's own breaks that run are the rules tried alone too.
    """
    specs = list(specs)
    failed: dict[str, str] = {}

    def try_alone(texts: bool) -> None:
        for spec in specs:
            if isinstance(spec.rule, str) == texts and spec.name not in failed:
                try:
                    run_dq(spark, views, [spec], topic, has_warehouse, part=part).collect()
                except PySparkException as error:
                    failed[spec.name] = _message(error)

    try_alone(texts=True)
    try:
        return run_dq(spark, views, specs, topic, has_warehouse, failed, part).collect()
    except PySparkException:
        try_alone(texts=False)
        return run_dq(spark, views, specs, topic, has_warehouse, failed, part).collect()
