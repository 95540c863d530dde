"""Source profiling: what the raw tables look like before anything is transformed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapakdw.functions.columns import is_blank, try_double, try_int
from lapakdw.operators.checks import (
    VIOLATIONS,
    KeyRule,
    Views,
    count_together,
    distinct_values,
    duplicate_key,
    listing,
    orphan,
)
from lapakdw.sources.raw import Slice, slice_views

Measure = Callable[[], Column]


@dataclass(frozen=True)
class Totals:
    """Measures over a whole table, one row. All totals of one table can share a scan."""

    table: str
    measures: dict[str, Measure]

    def frame(self, views: Views) -> DataFrame:
        return views[self.table].agg(*(make().alias(name) for name, make in self.measures.items()))


@dataclass(frozen=True)
class Listing:
    """A frame of its own; its last column is the value."""

    table: str
    build: Callable[[Views], DataFrame]

    def frame(self, views: Views) -> DataFrame:
        return self.build(views)


@dataclass(frozen=True)
class Count:
    """What follows from row counts per key; the last column is the value. All of them can share scans and a grouping."""

    table: str
    name: str
    rule: KeyRule

    def frame(self, views: Views) -> DataFrame:
        return self.rule.frame(views).withColumnRenamed(VIOLATIONS, self.name)


def rows() -> Column:
    return F.count("*")


@dataclass(frozen=True)
class Distinct:
    """Different values of a column: a measure of a scan, or a rule on the keys of that column."""

    column: str

    def __call__(self) -> Column:
        return F.count_distinct(F.col(self.column))


def distinct(column: str) -> Measure:
    return Distinct(column)


def blanks(column: str) -> Measure:
    return lambda: F.count_if(is_blank(F.col(column)))


def nulls(column: str) -> Measure:
    return lambda: F.count_if(F.col(column).isNull())


def matching(column: str, like: str) -> Measure:
    return lambda: F.count_if(F.col(column).like(like))


def not_matching(column: str, like: str) -> Measure:
    return lambda: F.count_if(~F.col(column).like(like))


def negative(column: str) -> Measure:
    return lambda: F.count_if(try_int(F.col(column)) < 0)


def outside(column: str, low: int, high: int) -> Measure:
    return lambda: F.count_if((try_int(F.col(column)) > high) | (try_int(F.col(column)) < low))


def zero(column: str) -> Measure:
    return lambda: F.count_if(try_double(F.col(column)) == 0)


def least_int(column: str, dtype: str) -> Measure:
    return lambda: F.min(try_int(F.col(column), dtype))


def greatest_int(column: str, dtype: str) -> Measure:
    return lambda: F.max(try_int(F.col(column), dtype))


def least(column: str) -> Measure:
    return lambda: F.min(column)


def at_offset(local: str, utc: str, seconds: int) -> Measure:
    """Rows whose local time is exactly ``seconds`` ahead of the UTC time."""

    def make() -> Column:
        gap = F.col(local).try_cast("timestamp_ntz") - F.col(utc).try_cast("timestamp_ntz")
        return F.count_if(gap == F.make_dt_interval(secs=F.lit(float(seconds))))

    return make


def repeated(table: str, name: str, *keys: str) -> Count:
    return Count(table, name, duplicate_key(table, *keys))


def unmatched(child: str, parent: str, key: str, name: str) -> Count:
    """Rows of ``child`` without a row of ``parent`` under the same key."""
    return Count(child, name, orphan(child, parent, key))


def frequencies(table: str, names: dict[str, str]) -> Count:
    """Rows per combination of columns, most frequent first."""
    return Count(table, "baris", listing(table, names))


# Seconds by which the standard profile expects local time to be ahead of UTC.
WIB_SECONDS = 7 * 3600

# The measures of the three topics, in the order and under the
# names of the published profiles.
PROFILES: dict[str, list[Totals | Listing | Count]] = {
    "t1": [
        Totals("raw_mahasiswa", {"baris": rows, "nim_unik": distinct("nim")}),
        repeated("raw_mahasiswa", "nim_duplikat", "nim"),
        Totals("raw_mahasiswa", {"angkatan_kosong": blanks("angkatan"), "varian_status": distinct("status")}),
        Totals("raw_presensi", {"baris": rows, "nim_null": nulls("nim")}),
        repeated("raw_presensi", "duplikat_grain", "nim", "kode_mk", "tanggal"),
        Totals(
            "raw_presensi",
            {"tanggal_format_lain": matching("tanggal", "__/__/____"), "varian_status": distinct("status")},
        ),
        Totals("raw_nilai", {"nilai_luar_rentang": outside("nilai_angka", 0, 100)}),
    ],
    "t2": [
        Totals("raw_transactions", {"baris": rows, "id_unik": distinct("transaction_id")}),
        repeated("raw_transactions", "id_duplikat", "transaction_id"),
        Totals(
            "raw_transactions",
            {"timestamp_utc": matching("tanggal_waktu", "%Z"), "varian_status": distinct("status")},
        ),
        unmatched("raw_transactions", "raw_transaction_items", "transaction_id", "tanpa_item"),
        Totals("raw_transaction_items", {"qty_negatif": negative("qty"), "baris": rows}),
        unmatched("raw_transaction_items", "raw_products", "product_id", "fk_orphan"),
        Totals("raw_products", {"varian_harga": distinct("harga_satuan"), "produk": rows}),
    ],
    "t3": [
        Totals("raw_prakiraan_cuaca", {"baris": rows, "desa": distinct("adm4")}),
        Totals("raw_prakiraan_cuaca", {"vs_kosong": blanks("vs")}),
        Totals("raw_prakiraan_cuaca", {"tp_nol": zero("tp"), "baris": rows}),
        frequencies("raw_prakiraan_cuaca", {"weather": "kode", "weather_desc": "deskripsi"}),
        Totals(
            "raw_prakiraan_cuaca",
            {"time_index_contoh": least("time_index"), "analysis_date_unik": distinct("analysis_date")},
        ),
        Totals(
            "raw_prakiraan_cuaca",
            {
                "baris_selisih_7jam": at_offset("local_datetime", "utc_datetime", WIB_SECONDS),
                "baris": rows,
            },
        ),
        Totals("raw_desa", {"desa": rows, "kecamatan": distinct("kecamatan")}),
    ],
}

# The six general questions asked of the sales extract before it is loaded.
FIRST_LOOK: list[Totals | Listing | Count] = [
    Totals("raw_transactions", {"baris": rows, "id_unik": distinct("transaction_id")}),
    Totals("raw_transactions", {"customer_kosong": blanks("customer_id"), "outlet_kosong": blanks("outlet_id")}),
    repeated("raw_transaction_items", "duplikat", "transaction_id", "product_id"),
    Totals(
        "raw_transaction_items",
        {
            "qty_min": least_int("qty", "int"),
            "qty_max": greatest_int("qty", "int"),
            "harga_min": least_int("harga_satuan", "bigint"),
            "harga_max": greatest_int("harga_satuan", "bigint"),
        },
    ),
    frequencies("raw_transactions", {"status": "status"}),
    Totals(
        "raw_transactions",
        {"utc_tanpa_zona": matching("tanggal_waktu", "%Z"), "waktu_lokal": not_matching("tanggal_waktu", "%Z")},
    ),
]


Asked = tuple[str, int]  # topic and position of a question


def _name(asked: Asked, table: str, metric: str) -> str:
    return f"{asked[0]}|{asked[1]}|{table}|{metric}"


def _named(frame: DataFrame, metric: Column | None = None) -> DataFrame:
    """Rows of (_name, nilai) as metric rows; ``metric`` replaces the metric's name where it is not null."""
    part = F.split("_name", "[|]")
    return frame.select(
        part[0].alias("topik"),
        part[1].cast("int").alias("urutan"),
        part[2].alias("tabel"),
        (part[3] if metric is None else F.coalesce(metric, part[3])).alias("metrik"),
        F.col("nilai").cast("string").alias("nilai"),
    )


def _scan(views: Views, table: str, measures: dict[str, Measure]) -> DataFrame:
    """All measures of one table in one scan, one row per measure. Equal measures are computed once."""
    counted = views[table].agg(*(make().cast("string").alias(name) for name, make in measures.items()))
    return _named(counted.unpivot([], [F.col(f"`{name}`") for name in measures], "_name", "nilai"))


def _label(labels: list[Column], values: list[Column]) -> Column:
    return F.concat_ws("|", *(F.concat(k, F.lit("="), F.coalesce(v, F.lit("NULL"))) for k, v in zip(labels, values)))


def _together(views: Views, rules: dict[str, KeyRule]) -> DataFrame:
    """All rules on keys as metric rows. The labels of a listed key become the metric's name."""
    metric = F.lit(None).cast("string")
    for name, rule in rules.items():
        if rule.labels:
            values = [F.col("labels")[i] for i in range(len(rule.labels))]
            metric = F.when(F.col("name") == name, _label([F.lit(k) for k in rule.labels], values)).otherwise(metric)
    counted = count_together(views, rules).select(
        F.col("name").alias("_name"), F.col("value").alias("nilai"), metric.alias("_metric")
    )
    return _named(counted, F.col("_metric"))


def _rows_of(frame: DataFrame, asked: Asked, listing: Listing | Count) -> DataFrame:
    """A listing as metric rows: the leading columns become the metric's name."""
    *keys, value = frame.columns
    label = _label([F.lit(k) for k in keys], [F.col(k) for k in keys])
    return frame.select(
        F.lit(asked[0]).alias("topik"),
        F.lit(asked[1]).alias("urutan"),
        F.lit(listing.table).alias("tabel"),
        (label if keys else F.lit(value)).alias("metrik"),
        F.col(value).cast("string").alias("nilai"),
    )


def run_profiles(views: Views, topics: dict[str, list[Totals | Listing | Count]]) -> DataFrame:
    """Profiles as rows of (topik, urutan, tabel, metrik, nilai); ``urutan`` numbers a topic's questions from 1.

    Each table is scanned once for all totals that any topic asks of it, and
    once for everything that follows from row counts per key. Numbers of
    different values are taken from the keys of tables that are read for keys
    anyway, so that no totals multiply the rows of such a table.
    """
    asked = [((topic, i), q) for topic, questions in topics.items() for i, q in enumerate(questions, start=1)]
    totals: dict[str, dict[str, Measure]] = {}
    rules: dict[str, KeyRule] = {}
    frames = []
    for place, question in asked:
        if isinstance(question, Count) and question.rule.joins_others(views):
            rules[_name(place, question.table, question.name)] = question.rule
        elif not isinstance(question, Totals):
            frames.append(_rows_of(question.frame(views), place, question))
    read_for_keys = {count.view for rule in rules.values() for count in rule.counts}
    for place, question in asked:
        for name, make in question.measures.items() if isinstance(question, Totals) else ():
            table = question.table
            if isinstance(make, Distinct) and table in read_for_keys:
                rule = distinct_values(table, make.column)
                if rule.joins_others(views):
                    rules[_name(place, table, name)] = rule
                    continue
            totals.setdefault(table, {})[_name(place, table, name)] = make
    if rules:
        frames.append(_together(views, rules))
    frames.extend(_scan(views, table, measures) for table, measures in totals.items())
    return reduce(DataFrame.unionByName, frames)


def run_profile(
    views: Views, queries: str | list[Totals | Listing | Count], part: str | Slice | None = None
) -> DataFrame:
    """The profile of one topic, or of a list of questions, as rows of (urutan, tabel, metrik, nilai).

    ``part`` restricts the views to a slice.
    """
    if part is not None:
        views = slice_views(views, part)
    asked = PROFILES[queries] if isinstance(queries, str) else queries
    return run_profiles(views, {"": asked}).drop("topik")


def write_profile(profile: DataFrame, path: str) -> None:
    """The profile as JSON lines."""
    profile.write.mode("overwrite").json(path)
