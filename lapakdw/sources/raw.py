"""Raw sources: header-named CSV files, every column text, and named slices of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapakdw.functions.columns import business_date

HEADER_COLUMNS = ["transaction_id", "outlet_id", "customer_id", "tanggal_waktu", "status", "total_bayar"]
ITEM_COLUMNS = ["transaction_id", "item_id", "product_id", "qty", "harga_satuan", "diskon"]
PRODUCT_COLUMNS = ["product_id", "nama_produk", "kategori", "harga_satuan", "harga_berlaku_dari", "aktif"]
OUTLET_COLUMNS = ["outlet_id", "nama_outlet", "kota", "tipe", "aktif", "dibuka_sejak"]


class RawFormatError(ValueError):
    """A raw file that cannot be read line by line."""


# Longest field, in characters, of a file that is read as a whole.
MOST_FIELD_CHARS = 10_000_000


def _files(spark: SparkSession, paths: list[str]) -> list[tuple[str, int, bool]]:
    """Name, bytes and whether tasks can share it, of every file that Spark would read under the paths."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    found = []
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        files = path.getFileSystem(conf)
        for status in files.globStatus(path) or ():
            inner = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            for file in inner:
                if file.isFile() and not file.getPath().getName().startswith(("_", ".")):
                    found.append((file.getPath().toString(), file.getLen(), codecs.getCodec(file.getPath()) is None))
    return found


def _odd_lines(lines: DataFrame) -> DataFrame:
    """Lines with an odd number of quotes: one stays open, or is an inch mark."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.where(quotes % 2 == 1)


def _closed(df: DataFrame) -> DataFrame:
    """The rows of files read as a whole, with an error where a quote seems to have taken in further records.

    A quote that is never closed runs to the end of its file. Unless it is in
    the last column, fields are missing then, which is an error of its own.
    """
    if len(df.columns) < 2:
        return df
    last = F.col(f"`{df.columns[-1]}`")
    swallowed = F.coalesce(F.contains(last, F.lit("\n")) & last.rlike(f"\n([^\n]*,){{{len(df.columns) - 1}}}"), F.lit(False))
    message = F.concat(F.lit("a quote stays open before "), F.substring(last, 1, 80), F.lit("; read it with multiline=True"))
    return df.where(F.when(swallowed, F.raise_error(message).cast("boolean")).otherwise(True))


def read_raw(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    multiline: bool | None = None,
    check_quotes: bool = True,
) -> DataFrame:
    """CSV with a header row, every column text, blank fields NULL.

    The first header names the columns; types are never guessed. Rows with too
    few or too many fields, and files whose header differs, are errors when the
    rows are read. ``columns`` keeps a subset.

    Line breaks inside quoted fields are found unasked. A file no larger than a
    task's share (``spark.sql.files.maxPartitionBytes``), and a compressed one,
    is read by one task in any case, and so as a whole, in one pass; an error
    tells of quotes that seem to take in further records. Of larger files a pass
    looks for lines with an odd number of quotes first: those that have some are
    read as a whole, the others by many tasks, line by line. ``multiline=True``
    reads every file as a whole; ``multiline=False`` reads every file line by
    line and makes lines with an open quote an error, which ``check_quotes``
    looks for first and can be switched off for files known to be sound.
    """
    paths = [path] if isinstance(path, str) else list(path)
    reader = spark.read.option("header", True).option("escape", '"')
    names = reader.option("multiLine", multiline is not False).option("inferSchema", False).csv(paths).schema
    strict = reader.option("enforceSchema", False).option("mode", "FAILFAST").option("columnPruning", False)
    strict = strict.option("maxCharsPerColumn", MOST_FIELD_CHARS).schema(names)

    def read(files: list[str], whole: bool) -> DataFrame:
        return strict.option("multiLine", whole).csv(files)

    if multiline is None:
        setting = spark.conf.get("spark.sql.files.maxPartitionBytes")
        share = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)
        listed = _files(spark, paths)
        whole = [name for name, size, splits in listed if size <= share or not splits]
        large = [name for name, size, splits in listed if size > share and splits]
        if large and check_quotes:
            odd = _odd_lines(spark.read.text(large).select("value", "_metadata.file_path"))
            broken = {row["file_path"] for row in odd.select("file_path").distinct().collect()}
            whole += [name for name in large if name in broken]
            large = [name for name in large if name not in broken]
        parts = ([_closed(read(whole, True))] if whole else []) + ([read(large, False)] if large else [])
        df = reduce(DataFrame.unionByName, parts) if parts else read(paths, False)
    else:
        broken = None if multiline or not check_quotes else _odd_lines(spark.read.text(paths)).first()
        if broken is not None:
            raise RawFormatError(f"a quote stays open in line {broken['value'][:80]!r}; read it with multiline=True")
        df = read(paths, multiline)
    return df if columns is None else df.select(*columns)


def view_name(file_name: str) -> str:
    return "raw_" + file_name.removesuffix(".csv")


def register_raw(spark: SparkSession, folder: str, multiline: bool | None = None) -> list[str]:
    """Make every ``<stem>.csv`` of a folder (a file, or a folder of parts) the view ``raw_<stem>``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    names = sorted(status.getPath().getName() for status in found)
    views = []
    for name in names:
        if name.endswith(".csv"):
            read_raw(spark, f"{folder.rstrip('/')}/{name}", multiline=multiline).createOrReplaceTempView(view_name(name))
            views.append(view_name(name))
    return views


@dataclass(frozen=True)
class RawSales:
    """The four raw tables a warehouse load reads."""

    transactions: DataFrame
    items: DataFrame
    products: DataFrame
    outlets: DataFrame

    @classmethod
    def from_csv(cls, spark: SparkSession, folder: str, multiline: bool | None = None) -> RawSales:
        root = folder.rstrip("/")

        def read(name: str) -> DataFrame:
            return read_raw(spark, f"{root}/{name}.csv", multiline=multiline)

        return cls(
            transactions=read("transactions"),
            items=read("transaction_items"),
            products=read("products"),
            outlets=read("outlets"),
        )


@dataclass(frozen=True)
class Slice:
    """A named part of a topic's data. Fields that are not set do not restrict."""

    topic: str
    label: str
    cohort: str | None = None
    outlets: tuple[str, ...] = ()
    start: str | None = None
    end: str | None = None


# The named slices. ``end`` is exclusive.
SLICES = {
    "k4": Slice("t1", "Angkatan 2024", cohort="2024"),
    "k5": Slice("t1", "Angkatan 2023", cohort="2023"),
    "k7": Slice("t1", "Angkatan 2022", cohort="2022"),
    "k8": Slice("t2", "Outlet A+B+C, 12 bulan", outlets=("OUT-A", "OUT-B", "OUT-C")),
    "k9": Slice("t2", "Outlet A saja, 6 bulan", outlets=("OUT-A",), start="2025-01-01", end="2025-07-01"),
    "k1": Slice("t3", "Kota Bogor (Jawa Barat)"),
    "k2": Slice("t3", "Kota Semarang (Jawa Tengah)"),
    "k3": Slice("t3", "Kota Makassar (Sulawesi Selatan)"),
    "k6": Slice("t3", "Kota Denpasar (Bali)"),
}


def slice_filter(df: DataFrame, which: str | Slice) -> DataFrame:
    """Rows of ``df`` inside a slice; conditions on columns the table lacks count as true."""
    part = SLICES[which] if isinstance(which, str) else which
    if part.cohort is not None and "angkatan" in df.columns:
        df = df.where(F.col("angkatan") == part.cohort)
    if part.outlets and "outlet_id" in df.columns:
        df = df.where(F.col("outlet_id").isin(*part.outlets))
    if "tanggal_waktu" in df.columns:
        day = business_date(F.col("tanggal_waktu"))
        if part.start is not None:
            df = df.where(day >= F.lit(part.start).cast("date"))
        if part.end is not None:
            df = df.where(day < F.lit(part.end).cast("date"))
    return df


def slice_sales(raw: RawSales, which: str | Slice) -> RawSales:
    """The slice applied to the tables it names: headers and outlets. Items follow through the join."""
    return RawSales(
        transactions=slice_filter(raw.transactions, which),
        items=raw.items,
        products=raw.products,
        outlets=slice_filter(raw.outlets, which),
    )


def slice_views(views: Mapping[str, DataFrame], which: str | Slice) -> dict[str, DataFrame]:
    """Every view restricted to a slice, as far as it has the columns that the slice names.

    Slices of the weather topic are folders of their own (``register_raw`` of
    ``<topic>/<slice>``) and restrict nothing here.
    """
    return {name: slice_filter(views[name], which) for name in views}
