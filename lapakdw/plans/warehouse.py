"""The stored warehouse: five Parquet tables under one folder, and the commits that say what they consist of.

Every load writes to a folder of its own, ``v-...``, which holds its part of
each table. A commit is a small numbered file under ``_commits`` that lists the
parts of every table: those of this load alone after a full load, those of the
commit before as well after an appended one. The commit with the highest number
counts, so a load is there as a whole or not at all, and nothing has to be
renamed. A commit file that is not whole does not count.

What older commits list stays until ``vacuum`` removes it, so frames opened
before a load can still be read after it. A folder without commits holds the
tables themselves.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapakdw.operators.unknown import UNKNOWN_SK
from lapakdw.plans.dims import Span, calendar_span, day_columns
from lapakdw.plans.fact import FACT, Dims
from lapakdw.runtime import broadcast_if_small, delete

DIM_DATE, DIM_PRODUCT, DIM_OUTLET, DIM_STATUS = "dim_date", "dim_product", "dim_outlet", "dim_status_transaksi"

COMMITS = "_commits"

# In the order they have to be built.
TABLES = [DIM_DATE, DIM_PRODUCT, DIM_OUTLET, DIM_STATUS, FACT]

# Partition columns of the stored fact: calendar year and month of ``date_sk``.
YEAR, MONTH = "p_tahun", "p_bulan"


def partition_columns(date_sk: Column) -> dict[str, Column]:
    """Year and month of a date key, as the date dimension has them (1900 and 0 for Unknown)."""
    known = date_sk != UNKNOWN_SK
    return {
        YEAR: F.when(known, F.floor(date_sk / 10000)).otherwise(1900).cast("int"),
        MONTH: F.when(known, F.floor(date_sk / 100) % 100).otherwise(0).cast("int"),
    }


@dataclass(frozen=True)
class Star:
    """A fact and its dimensions, the small ones marked for broadcast.

    ``span`` is that of a calendar that has every day of it once; it need not be joined.
    """

    fact: DataFrame
    date: DataFrame
    outlet: DataFrame
    status: DataFrame
    span: Span | None = None

    @classmethod
    def of(cls, fact: DataFrame, dims: Dims) -> Star:
        """The status dictionary is small by construction; the calendar is looked at, the outlets are measured."""
        span = calendar_span(dims.date)
        dates = dims.date if span is not None else broadcast_if_small(dims.date)
        return cls(fact, dates, broadcast_if_small(dims.outlet), F.broadcast(dims.status), span)

    def dated(self) -> DataFrame:
        """Fact lines with day, year, quarter, month and weekend of their date key; keys without a day drop out."""
        if self.span is not None:
            key = F.col("date_sk")
            return self.fact.where(self.span.holds(key)).withColumns(day_columns(key))
        return self.fact.join(
            self.date.select("date_sk", "full_date", "tahun", "triwulan", "bulan", "akhir_pekan"), "date_sk"
        )


class ConcurrentLoadError(RuntimeError):
    """Another load was committed while this one ran."""


class Warehouse:
    def __init__(self, spark: SparkSession, path: str, commit: int | None = None):
        """The tables of the newest commit under ``path``, or of the one with the given number."""
        self.spark = spark
        self.path = path.rstrip("/")
        commits = self.commits()
        if commit is not None and commit not in commits:
            raise ValueError(f"no commit {commit} in {self.path}")
        self.commit = max(commits, default=None) if commit is None else commit
        self.parts: dict[str, list[str]] = commits.get(self.commit, {})
        self.staged: str | None = None

    def _files(self, name: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path, files = self._files(folder)
        return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []

    def _numbers(self) -> list[int]:
        return [int(name.removesuffix(".json")) for name in self._names(COMMITS) if name.endswith(".json")]

    def commits(self) -> dict[int, dict[str, list[str]]]:
        """The parts of every table by commit number. Files that are not whole are left out."""
        found = {}
        for number in self._numbers():
            path, files = self._files(f"{COMMITS}/{number:08d}.json")
            stream = files.open(path)
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            try:
                found[number] = json.loads(text)["tables"]
            except (ValueError, KeyError):
                continue
        return found

    def begin(self, whole: bool) -> Warehouse:
        """The warehouse as a load sees it: its own parts, and unless it is a full load those that are there."""
        load = Warehouse(self.spark, self.path)
        if whole:
            load.parts = {}
        elif load.commit is None:
            load.parts = {name: [name] for name in TABLES if load.has(name)}
        load.staged = f"v-{uuid.uuid4().hex}"
        return load

    def location(self, name: str) -> str:
        """Where a load writes its part of a table; without a load, the folder of the table itself."""
        return f"{self.path}/{self.staged}/{name}" if self.staged else f"{self.path}/{name}"

    def add(self, name: str) -> None:
        """Count the part that was written as part of the table, in this load's eyes."""
        self.parts[name] = [*self.parts.get(name, []), f"{self.staged}/{name}"]

    def finish(self) -> None:
        """Commit the load: one new file, which must not be there yet."""
        number = max(self._numbers(), default=0) + 1
        newest = max(self.commits(), default=None)
        path, files = self._files(f"{COMMITS}/{number:08d}.json")
        if newest != self.commit or files.exists(path):
            raise ConcurrentLoadError(f"{self.path} has a commit {newest} that this load has not seen")
        out = files.create(path, False)
        out.write(bytearray(json.dumps({"tables": self.parts}).encode()))
        out.close()
        self.commit = number

    def abandon(self) -> None:
        """Remove what the load has written."""
        delete(self.spark, f"{self.path}/{self.staged}")

    def vacuum(self, keep: int = 1, abandoned_hours: float | None = None) -> list[str]:
        """Remove the commits before the newest ``keep``, and folders that only they list; returns the folders.

        Folders that no commit lists belong to a load that runs or has died;
        they go if they were last changed more than ``abandoned_hours`` ago.
        Frames over removed folders cannot be read any more.
        """
        commits = self.commits()
        kept = sorted(commits)[-max(keep, 1) :]

        def folders(numbers: Iterable[int]) -> set[str]:
            return {part.split("/")[0] for n in numbers for parts in commits[n].values() for part in parts if "/" in part}

        gone = folders(set(commits) - set(kept)) - folders(kept)
        for number in self._numbers():
            if kept and number < kept[0]:
                delete(self.spark, f"{self.path}/{COMMITS}/{number:08d}.json")
        if abandoned_hours is not None:
            oldest = time.time() - 3600 * abandoned_hours
            for name in self._names(""):
                path, files = self._files(name)
                unlisted = name.startswith("v-") and name not in folders(commits)
                if unlisted and files.getFileStatus(path).getModificationTime() / 1000 < oldest:
                    gone.add(name)
        for name in sorted(gone):
            delete(self.spark, f"{self.path}/{name}")
        return sorted(gone)

    def _folders(self, name: str) -> list[str]:
        return self.parts.get(name) or [name]

    def has(self, name: str) -> bool:
        return all(files.exists(path) for path, files in map(self._files, self._folders(name)))

    def table(self, name: str) -> DataFrame:
        parts = [self.spark.read.parquet(f"{self.path}/{part}") for part in self._folders(name)]
        return reduce(DataFrame.unionByName, parts)

    def register(self, prefix: str = "") -> None:
        """Make every table a temporary view."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(prefix + name)

    @cached_property
    def dims(self) -> Dims:
        return Dims(
            date=self.table(DIM_DATE),
            product=self.table(DIM_PRODUCT),
            outlet=self.table(DIM_OUTLET),
            status=self.table(DIM_STATUS),
        )

    @cached_property
    def star(self) -> Star:
        return Star.of(self.table(FACT), self.dims)
