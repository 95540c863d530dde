"""Session settings, the shared scratch folder, and measured-size broadcasts."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MB = 1024 * 1024

# Largest lookup side, in raw bytes, that is sent to every executor. Far less
# than what a shuffle of the fact would move, and little enough for an executor.
BROADCAST_BYTES = 256 * MB

# Compressed input per shuffle partition. Rows are several times larger in a
# shuffle, and ten times and more where a task sorts or groups them in memory.
PARTITION_BYTES = 8 * MB

# Default for the most shuffle partitions of a load: 1.6 TB of input at that size.
MAX_PARTITIONS = 200_000

# Input per step of the size that adaptive execution aims at.
TARGET_SHARE = 50_000

# Size adaptive execution aims at, for partitions and written files: Spark's
# default for ordinary inputs, up to the largest for very large ones.
TARGET_BYTES, MAX_TARGET_BYTES = 64 * MB, 512 * MB

_local_scratch: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def session(app: str = "lapakdw", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings this package is tested under."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def sql_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Apply SQL settings for the jobs started inside the block, then put the old ones back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def scan_bytes(*frames: DataFrame) -> int:
    """Bytes of the files behind the frames, as known to the planner without a job.

    Sources of unknown size, for which the planner assumes the largest number
    there is, do not count.
    """
    unknown = 2**63 - 1
    total = 0
    for frame in frames:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
        total += sum(size for size in sizes if size < unknown)
    return total


def shuffle_settings(
    spark: SparkSession, *frames: DataFrame, max_partitions: int = MAX_PARTITIONS
) -> dict[str, str]:
    """Settings for a large load over ``frames``.

    The partition count follows the input, because adaptive execution can only
    merge shuffle partitions, never add them, and it may not merge below that
    count either: by bytes alone it would put so many rows into a task that its
    sorts and groupings spill. The size it splits towards grows with the input
    too, so that a large table is not written as millions of small files. Skewed
    join partitions are split even where that costs another shuffle behind the
    join. A count or size chosen by the user is left alone. ``max_partitions``
    bounds the count; beyond it partitions grow. The settings hold for the whole
    session while they are applied.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }
    size = scan_bytes(*frames)
    target = min(size // TARGET_SHARE, MAX_TARGET_BYTES)
    aim = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if target > TARGET_BYTES and spark.conf.get(aim) in (f"{TARGET_BYTES}b", "64MB"):
        settings[aim] = str(target)
    parts = min(-(-size // PARTITION_BYTES), max_partitions)
    chosen = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if spark.conf.get(chosen, None) is None:
        base = int(spark.conf.get("spark.sql.shuffle.partitions"))
        settings[chosen] = str(max(base, parts))
    kept = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    if parts > spark.sparkContext.defaultParallelism and spark.conf.get(kept, None) is None:
        settings[kept] = str(parts)
    return settings


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    ``spark.checkpoint.dir`` (or the context's checkpoint folder) is used as the
    cluster names it. Only a local master may fall back to a machine folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="lapakdw-")
    return _local_scratch[app]


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh path under the scratch folder, remembered for ``clear_scratch``."""
    path = f"{scratch_root(spark)}/lapakdw-{label}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of any file system that Spark reaches; one that is not there is fine."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def scratch_paths(spark: SparkSession) -> list[str]:
    """All scratch tables this application has made and not removed, the newest last."""
    return list(_made.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, keep: Iterable[str] = ()) -> int:
    """Remove the scratch tables this application made, but those in ``keep``; frames that read them end with them."""
    kept = set(keep)
    app = spark.sparkContext.applicationId
    paths = _made.pop(app, [])
    for path in paths:
        if path not in kept:
            delete(spark, path)
    if left := [path for path in paths if path in kept]:
        _made[app] = left
    return len(paths) - len(left)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the scratch folder and read it back.

    Cuts the lineage at shared storage, so the rows (and any partition ids in
    them) stay the same however often later stages are rerun.
    """
    path = new_scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_rows(spark: SparkSession, schema: dict[str, str], rows: list[tuple]) -> DataFrame:
    """A small fixed table: rows of texts, numbers and booleans under column names and types."""
    struct = ", ".join(f"{name}: {dtype}" for name, dtype in schema.items())
    text = json.dumps([dict(zip(schema, row)) for row in rows])
    parsed = F.from_json(F.lit(text), f"array<struct<{struct}>>")
    return spark.range(0, 1, 1, 1).select(F.inline(parsed))


def row_bytes(df: DataFrame) -> Column:
    """Size of a row in memory terms: fixed widths plus actual string lengths."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    width = F.lit(8 * len(df.columns) + 8 * len(texts)).cast("long")
    for name in texts:
        width = width + F.coalesce(F.octet_length(name), F.lit(0))
    return width


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows. One job."""
    return df.agg(F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()["bytes"]


def fits_broadcast(size: int) -> bool:
    return size <= BROADCAST_BYTES


def broadcast_up_to_limit(df: DataFrame, size: int) -> DataFrame:
    """Mark a lookup side of known size for broadcast, or leave it to the planner."""
    return F.broadcast(df) if fits_broadcast(size) else df


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Measure a lookup side and mark it for broadcast when its size allows."""
    return broadcast_up_to_limit(df, measured_bytes(df))
