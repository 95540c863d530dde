"""Lets Python workers import this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def importable(spark: SparkSession) -> None:
    """Put the folder of the package on the path of workers started for functions made from now on.

    Enough where workers see that folder, as on one machine; a cluster gets the
    package by ``--py-files``.
    """
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([ROOT, *paths])
