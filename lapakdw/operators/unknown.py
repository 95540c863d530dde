"""Unknown members of dimensions."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN_SK = -1


def with_unknown(df: DataFrame, member: dict[str, Any]) -> DataFrame:
    """Append one literal row; it must name every column of the dimension."""
    row = df.sparkSession.range(0, 1, 1, 1).select(
        *(F.lit(member[f.name]).cast(f.dataType).alias(f.name) for f in df.schema.fields)
    )
    return df.unionByName(row)
