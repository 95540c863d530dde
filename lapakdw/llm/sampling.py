"""Which rows a model may learn from, and bounded samples of them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Documents of this remainder are held out from all learning.
FOLDS, HELD_OUT = 4, 2


def fold(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS


def held_out(doc_id: Column) -> Column:
    """False for a missing id, which is not learnt from either."""
    return F.coalesce(fold(doc_id) == HELD_OUT, F.lit(False))


def learnable(doc_id: Column) -> Column:
    return F.coalesce(fold(doc_id) != HELD_OUT, F.lit(False))


def hash_share(key: Column, seed: int) -> Column:
    """A number from 0 up to 1 that depends on the key alone."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)
