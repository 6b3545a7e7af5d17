"""Helpers for keys that hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Copies of a key that may reach a join after thinning.
SLICES = 64


def thin(keys: DataFrame, key: str, slices: int = SLICES) -> DataFrame:
    """The key column with at most ``slices`` copies of each key.

    For the right side of a semi or anti join, where copies do not change the
    answer.  Unlike ``distinct`` it leaves the join to shuffle this side
    itself, which adaptive execution needs in order to split a hot partition
    of the left side.
    """
    return (
        keys.select(key)
        .where(F.col(key).isNotNull())
        .withColumn("_slice", F.spark_partition_id() % slices)
        .distinct()
        .select(key)
    )
