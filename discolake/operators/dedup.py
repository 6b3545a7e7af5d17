"""Keep-first deduplication, key sets and appends."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from discolake.operators.ranking import first_n_per_parent


def keep_first(
    df: DataFrame, keys: str | Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """The first row of each key under ``order``, which must fix all ties.

    Spark keeps one row per key and input partition before the shuffle, so a
    key with very many copies does not gather in one task.
    """
    return first_n_per_parent(df, keys, order, 1)


def key_set(df: DataFrame, column: str, out: str = "id") -> DataFrame:
    """The distinct non-null values of a column."""
    return df.select(F.col(column).alias(out)).where(F.col(out).isNotNull()).distinct()


def union_pages(*pages: DataFrame) -> DataFrame:
    """Bag union by column name; a column missing in a page is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), pages)


def new_rows(
    candidates: DataFrame, stored: DataFrame, key: str, order: Sequence[str | Column]
) -> DataFrame:
    """The first candidate of each key that is not stored yet.

    The deduplicated candidates and the distinct stored keys are both
    partitioned by the key already, so the anti join adds no shuffle.
    """
    first = keep_first(candidates.where(F.col(key).isNotNull()), key, order)
    return first.join(key_set(stored, key, key), key, "left_anti")


def append_new(
    stored: DataFrame, candidates: DataFrame, key: str, order: Sequence[str | Column]
) -> DataFrame:
    """Stored rows followed by the new rows, in the stored columns."""
    fresh = new_rows(candidates, stored, key, order)
    kept = [name for name in stored.columns if name in fresh.columns]
    return union_pages(stored, fresh.select(kept))
