"""Row filters and the counts of what they reject."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from discolake.functions.scalars import truthy


def drop_missing(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop a row when any of the keys is null.

    Spelled as ``IsNotNull`` tests, which reach the Parquet scan; the test
    that ``dropna`` makes does not.
    """
    return df.where(reduce(and_, [F.col(key).isNotNull() for key in keys]))


def with_truthy_id(df: DataFrame, struct: str, field: str = "id") -> DataFrame:
    """Keep rows whose struct carries a non-empty id."""
    return df.where(truthy(F.col(f"{struct}.{field}")))


def _verdict(item: str, required: Sequence[str]) -> tuple[Column, Column]:
    is_null = F.col(item).isNull()
    lacks = F.lit(False)
    for field in required:
        lacks = lacks | F.col(f"{item}.{field}").isNull()
    return is_null, ~is_null & lacks


def usable_items(df: DataFrame, item: str, required: Sequence[str] = ("id", "name")) -> DataFrame:
    """Keep items that are present and carry every required field."""
    is_null, lacks = _verdict(item, required)
    return df.where(~is_null & ~lacks)


def reject_counts(df: DataFrame, item: str, required: Sequence[str] = ("id", "name")) -> DataFrame:
    """One row: items in all, null items, items lacking a field, items kept."""
    is_null, lacks = _verdict(item, required)
    return df.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(is_null).alias("null_items"),
        F.count_if(lacks).alias("incomplete_items"),
        F.count_if(~is_null & ~lacks).alias("kept_items"),
    )
