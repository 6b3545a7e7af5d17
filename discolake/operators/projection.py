"""Selecting, renaming and deriving columns of tables whose columns vary."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_renamed(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select ``source path -> output name``; a path may reach into structs."""
    return df.select([F.col(source).alias(out) for source, out in names.items()])


def select_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Keep the listed columns that exist, in list order."""
    return df.select([name for name in names if name in df.columns])


def with_optional(
    df: DataFrame,
    name: str,
    source: str,
    derive: Callable[[Column], Column],
    missing: str | None = "string",
) -> DataFrame:
    """Add ``derive(source)``, or a null of type ``missing`` without the source.

    With ``missing=None`` an absent source adds nothing.
    """
    if source in df.columns:
        return df.withColumn(name, derive(F.col(source)))
    if missing is None:
        return df
    return df.withColumn(name, F.lit(None).cast(missing))
