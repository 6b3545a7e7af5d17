"""Parquet sinks: new files are staged and checked before the old ones go."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.sinks.staging import Check, replace


def overwrite(df: DataFrame, path: str, check: Check | None = None) -> int:
    """Replace a table and return its rows; the rows may be read from the table itself."""
    return replace(df, path, check=check)


def overwrite_by_year(df: DataFrame, path: str, date: str = "release_date", check: Check | None = None) -> int:
    """Overwrite, partitioned by the year of ``date``; null dates stand apart.

    One folder per day would make thousands of small files.  The date itself
    stays a column, so day filters still reach the row groups.
    """
    year = f"{date.removesuffix('_date')}_year"
    return overwrite_partitioned(df.withColumn(year, F.year(date)), path, [year], check)


def overwrite_partitioned(df: DataFrame, path: str, by: Sequence[str], check: Check | None = None) -> int:
    """Overwrite, hive-partitioned by the given columns.

    Rebalancing brings the rows of one folder together, so that a folder does
    not get a file from every task, and splits a folder that is too large for
    one task.
    """
    return replace(df.hint("rebalance", *by), path, by=by, check=check)


def replace_date(
    df: DataFrame, table: str, ingest_date: str, format: str = "parquet", check: Check | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Replace one ingest date of a table and return the rows written; other dates stay.

    ``check`` gets the row count before the old files go; if it raises they stay.
    """
    return replace(df, f"{table}/ingest_date={ingest_date}", format, check=check, options=options)
