"""Counts, required columns and the completeness gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: Sequence[str], table: str) -> None:
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks the columns {', '.join(missing)}")


def observed_rows(df: DataFrame, label: str) -> tuple[DataFrame, Observation]:
    """The same rows, counted as they pass; no extra pass over the data."""
    observation = Observation(label)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def dedup_report(df: DataFrame, key: Column) -> DataFrame:
    """One row: rows in all, distinct usable keys, rows a dedup removes.

    Rows with a null or empty key count as removed.
    """
    unique = F.count_distinct(F.when(key != "", key))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total_rows"),
        unique.alias("unique_keys"),
        (total - unique).alias("removed_rows"),
    )


REPORT = "dataset string, present boolean, rows long, ok boolean"


def completeness(spark: SparkSession, datasets: Mapping[str, DataFrame | None]) -> DataFrame:
    """One row per expected dataset: is it there, and how many rows has it.

    ``None`` stands for a dataset that does not exist.  All counts run as one
    job.  Rows are a stronger test than bytes: ``[]`` has bytes but no rows.
    """
    absent = [(name, False, 0, False) for name, df in datasets.items() if df is None]
    counted = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"),
            F.lit(True).alias("present"),
            "rows",
            (F.col("rows") > 0).alias("ok"),
        )
        for name, df in datasets.items()
        if df is not None
    ]
    return reduce(DataFrame.unionByName, counted, spark.createDataFrame(absent, REPORT))


PRESENCE = "dataset string, present boolean, ok boolean"


def presence(spark: SparkSession, datasets: Mapping[str, DataFrame | None]) -> DataFrame:
    """Like ``completeness`` without the row counts: looks for a first row only."""
    found = [(name, df is not None, df is not None and not df.isEmpty()) for name, df in datasets.items()]
    return spark.createDataFrame(found, PRESENCE)


class IncompleteLanding(ValueError):
    """At least one expected dataset is missing or empty."""


def gate(report: DataFrame) -> list:
    """Raise with every failing dataset named; else return the report rows.

    The report has one row per expected dataset, so collecting it is bounded.
    """
    rows = sorted(report.collect(), key=lambda row: row["dataset"])
    failures = [
        f"{row['dataset']} ({'empty' if row['present'] else 'missing'})"
        for row in rows
        if not row["ok"]
    ]
    if failures:
        raise IncompleteLanding("datasets missing or empty: " + ", ".join(failures))
    return rows
