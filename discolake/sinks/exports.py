"""Exports: CSV, JSON documents and copies of table trees."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from discolake.sinks.tables import overwrite_partitioned

CSV = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def export_csv(df: DataFrame, folder: str) -> None:
    """CSV files with a header line each, one per task.

    Quotes are doubled and blanks kept, as standard CSV readers expect.  A
    null is an empty field, an empty text is ``""``.
    """
    df.write.mode("overwrite").options(**CSV).csv(folder)


def export_tables(spark: SparkSession, source: str, target: str, tables: Sequence[str]) -> None:
    """Copy every date of the named tables, keeping the folder tree."""
    for table in tables:
        rows = spark.read.option("mergeSchema", True).parquet(f"{source}/{table}")
        overwrite_partitioned(rows, f"{target}/{table}", ["ingest_date"])


def write_documents(df: DataFrame, folder: str, **options: str) -> None:
    """One JSON document per line; null fields are kept as null.  ``options`` such as ``PACKED`` are the writer's."""
    df.write.mode("overwrite").option("ignoreNullFields", False).options(**options).json(folder)
