"""Scans of Parquet tables kept by ingest date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_date(spark: SparkSession, table: str, ingest_date: str) -> DataFrame:
    """One ingest date of a table; no other date is listed or opened."""
    return spark.read.option("basePath", table).parquet(f"{table}/ingest_date={ingest_date}")
