"""Scalar expressions: durations, dates, defaults, time stamps and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def seconds(ms: Column) -> Column:
    return ms / F.lit(1000.0)


def minutes(ms: Column) -> Column:
    """Minutes; a missing duration counts as zero."""
    return F.coalesce(ms / F.lit(60000.0), F.lit(0.0))


def release_date(text: Column) -> Column:
    """Date of ``yyyy``, ``yyyy-MM`` or ``yyyy-MM-dd``; anything else is null."""
    return text.try_cast("date")


def genre_key(name: Column) -> Column:
    return F.lower(name)


def with_default(value: Column, default) -> Column:
    return F.coalesce(value, F.lit(default))


def truthy(text: Column) -> Column:
    """True for a string that is neither null nor empty, never null."""
    return text.isNotNull() & (text != "")


def iso_text(moment: Column) -> Column:
    return F.date_format(moment, ISO_FORMAT)


def iso_now() -> Column:
    return iso_text(F.current_timestamp())


def json_text(*columns: str | Column) -> Column:
    """The row as JSON text; null fields are kept as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
