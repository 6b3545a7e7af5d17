"""Operators that turn one row into several."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def explode_array(df: DataFrame, array: str, out: str) -> DataFrame:
    """One row per element; a null or empty array drops the row."""
    return df.withColumn(out, F.explode(array))


def split_explode(df: DataFrame, csv: str, out: str) -> DataFrame:
    """One row per comma-separated value.

    Repeats are kept; ``''`` gives one ``''`` value; null drops the row.
    """
    return df.withColumn(out, F.explode(F.split(csv, ",")))


def flatten_map(
    df: DataFrame, mapping: str, key: str = "category", entry: str = "entry", pos: str = "pos",
    keep: Sequence[str] = (),
) -> DataFrame:
    """A map of lists of structs to one row per struct.

    The map key, the position of its entry and the position in its list stay
    as columns, so that "first in the file" can be asked for later.  The outer
    explode saves the filter that Spark adds to the inner one, which evaluates
    the map again; its rows for empty maps end in the second explode.
    """
    entries = F.posexplode_outer(F.map_entries(mapping)).alias(entry, "_entry")
    listed = df.select(*keep, entries)
    item = F.posexplode("_entry.value").alias(pos, "_item")
    return listed.select(*keep, F.col("_entry.key").alias(key), entry, item).select(*keep, key, entry, pos, "_item.*")


def expand_json(
    df: DataFrame,
    text: str,
    schema: str | T.StructType,
    keep: Sequence[str] = (),
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per JSON text, its fields as columns, behind the kept columns.

    The fields come out of a generator.  A plain selection would let Spark
    push a filter on a field below it, and parse the text again for that.
    """
    parsed = F.from_json(F.col(text).cast("string"), schema, dict(options or {}))
    return df.select(*keep, F.inline(F.array(parsed)))
