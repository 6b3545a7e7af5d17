"""Scans of processing manifests and of the processed-key table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from discolake.operators.dedup import key_set
from discolake.schemas import KEYS
from discolake.sources.documents import if_present, read_stored

RETRY = "retry"


def explode_keys(manifests: DataFrame, field: str) -> DataFrame:
    """The distinct non-null keys listed in a manifest column."""
    return key_set(manifests.select(F.explode_outer(field).alias("id")), "id")


def _indented_keys(lines: DataFrame, field: str) -> DataFrame:
    """The entries of the list ``field`` of files indented by two spaces.

    Every line must be one of the few that such a file has, what is opened
    must be closed, and nothing else may be listed; anything else raises.
    Lines are counted over all files, as a long manifest may be landed in several.
    """
    value = F.col("value")
    header = F.lit(f'  "{field}": [')
    kinds = {
        "opened": value == "{",
        "closed": value == "}",
        "listed": value == header,
        "ended": value.rlike(r"^  \],?$"),
        "entry": value.rlike(r'^    ".*",?$'),
        "scalar": value.rlike(r'^  ".*": ([^\[{].*)$'),
        "none": value.rlike(r'^  ".*": \[\],?$') & value.startswith(f'  "{field}":'),
        "blank": F.trim(value) == "",
    }
    known = F.lit(False)
    for kind in kinds.values():
        known = known | kind
    counts = lines.agg(
        *(F.count_if(kinds[k]).alias(k) for k in ("opened", "closed", "listed", "ended", "none")),
        F.count_if(~known).alias("unknown"),
    )
    whole = (
        (F.col("opened") == F.col("closed")) & (F.col("listed") == F.col("ended"))
        & (F.col("listed") + F.col("none") <= F.col("opened")) & (F.col("unknown") == 0)
    )
    refusal = F.raise_error(F.lit(f"not a whole manifest of {field} indented by two spaces"))
    checked = counts.select(F.when(whole, True).otherwise(refusal).alias("ok"))
    entry = F.regexp_extract("value", r'^    (".*"),?\s*$', 1)
    listed = lines.where(checked.scalar()).select(entry.alias("entry")).where(F.col("entry") != "")
    parsed = F.from_json(F.concat(F.lit("["), "entry", F.lit("]")), "array<string>", {"mode": "FAILFAST"})[0]
    return key_set(listed.select(parsed.alias("id")), "id")


def read_manifest_keys(
    spark: SparkSession, path: str, field: str, layout: str = "indented"
) -> DataFrame:
    """The key set of a manifest file; no file or no key list gives no keys.

    ``indented`` reads a file that is indented by two spaces line by
    line, where each key of its only list has a line of its own, so many
    tasks share a long list.  ``lines`` parses one manifest per line,
    ``array`` a file of any format in one piece.  A damaged file, or for
    ``indented`` one of another shape, raises.
    """
    if layout == "indented":
        lines = if_present(spark.read.text, path)
        if lines is None:
            return spark.createDataFrame([], "id string")
        return _indented_keys(lines, field)
    schema = T.StructType([T.StructField(field, T.ArrayType(T.StringType()))])
    reader = spark.read.schema(schema).option("multiLine", layout == "array").option("mode", "FAILFAST")
    manifest = if_present(reader.json, path)
    if manifest is None:
        manifest = spark.createDataFrame([], schema)
    return explode_keys(manifest, field)


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """The processed-key table; empty before the first run."""
    return read_stored(spark, path, KEYS, format="parquet")


def settled(keys: DataFrame) -> DataFrame:
    """Keys that need no further run: every status but ``retry``."""
    return keys.where(F.col("status") != RETRY).select("id")
