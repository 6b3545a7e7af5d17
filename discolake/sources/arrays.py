"""JSON arrays in any format, read by many tasks.

A JSON file is cut at every closing brace, wherever it stands.  Whether a piece begins within a
string, and how deep, follows from the quotes and brackets of all pieces before it: these are summed
within the blocks of a file, then over its blocks, of which there are few.  Where a
brace closes an element of the outermost array, an element ends.  No task holds more than one
block of the file or the text between two such ends, whatever the size of the file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

BLOCK = ["file", "block"]


def _removed(text: Column, signs: str) -> Column:
    """How many of the signs a text has."""
    return F.length(text) - F.length(F.translate(text, signs, ""))


def _before(pieces: DataFrame, name: str) -> DataFrame:
    """The sum of a column over all pieces of the file before each piece, as ``<name>_before``."""
    blocks = pieces.groupBy(*BLOCK).agg(F.sum(name).alias("_sum"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_first", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))).drop("_sum")
    within = Window.partitionBy(*BLOCK).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    inside = pieces.withColumn("_inside", F.coalesce(F.sum(name).over(within), F.lit(0)))
    total = (F.col("_first") + F.col("_inside")).alias(f"{name}_before")
    return inside.join(blocks, BLOCK).select(*pieces.columns, total)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, row, value, last, lone, brace: the texts between closing braces, in order.

    lone: the file has no array.  brace: a brace is its last byte.
    """
    read = spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    place = F.struct("block", "row")
    files = read.groupBy(F.col("file").alias("_file")).agg(
        F.max(place).alias("_last"),
        F.min(F.struct("block", "row", F.left(F.regexp_replace("value", r"^\s+", ""), F.lit(1)).alias("sign"))).alias("_first"),
        (F.sum(F.octet_length("value") + 1) == F.max("size")).alias("_brace"),
    )
    known = read.join(files, F.col("file") == F.col("_file"))
    lone = F.col("_first.sign") != "["
    return known.select(
        "file", "block", "row", "value",
        (place == F.col("_last")).alias("last"), lone.alias("lone"), F.col("_brace").alias("brace"),
    )


def element_groups(spark: SparkSession, path: str) -> DataFrame:
    """file, part, text: texts of an array's elements in order, as arrays of one or a few elements.

    A lone object counts as an array of one.  A file whose quotes or brackets do not match, or whose
    elements are not parted by commas, raises.
    """
    bare = F.regexp_replace("value", r"(?s)\\.", "")
    pieces = _pieces(spark, path).withColumn("bare", bare).withColumn("quotes", _removed(F.col("bare"), '"'))
    pieces = _before(pieces, "quotes").withColumn("within", F.col("quotes_before") % 2 == 1)
    text = F.when(F.col("within"), F.concat(F.lit('"'), "bare")).otherwise(F.col("bare"))
    outside = F.regexp_replace(text, r'"[^"]*("|$)', "")
    still = (F.col("quotes_before") + F.col("quotes")) % 2 == 1
    # Whether a brace ends the last piece of a lone object shows in its depth.
    closes = ~F.col("last") & ~still
    deeper = _removed(outside, "[{") - _removed(outside, "]}") - closes.cast("int")
    pieces = pieces.withColumns({"still": still, "closes": closes, "deeper": deeper}).drop("bare", "quotes", "quotes_before", "within")
    pieces = _before(pieces, "deeper").withColumn("depth", F.col("deeper_before") + F.col("deeper"))
    closed = ~F.col("last") | (F.col("lone") & (F.col("depth") == 1))
    pieces = pieces.withColumn("closed", closed)
    ends = F.col("closes") & (F.col("depth") == F.when(F.col("lone"), 0).otherwise(1))
    stray = F.col("brace") & ~F.col("closed")
    whole = ~F.col("still") & (F.col("depth") == F.col("closed").cast("int")) & ~stray
    broken = F.raise_error(F.concat(F.lit("not a whole JSON array: "), "file"))
    pieces = pieces.withColumn("ends", F.when(F.col("last") & ~whole, broken).otherwise(ends).cast("int"))
    pieces = _before(pieces.drop("deeper", "deeper_before", "depth", "still", "closes"), "ends")
    written = F.when(F.col("closed"), F.concat("value", F.lit("}"))).otherwise(F.col("value"))
    parts = pieces.groupBy("file", F.col("ends_before").alias("part"), "lone").agg(
        F.array_sort(F.collect_list(F.struct("block", "row", written.alias("text")))).alias("texts"),
        F.bool_or("last").alias("last"),
    )
    parts = parts.withColumn("text", F.array_join(F.transform("texts", lambda t: t["text"]), "")).drop("texts")
    first = F.col("part") == 0
    # Of the first part the opening bracket goes, of the others the comma, of the last one the closing bracket.
    opened = F.when(first, F.regexp_replace("text", r"^\s*\[", "")).otherwise(F.regexp_replace("text", r"^\s*,", ""))
    body = F.when(F.col("lone"), F.col("text")).when(F.col("last"), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(opened)
    comma = F.col("text").rlike(r"^\s*,")
    empty = F.trim(F.regexp_replace(body, r"\s+", " ")) == ""
    bad = ~first & F.when(F.col("lone"), ~empty).otherwise((~comma & ~empty) | (comma & empty))
    array = F.concat(F.lit("["), body, F.lit("]"))
    return parts.where(bad | ~empty).select("file", "part", F.when(bad, broken).otherwise(array).alias("text"))
