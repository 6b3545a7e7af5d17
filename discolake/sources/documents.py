"""Scans of JSON documents.

A file may hold its documents in one of four layouts:

``array``     one JSON array, formatted in any way; one task reads the file,
              which may have up to 2 GB.  A file that does not parse, or a
              document that repeats a key, raises.  Texts are written anew:
              keys are sorted and numbers normalised (``1.50`` is ``1.5``).
``indented``  one JSON array indented by two spaces, as the crawlers write it.
              The text is cut at the boundaries between top-level elements,
              so one large file is read by many tasks.
``any``       one JSON array, formatted in any way; many tasks share the file,
              of any size (see ``sources.arrays``), at the price of shuffling its
              text.  Otherwise as ``array``.
``lines``     one document per line, as the landing step writes it.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from discolake.operators.generators import expand_json
from discolake.schemas import CATEGORY_MAP
from discolake.sources.arrays import element_groups

# Fixed by the two-space layout.  A line break inside a JSON string is always
# escaped, so these sequences occur nowhere but between top-level elements.
ELEMENT_BOUNDARY = "\n  },\n  {"
CATEGORY_BOUNDARY = "\n  ],\n"

CORRUPT = "_corrupt"
ORD = "ord"


def _position(row: Column) -> Column:
    """Where a document stands in its file; sorts in file order."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        row.cast("long").alias("row"),
    ).alias(ORD)


def _array_elements(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """The elements of an array in any format; a lone object counts as one.

    The JSON reader is not used here: one null element makes it give a single
    empty row for the whole file.
    """
    whole = spark.read.text(path, wholetext=True).where(F.trim("value") != "")
    listed = F.when(F.col("value").rlike(r"^\s*\{"), F.concat(F.lit("["), "value", F.lit("]")))
    where = [_position(F.lit(0))] if ordered else []
    return _exploded(whole.select(F.coalesce(listed, "value").alias("value"), *where), ordered)


def _shared_elements(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """The elements of an array in any format, from texts of a few elements each."""
    place = F.struct("file", F.col("part").alias("block"), F.lit(0).cast("long").alias("row")).alias(ORD)
    groups = element_groups(spark, path).select(F.col("text").alias("value"), *([place] if ordered else []))
    return _exploded(groups, ordered)


def _exploded(arrays: DataFrame, ordered: bool) -> DataFrame:
    """One row per element of the array texts ``value``."""
    elements = F.from_json("value", "array<variant>", {"mode": "FAILFAST"})
    items = arrays.select(elements.alias("elements"), *([ORD] if ordered else []))
    # The outer form: for the inner one Spark adds a filter that parses again.
    exploded = F.posexplode_outer("elements").alias("pos", "element")
    items = items.select(exploded, *([ORD] if ordered else [])).where(F.col("pos").isNotNull())
    if ordered:
        items = items.withColumn(ORD, F.col(ORD).withField("row", F.col("pos").cast("long")))
    return items.withColumn("value", F.to_json("element")).drop("pos", "element")


def _indented_chunks(spark: SparkSession, path: str, ordered: bool = False) -> DataFrame:
    """The elements of an array indented by two spaces, as written."""
    chunks = spark.read.option("lineSep", ELEMENT_BOUNDARY).text(path)
    if ordered:
        chunks = chunks.select("value", _position(F.monotonically_increasing_id()))
    body = F.regexp_replace(F.regexp_replace("value", r"^\s*\[\n  \{", ""), r"\n  \}\n\]\s*$", "")
    # Inside a document every line is indented by four spaces or more.
    foreign = body.rlike(r"^\s*\[|\n {0,3}\S")
    refusal = F.raise_error(F.lit("not an array indented by two spaces; read it as layout 'array'"))
    text = F.when(foreign, refusal).otherwise(F.concat(F.lit("{"), body, F.lit("\n  }")))
    empty = F.col("value").rlike(r"^\s*(\[\s*\]\s*)?$")
    return chunks.where(~empty).withColumn("value", text)


SCANS = {"array": _array_elements, "any": _shared_elements, "indented": _indented_chunks}


def element_texts(spark: SparkSession, path: str, layout: str) -> DataFrame:
    """One row per document with its unparsed JSON ``value`` on one line."""
    if layout == "lines":
        return spark.read.text(path).where(F.trim("value") != "")
    if layout == "indented":
        chunks = _indented_chunks(spark, path)
        return chunks.withColumn("value", F.regexp_replace("value", r"\n *", ""))
    if layout in ("array", "any"):
        return SCANS[layout](spark, path)
    raise ValueError(f"unknown layout {layout!r}")


def read_documents(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    layout: str = "indented",
    corrupt: bool = False,
    ordered: bool = False,
    **options: str,
) -> DataFrame:
    """One row per document of a file or folder, under the declared schema.

    A value that does not fit its type becomes null.  With ``corrupt`` the
    text of such a document is kept in the column ``_corrupt``, so that the
    loss can be counted.  A null element is a row of nulls.  With ``ordered`` the column ``ord`` sorts in file
    order, for operators that ask for the first row.
    """
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if corrupt:
        fields = T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())])
        options = {**options, "columnNameOfCorruptRecord": CORRUPT}
    if layout == "lines":
        docs = spark.read.schema(fields).options(**options).json(path)
        return docs.select("*", _position(F.monotonically_increasing_id())) if ordered else docs
    if layout not in SCANS:
        raise ValueError(f"unknown layout {layout!r}")
    texts = SCANS[layout](spark, path, ordered)
    return expand_json(texts, "value", fields, [ORD] if ordered else [], options)


def read_domain(
    spark: SparkSession,
    bronze: str,
    domain: str,
    ingest_date: str,
    schema: str | T.StructType,
    layout: str = "lines",
    corrupt: bool = False,
) -> DataFrame:
    """The documents of one domain and ingest date; ``corrupt`` as in ``read_documents``.

    Only that date's folder is listed.  Beside the landed lines this reads a
    folder of uploaded array files, where ``<domain>.json`` holds the
    documents and other files, such as manifests, are passed over.
    """
    folder = f"{bronze}/{domain}/ingest_date={ingest_date}"
    path = folder if layout == "lines" else f"{folder}/{domain}.json"
    return read_documents(spark, path, schema, layout, corrupt)


def read_category_map(spark: SparkSession, path: str, layout: str = "indented") -> DataFrame:
    """A JSON object of ``category -> [artist]`` as rows with a map column, and ``ord``.

    ``indented`` cuts a file that is indented by two spaces after each
    category, so many tasks share it.  ``whole`` parses a file of any format
    in one piece.
    """
    if layout == "whole":
        text = spark.read.text(path, wholetext=True)
        parsed = F.from_json("value", CATEGORY_MAP, {"mode": "FAILFAST"}).alias("categories")
        return text.select(parsed, _position(F.lit(0)))
    if layout != "indented":
        raise ValueError(f"unknown layout {layout!r}")
    chunk = F.col("value")
    last = chunk.rlike(r"(^|\n)\}\s*$")
    body = F.regexp_replace(F.regexp_replace(chunk, r"^\{\n", ""), r"(^|\n)\}\s*$", "")
    text = F.concat(F.lit("{"), body, F.when(last, "}").otherwise("]}"))
    chunks = spark.read.option("lineSep", CATEGORY_BOUNDARY).text(path)
    parsed = F.from_json(text, CATEGORY_MAP, {"mode": "FAILFAST"}).alias("categories")
    return chunks.select(parsed, _position(F.monotonically_increasing_id()))


def read_stored(
    spark: SparkSession, path: str, schema: str | T.StructType, format: str = "json"
) -> DataFrame:
    """Earlier output, or an empty table when there is none.

    Only an absent path counts as none; unreadable output raises, since
    starting from empty would lose it.
    """
    reader = spark.read.schema(schema).format(format)
    if format == "json":
        reader = reader.option("mode", "FAILFAST")
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def if_present(read, *args, **kwargs) -> DataFrame | None:
    """``read(...)``, or None when its path does not exist."""
    try:
        return read(*args, **kwargs)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
