"""Exact dedup by sorting contents: equal texts become neighbours and are compared in full.

Rows are dealt to ranges of (head of the text, digest, id).  The ranges come from a
bounded sample, so a text that makes up a third of all rows spans several of them.
Inside a range an external sort in the same order places equal texts side by side, and each text is
compared in full with its neighbours.  The order is that of the first HEAD_CHARS characters, then of the
SHA-256 of the whole text, so long texts with one beginning are not compared to be sorted.  Only
the first and last run of a range can go on in another one; these few rows are added up apart by
their digests, without comparing the texts again, and joined back.

Nulls and ties: a null text counts as empty, and an empty text equals only other
empty ones.  A null id is below every other.  Of rows that share text and id exactly one
stays.  An empty table gives no rows.  Other columns are passed on as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from discolake.llm.tables import partitions, range_of, splitters, stored

#: Characters of a text that a splitter holds; the digest orders what they leave equal.
HEAD_CHARS = 32
#: Ranges for each shuffle partition, so that their uneven sizes average out.
RANGES_PER_PARTITION = 4


def runs(docs: DataFrame, text: Column, id_col: str, keep: str) -> DataFrame:
    """docs with its run in a range: __size, __keep, __last, __edge, __range, __sha."""
    content = F.coalesce(text, F.lit(""))
    # The head holds no separator, so rows in the order of this key are in the order of their ranges.
    head = F.translate(F.substring(content, 1, HEAD_CHARS), "\0", "")
    place = F.concat(head, F.lit("\0"), F.sha2(content, 256))
    key = F.concat(place, F.lpad(F.coalesce(F.col(id_col).cast("string"), F.lit("")), 20, "0"))
    cuts = splitters(docs, key, RANGES_PER_PARTITION * partitions(docs.sparkSession))
    keyed = docs.withColumns(
        {
            "__text": content,
            "__place": place,
            "__sha": F.sha2(content, 256),
            "__range": range_of(key, cuts),
        }
    )
    order = F.col(id_col).asc_nulls_first() if keep == "largest" else F.col(id_col).desc_nulls_first()
    by_text = Window.partitionBy("__range").orderBy("__place", order)
    before, after = F.lag("__text").over(by_text), F.lead("__text").over(by_text)
    marked = keyed.withColumns({"__before": before, "__after": after})
    first = F.col("__before").isNull() | (F.col("__before") != F.col("__text"))
    last = F.col("__after").isNull() | (F.col("__after") != F.col("__text"))
    marked = marked.withColumns(
        {
            "__last": last,
            "__edge": F.col("__before").isNull() | F.col("__after").isNull(),
            "__run": F.sum(first.cast("long")).over(by_text),
        }
    ).drop("__before", "__after", "__text", "__place")
    in_run = Window.partitionBy("__range", "__run")
    best = F.max(id_col) if keep == "largest" else F.min(id_col)
    return marked.withColumns(
        {"__size": F.count(F.lit(1)).over(in_run), "__keep": best.over(in_run)}
    ).drop("__run")


def settled(rows: DataFrame, keep: str) -> DataFrame:
    """Add up the runs that go on over several ranges; adds __group_size, __keep_id, __kept."""
    pick = F.max if keep == "largest" else F.min
    owner = F.max_by if keep == "largest" else F.min_by
    edges = rows.filter("__edge").select("__range", "__sha", "__size", "__keep").distinct()
    spread = (
        edges.groupBy("__sha")
        .agg(
            F.sum("__size").alias("__all"),
            pick("__keep").alias("__best"),
            owner("__range", F.struct("__keep", "__range")).alias("__owner"),
            F.count(F.lit(1)).alias("__ranges"),
        )
        .filter("__ranges > 1")
        .drop("__ranges")
    )
    # Two rows for each range at most, whatever the size of the table.
    joined = rows.join(F.broadcast(spread), "__sha", "left")
    alone = F.col("__all").isNull()
    return joined.withColumns(
        {
            "__group_size": F.coalesce("__all", "__size"),
            "__keep_id": F.when(alone, F.col("__keep")).otherwise(F.col("__best")),
            "__kept": F.col("__last") & (alone | (F.col("__owner") == F.col("__range"))),
        }
    )


def mark_copies(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: str = "smallest"
) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256."""
    narrow = docs.select(F.col(id_col), F.col(text_col).alias("__given"))
    rows = runs(narrow, F.col("__given"), id_col, keep).drop("__given")
    done = settled(stored(rows, "content-runs", narrow=True), keep)
    return done.select(
        id_col,
        F.col("__keep_id").alias("keep_id"),
        F.col("__group_size").alias("group_size"),
        F.col("__kept").alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def drop_copies(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", keep: str = "smallest"
) -> DataFrame:
    """The rows of docs that stay, with their own columns."""
    rows = runs(docs, F.col(text_col), id_col, keep).filter("__last OR __edge")
    done = settled(stored(rows, "content-last"), keep)
    return done.filter("__kept").select(*docs.columns)
