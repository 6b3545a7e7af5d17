"""Ordering, first-N and sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from discolake.session import new_folder

#: Rows that one task may put in order; a larger sample is cut by counts of digests.
FEW = 100_000
#: Hexadecimal digits of a digest that one histogram counts.
DIGITS = 3


def ranked(df: DataFrame, by: Sequence[str], key: str) -> DataFrame:
    """Order by the given columns, highest first and nulls last, then by key."""
    return df.orderBy(*[F.desc_nulls_last(name) for name in by], F.asc(key))


def first_n_per_parent(
    df: DataFrame, parent: str | Sequence[str], order: Sequence[str | Column], n: int
) -> DataFrame:
    """The first ``n`` rows of each parent under ``order``.

    Each group is cut per input partition before the shuffle, for any ``n``
    up to ``spark.sql.optimizer.windowGroupLimitThreshold``, which ``session.CONF`` lifts.
    """
    parents = [parent] if isinstance(parent, str) else list(parent)
    window = Window.partitionBy(*parents).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where(F.col("_rank") <= n).drop("_rank")


def first_n(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows overall; each task keeps only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def first_many(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first ``n`` rows overall, for an ``n`` too large for one task.

    The rows are written once, dealt to ranges of the order; the counts of the ranges, one row for
    each, tell which are taken whole and how many rows of the last one.
    """
    spark = df.sparkSession
    path = new_folder(spark, "ranges")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id())
    ranged.write.parquet(path)
    ranged = spark.read.schema(ranged.schema).parquet(path)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    left = F.lit(n) - F.coalesce(F.sum("_rows").over(before), F.lit(0))
    taken = ranged.join(counted.withColumn("_left", left).where("_left > 0"), "_range")
    # Only the range that is cut needs its rows in order.
    whole = taken.where("_rows <= _left").select(df.columns)
    within = Window.partitionBy("_range").orderBy(*order)
    cut = taken.where("_rows > _left").withColumn("_place", F.row_number().over(within))
    return whole.unionByName(cut.where("_place <= _left").select(df.columns))


def poll_size(total: str | Column, n: int) -> Column:
    """How many rows a poll of at most ``n`` gets from ``total``."""
    total = F.col(total) if isinstance(total, str) else total
    return F.least(total, F.lit(n).cast("long"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42, few: int | None = None) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones under any partitioning.

    The rows with the smallest MD5 of ``key:seed`` are taken, with the key as
    tie-break.  The input is read twice within one query: a subquery counts
    how many digests start with how many zeros, at most 33 rows, and rows that
    cannot be among the first ``n`` are filtered out before any are sorted.  Samples of more
    than ``few`` rows, FEW by default, are never put in order; the rows are the same.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    if n > (FEW if few is None else few):
        return _sample_by_histogram(df, digest, key, n)
    zeros = F.length(F.regexp_extract(digest, "^0*", 0))
    counted = df.groupBy(zeros.alias("zeros")).agg(F.count(F.lit(1)).alias("rows"))
    reach = F.sum("rows").over(Window.orderBy(F.desc("zeros")))
    enough = counted.withColumn("reach", reach).where(F.col("reach") >= n)
    least = enough.agg(F.coalesce(F.max("zeros"), F.lit(0)).alias("least")).scalar()
    return df.where(zeros >= least).orderBy(digest, key).limit(n)


def _sample_by_histogram(df: DataFrame, digest: Column, key: str, n: int) -> DataFrame:
    """The rows with the ``n`` smallest digests, without sorting them in one task.

    Counts of the first DIGITS digits of the digests, 4096 rows, find the group that the last row
    is in, and counts of the next DIGITS digits of that group a group in it.  Smaller groups are taken
    whole, and only rows of that last one, a 16-millionth of all, are put in order.
    """

    def edge(rows: DataFrame, at: int, left: Column | int) -> tuple[Column, Column]:
        """The group that holds the last row, and how many rows are left for it."""
        counted = rows.groupBy(F.substring(digest, at, DIGITS).alias("group")).agg(F.count(F.lit(1)).alias("rows"))
        upto = F.sum("rows").over(Window.orderBy("group"))
        reach = counted.withColumn("upto", upto).where(F.col("upto") >= left)
        first = reach.agg(F.min(F.struct("group", (F.col("upto") - F.col("rows")).alias("before"))).alias("first"))
        # Without enough rows every group is taken whole.
        group = first.select(F.coalesce("first.group", F.lit("~"))).scalar()
        return group, F.lit(left) - first.select(F.coalesce("first.before", F.lit(0))).scalar()

    head, tail = F.substring(digest, 1, DIGITS), F.substring(digest, DIGITS + 1, DIGITS)
    group, left = edge(df, 1, n)
    part, last = edge(df.where(head == group), DIGITS + 1, left)
    whole = df.where((head < group) | ((head == group) & (tail < part)))
    some = df.where((head == group) & (tail == part))
    place = F.row_number().over(Window.orderBy(digest, key))
    return whole.unionByName(some.withColumn("_place", place).where(F.col("_place") <= last).drop("_place"))
