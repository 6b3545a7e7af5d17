"""Helpers that several operators share: written tables, splitters, input columns."""

from __future__ import annotations

import ctypes
import functools
import gc
import os
from collections.abc import Callable, Iterable, Iterator, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from discolake.session import new_folder

#: Rows of a splitter sample, at most about so many: the driver sorts them.
SAMPLE_ROWS = 20_000


#: A table without texts has about an eighth of the partitions of one with texts.
NARROW = 8


#: Shuffle files of a query are removed once it has ended; what it wrote needs them no more.
CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The folders that each session's operators have written, oldest first.
WRITTEN: dict[str, list[str]] = {}


def stored(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """Write to the shared folder and read back: no lineage, survives lost executors.

    narrow: the rows are small, so they are gathered into fewer files first.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    if narrow:
        df = df.repartition(max(1, partitions(spark) // NARROW))
    before = spark.conf.get(CLEANUP_CONF, "false")
    spark.conf.set(CLEANUP_CONF, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP_CONF, before)
    WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return spark.read.schema(df.schema).parquet(path)


def written(spark: SparkSession) -> list[str]:
    return WRITTEN.setdefault(spark.sparkContext.applicationId, [])


def release(spark: SparkSession, paths: Iterable[str] | None = None) -> None:
    """Remove working tables, by default all that this session has written so far.

    Whatever was made of them must be written by then: frames that still read them fail.
    """
    known = written(spark)
    make = spark._jvm.org.apache.hadoop.fs.Path
    for path in list(known if paths is None else paths):
        place = make(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        if path in known:
            known.remove(path)


#: The folder that holds the package, for Python workers that have no installed copy.
ROOT = str(Path(__file__).resolve().parents[2])


#: Rows of an Arrow batch at most: workers hold a batch, and whole texts are long.
BATCH_ROWS = 2_000
BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_batches(df: DataFrame, work: Callable, schema) -> DataFrame:
    """mapInArrow with small batches and with this package on the workers' path."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(BATCH_CONF)) <= BATCH_ROWS:
        conf.set(BATCH_CONF, str(BATCH_ROWS))
    environment = df.sparkSession.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in known:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, known)])
    return df.mapInArrow(functools.partial(returning_memory, work), schema)


def returning_memory(work: Callable, batches: Iterator) -> Iterator:
    """work, and then what it freed goes back to the system: workers live on and add up."""
    yield from work(batches)
    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Bits that a broadcast set of ids has (8 MB), and those in a row of it.
AMONG_BITS = 1 << 26
ROW_BITS = 1 << 15


def perhaps_among(rows: DataFrame, key: Column, ids: DataFrame) -> DataFrame:
    """rows with __among: False for keys that are not in the one column of ids, True for those that are, and for a few others.

    Both are long.  What is broadcast is a bit for each hash, and does not grow with ids.
    """

    def place(value: Column) -> Column:
        return F.pmod(F.xxhash64(value), F.lit(AMONG_BITS))

    at = place(F.col(ids.columns[0]))
    bits = ids.groupBy(F.floor(at / ROW_BITS).alias("__row")).agg(
        F.bitmap_construct_agg(at % ROW_BITS).alias("__bits")
    )
    mine = place(key) % ROW_BITS
    byte = F.conv(F.hex(F.substring(F.col("__bits"), F.floor(mine / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("long")
    there = F.floor(byte / F.pow(F.lit(2), mine % 8)) % 2 == 1
    found = rows.join(F.broadcast(bits), F.floor(place(key) / ROW_BITS) == F.col("__row"), "left")
    return found.withColumn("__among", F.coalesce(there, F.lit(False))).drop("__row", "__bits")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: Column) -> Column:
    """True for the fifth of the ids that no model may learn from (a null id counts as '')."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def splitters(rows: DataFrame, key: Column, ranges: int) -> list:
    """At most ranges - 1 quantiles of key over rows, from a bounded sample."""
    total = rows.count()
    if not total or ranges < 2:
        return []
    share = min(1.0, SAMPLE_ROWS / total)
    some = rows.sample(fraction=share, seed=7) if share < 1 else rows
    keys = some.select(key.alias("key")).filter("key IS NOT NULL").limit(2 * SAMPLE_ROWS)
    found = sorted(row[0] for row in keys.collect())
    cuts = {found[i * len(found) // ranges] for i in range(1, ranges)} if found else set()
    return sorted(cuts)


def range_of(key: Column, cuts: Sequence) -> Column:
    """How many of the sorted cuts are not above key: its range, 0 for a null key.

    The cuts are searched on two levels, so a row costs about two roots of their
    number and not all of them.
    """
    if not cuts:
        return F.lit(0)
    step = max(1, round(len(cuts) ** 0.5))
    every = F.array(*map(F.lit, cuts))
    heads = F.array(*map(F.lit, cuts[::step]))
    below = F.size(F.filter(heads, lambda c: c <= key))
    start = F.greatest((below - 1) * step, F.lit(0))
    within = F.size(F.filter(F.slice(every, start + 1, step), lambda c: c <= key))
    return F.when(key.isNull() | (below == 0), 0).otherwise(start + within).cast("int")
