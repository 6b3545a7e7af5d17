"""Equi-joins on one key.

Which side is broadcast is left to Spark, which knows the sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from discolake.operators.skew import thin
from discolake.session import new_folder


def attach(stats: DataFrame, attributes: DataFrame, key: str, hot: Sequence | None = ()) -> DataFrame:
    """Left join of one-row-per-key ``stats`` with ``attributes``.

    Several attribute rows for a key give several result rows.  A key with
    very many of them would end in one task, since the right side of a left
    join cannot be split.  With ``hot`` None, which needs no knowledge of the keys, the rows
    with attributes come from an inner join, which adaptive execution splits on either side, and
    those without from an anti join with thinned keys.  The statistics are written once
    and read by both.  A list of ``hot`` keys does the same for these keys only, and an empty one for none:
    a plain left join, for attributes that are known to have one row per key.
    """
    if hot is not None and not hot:
        return stats.join(attributes, key, "left")
    spark = stats.sparkSession
    path = new_folder(spark, "stats")
    stats.write.parquet(path)
    stats = spark.read.schema(stats.schema).parquet(path)
    columns = [*stats.columns, *(name for name in attributes.columns if name != key)]
    if hot is None:
        found = attributes.join(stats, key).select(columns)
        return found.unionByName(excluding(stats, attributes, key), allowMissingColumns=True)
    is_hot = F.coalesce(F.col(key).isin(list(hot)), F.lit(False))
    light = stats.where(~is_hot).join(attributes.where(~is_hot), key, "left")
    heavy = stats.where(is_hot)
    bare = heavy.join(thin(attributes.where(is_hot), key), key, "left_anti")
    heavy = attributes.where(is_hot).join(heavy, key).select(light.columns)
    return light.unionByName(heavy).unionByName(bare, allowMissingColumns=True)


def inherit(children: DataFrame, parents: DataFrame, key: str, *names: str) -> DataFrame:
    """Left join that copies the named parent columns onto each child.

    Parents have one row per key (see ``dedup.keep_first``).  Both sides are
    shuffled by the join itself, so a parent with very many children is split
    by adaptive execution.
    """
    return children.join(parents.select(key, *names), key, "left")


def matching(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the key set (semi join)."""
    return df.join(thin(keys, key), key, "left_semi")


def excluding(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not in the key set (anti join); null keys stay."""
    return df.join(thin(keys, key), key, "left_anti")
