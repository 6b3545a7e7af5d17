"""Files are written aside, checked, and only then take the place of the old ones.

What is staged lies beside its place under a name that Spark's readers pass over.  A place
is a folder: a whole table, or one date of it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from discolake.operators.quality import observed_rows

Check = Callable[[int], None]

#: Options for lines of JSON text: gzip at its fastest takes a fifth of the room at no more time.  One task
#: reads a packed file, so a file ends after so many lines, and later scans share the files.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "400000"}


@dataclass(frozen=True)
class Staged:
    path: str
    place: str
    rows: int


def _split(place: str) -> tuple[str, str]:
    parent, _, name = place.rstrip("/").rpartition("/")
    return parent or ".", name


def _files(spark: SparkSession, place: str):
    """The file system of a path, and what makes its path objects."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(place).getFileSystem(spark._jsc.hadoopConfiguration()), path


def _old(place: str) -> str:
    parent, name = _split(place)
    return f"{parent}/_old-{name}"


def restore(spark: SparkSession, place: str) -> None:
    """Bring back what a publish that was cut off had moved away."""
    files, path = _files(spark, place)
    old = path(_old(place))
    if files.exists(old):
        if files.exists(path(place)):
            files.delete(old, True)
        elif not files.rename(old, path(place)):
            raise OSError(f"{_old(place)} could not be renamed to {place}")


def stage(
    df: DataFrame, place: str, format: str = "parquet", by: Sequence[str] = (), options: Mapping[str, str] | None = None
) -> Staged:
    """Write the rows beside ``place``; the rows are counted as they pass."""
    restore(df.sparkSession, place)
    parent, _ = _split(place)
    path = f"{parent}/_staged-{uuid.uuid4().hex}"
    counted, seen = observed_rows(df, "staged")
    writer = counted.write.format(format).options(**(options or {}))
    if by:
        writer = writer.partitionBy(*by)
    try:
        writer.save(path)
    except Exception:
        discard(df.sparkSession, path)
        raise
    return Staged(path, place, seen.get["rows"])


def discard(spark: SparkSession, path: str) -> None:
    files, make = _files(spark, path)
    with suppress(Exception):  # what stays is passed over by readers
        files.delete(make(path), True)


def publish(spark: SparkSession, staged: Staged) -> None:
    """Put the staged files in their place; the old ones go last.

    If the new files cannot be put there, the old ones are put back.  After a crash between
    the two renames the next ``stage`` or ``restore`` does that.
    """
    files, path = _files(spark, staged.place)
    place, old = path(staged.place), path(_old(staged.place))
    had = files.exists(place)
    if had and not files.rename(place, old):
        raise OSError(f"{staged.place} could not be moved away")
    if not files.rename(path(staged.path), place):
        if had:
            files.rename(old, place)
        raise OSError(f"{staged.path} could not be renamed to {staged.place}")
    if had:
        files.delete(old, True)
    spark.catalog.refreshByPath(staged.place)


def replace(
    df: DataFrame, place: str, format: str = "parquet", by: Sequence[str] = (), check: Check | None = None,
    options: Mapping[str, str] | None = None,
) -> int:
    """Stage, check the row count, publish; returns the rows.  A check that raises leaves all as it was."""
    spark = df.sparkSession
    staged = stage(df, place, format, by, options)
    try:
        if check is not None:
            check(staged.rows)
        publish(spark, staged)
    except Exception:
        discard(spark, staged.path)
        raise
    return staged.rows
