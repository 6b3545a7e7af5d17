"""Tables bucketed by a key: what is stored stays where it is when new rows are tested against it.

The files lie under a path like those of any other table; a name in the session's catalog tells Spark
how they are dealt to buckets.  A table is bucketed from its first rows on: files that were
written without buckets cannot be read with them.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Bucketed:
    """A table of a path, its schema, the key that deals rows to buckets, and their number.

    Every run must name the same number.  Give it at least as many buckets as there are shuffle
    partitions; with fewer Spark may deal the stored rows anew.
    """

    path: str
    schema: str
    key: str
    buckets: int

    def name(self, spark: SparkSession) -> str:
        """The table's name in the catalog, which is declared at its first use in a session."""
        spec = f"{self.path}|{self.schema}|{self.key}|{self.buckets}"
        name = f"bucketed_{hashlib.sha256(spec.encode()).hexdigest()[:24]}"
        if not spark.catalog.tableExists(name):
            fields = T.StructType.fromDDL(self.schema).fields
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
            place = self.path.replace("'", "\\'")
            spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`) INTO {self.buckets} BUCKETS"
                f" LOCATION '{place}'"
            )
        return name

    def read(self, spark: SparkSession) -> DataFrame:
        """The stored rows, none before the first append."""
        name = self.name(spark)
        spark.catalog.refreshTable(name)
        return spark.table(name)

    def append(self, rows: DataFrame) -> None:
        """Add rows; each task writes one file for each of its buckets, so they are dealt by key first."""
        spark = rows.sparkSession
        name = self.name(spark)
        dealt = rows.select(*T.StructType.fromDDL(self.schema).names).repartition(self.buckets, self.key)
        dealt.write.mode("append").insertInto(name)
