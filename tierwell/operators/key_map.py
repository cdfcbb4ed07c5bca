"""Surrogate numbers that stay: once a natural key has a number, no later run changes it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwell.functions.keys import sequential_key
from tierwell.sources.readers import empty
from tierwell.sources.shared import names_in, remove
from tierwell.sources.sinks import overwrite_counted

_MAP = T.StructType([T.StructField("key", T.StringType()), T.StructField("number", T.LongType())])


class KeyMap:
    """Keys and their numbers 1..n below ``root``, kept across runs; one writer at a time.

    Every extension is a folder of its own that counts once its write has been committed, so one that was
    lost halfway is written anew and nothing is ever changed in place."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def read(self) -> DataFrame:
        paths = [f"{self.root}/id={n}" for n in self._done()]
        return self.spark.read.schema(_MAP).parquet(*paths) if paths else empty(self.spark, _MAP)

    def extend(self, df: DataFrame, key: str) -> int:
        """Give numbers to the keys of ``df`` that have none, on from the highest, in the order of the keys;
        how many there were.  Keys are compared as text; NULL gets none.  A repeated key is combined before the
        shuffle, so one with a third of the rows costs a row a task."""
        known = self.read()
        fresh = (
            df.select(F.col(key).cast("string").alias("key"))
            .dropna()
            .distinct()
            .join(known.select(F.col("key").alias("_known")), F.col("key") == F.col("_known"), "left_anti")
        )
        end = known.agg(F.max("number")).first()[0] or 0
        numbered = sequential_key(fresh, "key", "place").select("key", (F.col("place") + end).alias("number"))
        done = self._done()
        path = f"{self.root}/id={done[-1] + 1 if done else 0}"
        added = overwrite_counted(numbered, path, [F.count(F.lit(1)).alias("keys")])["keys"]
        if not added:
            remove(self.spark, path)
        return added

    def numbered(self, df: DataFrame, key: str, name: str) -> DataFrame:
        """``df`` with the number of its key as ``name``, NULL for a key without one."""
        known = self.read().select(F.col("key").alias("_known"), F.col("number").alias(name))
        return df.join(known, F.col(key).cast("string") == F.col("_known"), "left").drop("_known")

    def _done(self) -> list[int]:
        names = [n for n in names_in(self.spark, self.root) if n.startswith("id=")]
        done = [n for n in names if "_SUCCESS" in names_in(self.spark, f"{self.root}/{n}")]
        return sorted(int(n.removeprefix("id=")) for n in done)
