"""Tables stored in buckets of a key, so that joins and sums by that key need no shuffle of them.

Equal keys of two tables with the same number of buckets meet where they lie.  A bucket is read by one
task, though, and adaptive execution cannot split it; so the largest is measured when the table is
written, and a table with a bucket far above the average is read like any other, with shuffles that
are split at the hot key."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A bucket with more than this many times the average is not left to one task.
HOT = 8
_LAYOUT = "key string, buckets int, rows long, largest long, schema string, fmt string"


def _layout_path(path: str) -> str:
    return f"{path.rstrip('/')}.layout"


def _table_name(path: str) -> str:
    return "tierwell_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def overwrite_bucketed(
    df: DataFrame, path: str, key: str, buckets: int, counts: Sequence[Column] = (), fmt: str = "parquet"
) -> dict[str, int]:
    """Replace the table at ``path``, in ``buckets`` of ``key``; the aggregates ``counts``, taken while writing.

    Rows are brought together by key first, and the rebalance hint lets adaptive execution deal a hot key
    to several tasks, so a bucket may have several files.  What is known of the layout is written last."""
    spark, name = df.sparkSession, _table_name(path)
    seen = Observation()
    # A further aggregate, so that there is always something to observe.
    watched = df.hint("rebalance", key).observe(seen, F.count(F.lit(1)).alias("_rows"), *counts)
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")  # an external table: only its name goes
    watched.write.format(fmt).mode("overwrite").option("path", path).bucketBy(buckets, key).saveAsTable(name)
    found = {k: v or 0 for k, v in seen.get.items()}
    # Spark deals rows to buckets by this expression; one row a bucket, from one column.
    sizes = spark.read.format(fmt).schema(df.schema).load(path).groupBy(F.pmod(F.hash(key), F.lit(buckets))).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    row = [(key, buckets, found.pop("_rows"), largest, df.schema.json(), fmt)]
    spark.createDataFrame(row, _LAYOUT).coalesce(1).write.mode("overwrite").parquet(_layout_path(path))
    return found


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table ``overwrite_bucketed`` has written, by any session.

    The session gets a name for it in its catalogue, which is how Spark learns of the buckets."""
    at = spark.read.schema(_LAYOUT).parquet(_layout_path(path)).first()
    schema = T.StructType.fromJson(json.loads(at["schema"]))
    if at["largest"] * at["buckets"] > HOT * at["rows"]:
        return spark.read.format(at["fmt"]).schema(schema).load(path)
    name = _table_name(path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")
    spark.sql(
        f"CREATE TABLE `{name}` ({columns}) USING {at['fmt']} "
        f"CLUSTERED BY (`{at['key']}`) INTO {at['buckets']} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
