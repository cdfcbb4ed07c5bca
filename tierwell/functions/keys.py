"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierwell.functions.text import as_col
from tierwell.sources.shared import ensure_checkpoint_dir


def hashed_key(c: Column | str) -> Column:
    """A stable 60-bit key: the first 15 hex digits of the SHA-256 of the natural key.

    Needs no shuffle, no state and no other row, so a rerun on any cluster gives the same key."""
    digest = F.sha2(F.coalesce(as_col(c).cast("string"), F.lit("")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sequential_key(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number rows 1..n in the order of a unique ``key`` without a global window.

    Rows are range-partitioned and sorted, so a row's number is its place in its partition plus
    the rows in all earlier partitions.  The ranged rows are checkpointed because their
    partitioning comes from sampling and must be the same in both uses; only one row per
    partition is ever put in order on its own."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(F.col(key).asc_nulls_first())
        .sortWithinPartitions(F.col(key).asc_nulls_first())
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
    )
    part, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    offsets = (
        ranged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows"))
        .select("_part", "_before")
    )
    # One row per partition: the size of this side is the partition count, not the data.
    return (
        ranged.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_before") + place + 1).alias(name))
    )
