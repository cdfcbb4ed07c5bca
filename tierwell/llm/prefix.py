"""Running sums over a whole table in a global order, without one task that sees every row.

Rows are dealt to partitions by ranges of the order and written with the number of their partition.
A row's sum is then the total of all partitions before its own plus the sum of the rows before it
there; only one row per partition is ever put in order in a single task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierwell.sources.shared import stored


def running_sums(df: DataFrame, order: Sequence[str], sums: Mapping[str, str]) -> DataFrame:
    """``df`` with a long column for each item of ``sums`` (new name: column to add up): the sum over
    all rows before this one in ascending ``order``, NULLs first.

    ``order`` should tell all rows apart, so that no range of it is large and the sums are the same
    on every run.  The ranged rows are a written table, so a lost executor can't deal them anew.
    Columns ``_part`` and ``_before_*`` are taken."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = stored(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranged")
    totals = ranged.groupBy("_part").agg(*[F.sum(c).alias(f"_before_{name}") for name, c in sums.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", *[F.coalesce(F.sum(f"_before_{n}").over(earlier), F.lit(0)).alias(f"_before_{n}") for n in sums])
    inside = Window.partitionBy("_part").orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(n) for n, c in sums.items()])
    # One row per partition: the size of this side is the number of partitions, whatever the data.
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, *[(F.col(n) + F.col(f"_before_{n}")).cast("long").alias(n) for n in sums]
    )
