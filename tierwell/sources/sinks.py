"""Writing layer tables, quarantine and the report."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def stamped(df: DataFrame, ingestion_timestamp: datetime | str) -> DataFrame:
    """Add the run-constant time at which the rows entered the first layer."""
    return df.withColumn("ingestion_timestamp", F.lit(ingestion_timestamp).cast("timestamp"))


def from_source(df: DataFrame, source: str) -> DataFrame:
    """Name the source of every row, for views over several sources."""
    return df.withColumn("_source", F.lit(source))


def union_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """All frames by column name; a column that a frame lacks is NULL there."""
    out, *others = frames
    for other in others:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> str:
    """Replace the table at ``path``, which must not be one ``df`` reads.

    With ``partition_by`` rows are first brought together by its value; the rebalance hint lets
    adaptive execution split a value that is far larger than the others."""
    return _written(_brought_together(df, partition_by), path, fmt, partition_by)


def _brought_together(df: DataFrame, partition_by: str | None) -> DataFrame:
    return df.hint("rebalance", partition_by) if partition_by else df


def _written(df: DataFrame, path: str, fmt: str, partition_by: str | None) -> str:
    writer = df.write.format(fmt).mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).save(path)
    return path


def overwrite_counted(
    df: DataFrame, path: str, counts: Sequence[Column], fmt: str = "parquet", partition_by: str | None = None
) -> dict[str, int]:
    """The same, and the values of the aggregates ``counts``, taken from the rows as they are written.

    They are observed in the tasks that write, of which each counts once, however often it is tried; so
    nothing is read again to know what a table holds."""
    seen = Observation()
    _written(_brought_together(df, partition_by).observe(seen, *counts), path, fmt, partition_by)
    return {name: value or 0 for name, value in seen.get.items()}


def quarantine_rows(df: DataFrame, source: str, key: str, reason: str = "reason") -> DataFrame:
    """Excluded rows in one common shape: where from, which, why, and the row itself."""
    body = [c for c in df.columns if c != reason]
    return df.select(
        F.lit(source).alias("source"),
        F.col(key).cast("string").alias("record_key"),
        F.col(reason).alias("reason"),
        F.to_json(F.struct(*body)).alias("record"),
    )


def document(row: Column) -> Column:
    """A struct as a JSON document."""
    return F.to_json(row, {"ignoreNullFields": "false"})


def write_document(df: DataFrame, path: str) -> str:
    """Write a one-row, one-column frame as a text file."""
    df.coalesce(1).write.mode("overwrite").text(path)
    return path
