"""Joins against reference tables.

No join carries a broadcast hint: Spark broadcasts a side whose measured size is below its
threshold and otherwise sorts and merges, where adaptive execution splits the shuffle partitions
of hot keys.  Transactions are joined by account once per plan: a second join on the same key would
need the first one's partitioning, which keeps Spark from splitting it (see ``tuning`` as well)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mark_known(
    df: DataFrame, column: str, known: DataFrame, known_key: str, mark: str, carry: Sequence[str] = ()
) -> DataFrame:
    """Left join against a table that is unique on ``known_key``; ``mark`` holds the matched key
    or NULL.  ``carry`` names columns of ``known`` to bring along."""
    keys = known.select(F.col(known_key).alias(mark), *carry)
    return df.join(keys, F.col(column) == F.col(mark), "left")


def keep_known(df: DataFrame, column: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose ``column`` occurs in ``known``."""
    keys = known.select(F.col(known_key).alias("_known"))
    return df.join(keys, F.col(column) == F.col("_known"), "left_semi")


def keep_unknown(df: DataFrame, column: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose ``column`` does not occur in ``known``; a NULL occurs nowhere."""
    keys = known.select(F.col(known_key).alias("_known"))
    return df.join(keys, F.col(column) == F.col("_known"), "left_anti")


def orphan(mark: str) -> Column:
    """TRUE where ``mark_known`` found nothing."""
    return F.col(mark).isNull()
