"""Distinct counts that can be merged: a sketch a group and run, united over any set of runs.

An exact distinct count of several runs has to read all their rows again.  A sketch of 2**precision
registers is kept for each group of a run instead, whatever the number of rows, and two are united
without error of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Registers of a sketch as a power of two: 16 kB, and a standard error of 0.8 %.
PRECISION = 14


def distinct_sketches(df: DataFrame, groups: Sequence[str], key: str, precision: int = PRECISION) -> DataFrame:
    """One sketch of the distinct values of ``key`` for each group.  NULLs are not counted.

    Tasks build their own sketches before the shuffle, so a hot group arrives as one row a task."""
    return df.groupBy(*groups).agg(F.hll_sketch_agg(key, F.lit(precision)).alias("sketch"))


def united(sketches: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The sketches of several runs as one a group."""
    return sketches.groupBy(*groups).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated(sketches: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    return sketches.select(*groups, F.hll_sketch_estimate("sketch").alias(name))
