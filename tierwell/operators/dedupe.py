"""One row per key, and the newest N rows per key.

Deduplication is an aggregation (``max`` / ``min`` over a struct), not a window: Spark then
combines each task's rows before the shuffle, so a key that holds a third of all rows reaches the
reducer as one row per task.  The group's size comes out of the same pass.  Every remaining column
breaks ties, so the survivor never depends on row order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwell.functions.text import any_of, missing


def _names(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def keyless(df: DataFrame, keys: str | Sequence[str]) -> Column:
    """TRUE for rows without a usable key: a NULL, or for text also a blank."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return any_of(
        missing(k) if isinstance(kinds[k], T.StringType) else F.col(k).isNull() for k in _names(keys)
    )


def one_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: Sequence[str],
    keep: str = "latest",
    count_as: str | None = None,
    keep_keyless: bool = False,
    totals: Mapping[str, Column] | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the latest or earliest row of every key by ``order_by``, NULLs last either way.

    ``count_as`` names a column for the number of rows the key had; ``totals`` adds aggregates over all of
    them, by name.  ``only`` names the columns to return.  Those behind the last of them in the order could
    only break ties of rows that are equal in all that is returned, so they are not even shuffled.  Rows
    without a key are never
    put into one group: they are left out, or with ``keep_keyless`` all kept as they are.  Those are
    told apart by their place in the input, in the same pass; so with ``keep_keyless`` the input
    must come in the same order when a task is retried, as a file scan does."""
    if keep not in ("latest", "earliest"):
        raise ValueError("keep is 'latest' or 'earliest'")
    keys = _names(keys)
    ranked = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in ranked]
    shown = [c for c in df.columns if only is None or c in only]
    while rest and rest[-1] not in shown:
        rest.pop()
    if keep == "latest":
        row, pick = F.struct(*ranked, *rest), F.max
    else:
        # A NULL sorts first in a struct, so an "is NULL" mark goes before each ordering column.
        marked = [m for c in ranked for m in (F.col(c).isNull().alias(f"_no_{c}"), F.col(c))]
        row, pick = F.struct(*marked, *rest), F.min

    if keep_keyless:
        own_place = F.when(keyless(df, keys), F.monotonically_increasing_id())
        grouped = df.withColumn("_lone", own_place).groupBy(*keys, "_lone")
    else:
        grouped = df.filter(~keyless(df, keys)).groupBy(*keys)
    added = [total.alias(name) for name, total in (totals or {}).items()]
    kept = grouped.agg(pick(row).alias("_best"), F.count(F.lit(1)).alias(count_as or "_copies"), *added)
    best = {c: F.col(f"_best.{c}").alias(c) for c in ranked + rest}
    return kept.select(*[best.get(c, F.col(c)) for c in shown], *([count_as] if count_as else []), *(totals or {}))


def group_sizes(df: DataFrame, keys: str | Sequence[str], name: str) -> DataFrame:
    """How many rows every key has."""
    keys = _names(keys)
    return df.filter(~keyless(df, keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def newest_per_key(
    df: DataFrame, keys: str | Sequence[str], order_by: Sequence[str], limit: int, tie_break: Sequence[str] = ()
) -> DataFrame:
    """The ``limit`` newest rows of every key, by ``order_by`` descending, then ``tie_break``.

    A rank filter straight on the window lets Spark cut every task's rows to ``limit`` per key
    before the shuffle, so a hot key costs ``limit`` rows per task."""
    order = [F.col(c).desc_nulls_last() for c in order_by] + [F.col(c).asc_nulls_last() for c in tie_break]
    place = F.row_number().over(W.partitionBy(*_names(keys)).orderBy(*order))
    return df.withColumn("_place", place).filter(F.col("_place") <= limit).drop("_place")
