"""Checks on finished tables.  Each gives rows of ``(check, violations)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwell import fixed_values as fv
from tierwell.operators.linking import keep_unknown


def _unpivot(one_row: DataFrame) -> DataFrame:
    """A one-row frame of counts as ``(check, violations)`` rows."""
    return one_row.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(c).alias("check"), F.coalesce(F.col(f"`{c}`"), F.lit(0)).cast("bigint").alias("violations"))
                    for c in one_row.columns
                ]
            )
        ).alias("row")
    ).select("row.*")


def key_unique(df: DataFrame, key: str, name: str) -> DataFrame:
    """Surplus rows per key and rows without a key.  Keys are counted before the shuffle."""
    sizes = df.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    known = F.col("_key").isNotNull()
    return _unpivot(
        sizes.agg(
            F.sum(F.when(known, F.col("_n") - 1)).alias(f"{name}.{key} unique"),
            F.sum(F.when(~known, F.col("_n"))).alias(f"{name}.{key} present"),
        )
    )


def references(df: DataFrame, column: str, target: DataFrame, key: str, name: str) -> DataFrame:
    """Rows whose foreign key has no target."""
    return _unpivot(keep_unknown(df, column, target, key).agg(F.count(F.lit(1)).alias(name)))


def domain_counts() -> list[Column]:
    """What ``domains`` counts, also to be counted while facts are written."""
    currency, flag = F.col("currency"), F.col("dq_flag")
    return [
        F.count_if(currency.isNull() | (currency != fv.CURRENCY)).alias("currency standard"),
        F.count_if(flag.isNotNull() & ~flag.isin(*fv.FLAG_PRIORITY)).alias("dq_flag known"),
    ]


def domains(fact: DataFrame) -> DataFrame:
    """Rows with another currency than the standard one, and rows with an unknown flag."""
    return _unpivot(fact.agg(*domain_counts()))


def required_counts(schema: T.StructType, name: str) -> list[Column]:
    """What ``required_nulls`` counts, also to be counted while a table is written."""
    required = [f.name for f in schema.fields if not f.nullable]
    return [F.count_if(F.col(c).isNull()).alias(f"{name}.{c} present") for c in required]


def required_nulls(df: DataFrame, schema: T.StructType, name: str) -> DataFrame:
    """NULLs in columns the schema declares as required, all in one pass."""
    return _unpivot(df.agg(*required_counts(schema, name)))


def not_empty(df: DataFrame, name: str) -> DataFrame:
    """One violation for an empty table.  Looks at a single row."""
    return _unpivot(df.limit(1).agg((F.lit(1) - F.count(F.lit(1))).alias(f"{name} not empty")))


def report_sound(document: DataFrame) -> DataFrame:
    """What is wrong with a report document: missing parts, more flagged than delivered, flags that do
    not add up to the flagged total."""
    flags = F.aggregate(F.map_values("flag_counts"), F.lit(0).cast("bigint"), lambda total, n: total + n)
    tests = {f"report.{c} present": F.col(f"`{c}`").isNull() for c in document.columns}
    tests["report flagged within total"] = F.col("flagged_records") > F.col("total_records")
    tests["report issues add up"] = flags != F.col("flagged_records")
    return _unpivot(document.agg(*[F.count_if(test).alias(name.replace("$", "")) for name, test in tests.items()]))


def within_tolerance(measured: DataFrame, expected: DataFrame, key: str, value: str, tolerance: float) -> DataFrame:
    """Measured against expected values by key; a key on one side only is out of tolerance."""
    left = measured.select(key, F.col(value).cast("double").alias("measured"))
    right = expected.select(key, F.col(value).cast("double").alias("expected"))
    gap = F.abs(F.col("measured") - F.col("expected"))
    ok = gap <= F.lit(tolerance) * F.abs(F.col("expected"))
    return left.join(right, key, "full").withColumn("within", F.coalesce(ok, F.lit(False)))


def reconcile(source: DataFrame, kept: DataFrame, rejected: DataFrame, removed: DataFrame, name: str) -> DataFrame:
    """Source rows against kept, rejected and removed rows; ``unexplained`` must be zero.

    ``removed`` is a one-row frame with the number of removed duplicates in ``records``."""
    counted = [_part(kept.agg(F.count(F.lit(1)).alias("n")), "n", "kept"), _part(rejected.agg(F.count(F.lit(1)).alias("n")), "n", "rejected")]
    return _reconciled(source, [*counted, _part(removed, "records", "duplicates")], name)


def reconciled_counts(source: DataFrame, counts: DataFrame, name: str) -> DataFrame:
    """The same from a one-row frame with ``kept``, ``rejected`` and ``duplicates``."""
    one = counts.select(F.inline(F.array(*[F.struct(F.lit(p).alias("part"), F.col(p).cast("bigint").alias("records")) for p in ("kept", "rejected", "duplicates")])))
    return _reconciled(source, [one], name)


def _part(df: DataFrame, column: str, part: str) -> DataFrame:
    return df.select(F.lit(part).alias("part"), F.col(column).cast("bigint").alias("records"))


def _reconciled(source: DataFrame, parts: list[DataFrame], name: str) -> DataFrame:
    long = _part(source.agg(F.count(F.lit(1)).alias("n")), "n", "source")
    for other in parts:
        long = long.unionAll(other)

    def total(p: str):
        return F.coalesce(F.sum(F.when(F.col("part") == p, F.col("records"))), F.lit(0))

    return long.agg(*[total(p).alias(f"{p}_rows") for p in ("source", "kept", "rejected", "duplicates")]).select(
        F.lit(name).alias("table_name"),
        "*",
        (
            F.col("source_rows") - F.col("kept_rows") - F.col("rejected_rows") - F.col("duplicates_rows")
        ).alias("unexplained"),
    )
