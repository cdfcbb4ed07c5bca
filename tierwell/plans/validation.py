"""The validation reports over the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierwell.operators.linking import keep_unknown
from tierwell.operators.sketches import distinct_sketches, estimated, united


def volume_by_type(fact: DataFrame) -> DataFrame:
    """Count, amount and share per transaction type.  The window runs over one row per type."""
    per_type = fact.groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("record_count"), F.sum("amount").alias("total_amount")
    )
    share = F.round(F.col("record_count") * 100.0 / F.sum("record_count").over(W.partitionBy()), 2)
    return per_type.withColumn("pct_of_total", share.cast("double")).orderBy("transaction_type")


def unlinked_accounts(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """How many accounts have no customer.  A NULL customer counts as unlinked."""
    return keep_unknown(accounts, "customer_id", customers, "customer_id").agg(
        F.count(F.lit(1)).alias("unlinked_accounts")
    )


def _with_province(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    owners = customers.select(F.col("customer_id").alias("_owner"), "province")
    return accounts.join(owners, F.col("customer_id") == F.col("_owner"), "inner")


def accounts_by_province(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _with_province(accounts, customers)
        .groupBy("province")
        .agg(F.count_distinct("account_id").alias("account_count"))
        .orderBy("province")
    )


def province_sketches(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """What a run keeps so that accounts can be counted over several runs: a sketch a province."""
    return distinct_sketches(_with_province(accounts, customers), ["province"], "account_id")


def accounts_by_province_over_runs(sketches: DataFrame) -> DataFrame:
    """``accounts_by_province`` over the union of runs, from their sketches alone; an account in several runs
    counts once.  An estimate, well within the 5 % that the report allows."""
    return estimated(united(sketches, ["province"]), ["province"], "account_count").orderBy("province")


def flagged_and_clean(fact: DataFrame) -> DataFrame:
    """Flagged and clean rows in one pass; both rows appear even when a count is zero."""
    counts = fact.agg(
        F.count("dq_flag").alias("flagged"), (F.count(F.lit(1)) - F.count("dq_flag")).alias("clean")
    )
    return counts.select(
        F.explode(
            F.array(
                F.struct(F.lit("fact_transactions").alias("source"), F.col("flagged").alias("flagged_count")),
                F.struct(F.lit("clean_records").alias("source"), F.col("clean").alias("flagged_count")),
            )
        ).alias("row")
    ).select("row.*").orderBy("source")
