"""Counting each transaction once with a memory that ends.

The default remembers every (account, transaction) for good.  Here Spark's
``dropDuplicatesWithinWatermark`` forgets one a given time after it first arrived.  The time is that of
the micro-batch, not of the event, so events may be as late as they like and still count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.functions.money import signed, zero
from tierwell.streaming.events import EVENT_KEY

REASON = "REPEATED_DELIVERY"
_CONTENT = ["transaction_timestamp", "amount", "transaction_type", "_record"]


def marked(events: DataFrame, within: str) -> DataFrame:
    """All events of a stream, and once more, with ``_first`` 1, those whose key is not remembered.

    Both halves read the same files, so a micro-batch holds what arrived beside what counts."""
    arrived = events.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
    fresh = arrived.dropDuplicatesWithinWatermark(EVENT_KEY).select(*events.columns, F.lit(1).alias("_first"))
    return arrived.select(*events.columns, F.lit(0).alias("_first")).unionByName(fresh)


def deliveries(batch: DataFrame) -> DataFrame:
    """The distinct deliveries of one micro-batch of ``marked``, with their number, and in ``_new`` whether
    it was one of these that the state had not seen.  Equal ones are combined before the shuffle.

    To be persisted: whatever evaluates it twice would go through the state twice."""
    return batch.groupBy(*EVENT_KEY, F.struct(*_CONTENT).alias("_content")).agg(
        F.count_if(F.col("_first") == 0).alias("_copies"), F.max("_first").alias("_new")
    )


def judged(each: DataFrame) -> DataFrame:
    """``deliveries`` with ``_new``, whether their transaction counts, and ``_newest``, which delivery does
    then: the newest, so the order in which tasks deliver them decides nothing."""
    whole = each.groupBy(*[F.col(k).alias(f"_of_{k}") for k in EVENT_KEY]).agg(
        F.max("_content").alias("_newest"), F.max("_new").alias("_any_new")
    )
    same = [F.col(k) == F.col(f"_of_{k}") for k in EVENT_KEY]
    return each.join(whole, same).select(
        *EVENT_KEY, "_content", "_copies", (F.col("_any_new") == 1).alias("_new"), (F.col("_content") == F.col("_newest")).alias("_newest")
    )


def effects(found: DataFrame) -> DataFrame:
    """What deliveries do to accounts: a repeat moves the clock but not the balance."""
    effect = signed("_content.amount", "_content.transaction_type")
    return found.select(
        "account_id",
        F.when(F.col("_new") & F.col("_newest"), effect).otherwise(zero()).cast(fv.MONEY).alias("signed_amount"),
        F.col("_content.transaction_timestamp").alias("transaction_timestamp"),
    )


def dropped(found: DataFrame) -> DataFrame:
    """Every delivery that did not count, one row each, as rejected events."""
    surplus = F.col("_copies") - F.when(F.col("_new") & F.col("_newest"), 1).otherwise(0)
    return (
        found.withColumn("_surplus", surplus)
        .filter(F.col("_surplus") > 0)
        .withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_surplus"))))
        .select(
            F.lit("stream").alias("source"),
            F.col("transaction_id").alias("record_key"),
            F.lit(REASON).alias("reason"),
            F.col("_content._record").alias("record"),
        )
    )
