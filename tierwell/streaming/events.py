"""Stream events and what one set of them does to the keyed tables.

Everything here works on batch and streaming frames alike, or on the batch side of one
micro-batch.  All reducers are commutative, so the way events are split into batches does not
change a result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.functions.money import balance, money, signed, zero
from tierwell.functions.temporal import compose_timestamp, parse_date
from tierwell.functions.text import code, missing, text
from tierwell.operators.dedupe import newest_per_key, one_per_key
from tierwell.operators.linking import keep_known
from tierwell.schemas import CORRUPT, CURRENT_BALANCES, RECENT_TRANSACTIONS, conform
from tierwell.sources.readers import optional

EVENT_KEY = ["account_id", "transaction_id"]
EVENT_ORDER = ["transaction_timestamp", "updated_at"]


def typed_events(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    dated = raw.withColumn("transaction_date", parse_date("transaction_date"))
    return dated.select(
        text("account_id").alias("account_id"),
        text("transaction_id").alias("transaction_id"),
        compose_timestamp("transaction_date", "transaction_time").alias("transaction_timestamp"),
        money("amount").alias("amount"),
        code("transaction_type").alias("transaction_type"),
        code("channel").alias("channel"),
        *carry,
    )


def is_valid() -> Column:
    return ~missing("account_id") & ~missing("transaction_id") & (
        F.col("transaction_timestamp").isNotNull()
        & F.col("amount").isNotNull()
        & F.col("transaction_type").isNotNull()
    )


def valid_events(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Usable events with their effect on the balance, and further columns of ``raw``."""
    return typed_events(raw, carry).filter(is_valid()).withColumn("signed_amount", signed("amount", "transaction_type"))


def with_record(raw: DataFrame) -> DataFrame:
    """Events with ``_record``, the event as it was delivered."""
    return raw.withColumn("_record", F.to_json(F.struct(*raw.columns)))


def rejected_events(raw: DataFrame) -> DataFrame:
    """The events ``valid_events`` leaves out, each with its reason and as it was delivered."""
    kept = with_record(raw).withColumn("_malformed", optional(raw, CORRUPT).isNotNull())
    reason = (
        F.when(F.col("_malformed"), "MALFORMED_LINE")
        .when(missing("account_id") | missing("transaction_id"), F.lit(fv.NULL_REQUIRED))
        .when(F.col("transaction_timestamp").isNull(), "MISSING_TRANSACTION_TIMESTAMP")
        .when(F.col("amount").isNull(), "MISSING_AMOUNT")
        .when(F.col("transaction_type").isNull(), "MISSING_TRANSACTION_TYPE")
    )
    judged = typed_events(kept, ["_record", "_malformed"]).withColumn("reason", reason).filter(F.col("reason").isNotNull())
    return judged.select(
        F.lit("stream").alias("source"), F.col("transaction_id").alias("record_key"), "reason", F.col("_record").alias("record")
    )


def known_events(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """Events of accounts that exist."""
    return keep_known(events, "account_id", accounts, "account_id")


def counted_once(events: DataFrame) -> DataFrame:
    """One row per (account, transaction): the newest delivery, with the latest time of any."""
    return one_per_key(events, EVENT_KEY, ["transaction_timestamp"])


def impact(events: DataFrame) -> DataFrame:
    """Per account: the sum of effects and the time of the last event."""
    return events.groupBy("account_id").agg(
        F.sum("signed_amount").cast(fv.MONEY).alias("delta_sum"),
        F.max("transaction_timestamp").alias("last_transaction_timestamp"),
    )


def upsert_balances(
    state: DataFrame,
    events: DataFrame,
    accounts: DataFrame,
    updated_at: Column,
    count_repeats: bool = False,
    seen: DataFrame | None = None,
) -> DataFrame:
    """The balance table after a further set of events.

    ``seen`` holds the keys (account, transaction) of the events the state already contains: such an
    event moves the account's last event time but not its balance, unless repeats count.  A new
    account starts from its balance in ``accounts``, or from zero; untouched rows are carried.
    The state is the left side of a join with the impact, so a small set of events is broadcast
    and the state is not shuffled."""
    once = events if count_repeats else counted_once(events)
    if seen is not None and not count_repeats:
        keys = seen.select(*[F.col(k).alias(f"_seen_{k}") for k in EVENT_KEY]).distinct()
        same = [F.col(k) == F.col(f"_seen_{k}") for k in EVENT_KEY]
        fresh_only = F.when(F.col(f"_seen_{EVENT_KEY[0]}").isNull(), F.col("signed_amount")).otherwise(zero())
        once = once.join(keys, same, "left").withColumn("signed_amount", fresh_only)
    change = impact(once).select(
        F.col("account_id").alias("_account"), "delta_sum", F.col("last_transaction_timestamp").alias("_last")
    )
    touched = F.col("_account").isNotNull()
    carried = state.join(change, F.col("account_id") == F.col("_account"), "left").select(
        "account_id",
        (balance("current_balance") + F.coalesce("delta_sum", zero())).cast(fv.MONEY).alias("current_balance"),
        F.greatest("last_transaction_timestamp", "_last").alias("last_transaction_timestamp"),
        F.when(touched, updated_at).otherwise(F.col("updated_at")).alias("updated_at"),
    )
    seeds = accounts.select(F.col("account_id").alias("_seed_account"), F.col("current_balance").alias("_seed"))
    fresh = (
        change.join(state.select("account_id"), F.col("_account") == F.col("account_id"), "left_anti")
        .join(seeds, F.col("_account") == F.col("_seed_account"), "left")
        .select(
            F.col("_account").alias("account_id"),
            (balance("_seed") + F.col("delta_sum")).cast(fv.MONEY).alias("current_balance"),
            F.col("_last").alias("last_transaction_timestamp"),
            updated_at.alias("updated_at"),
        )
    )
    return conform(carried.unionByName(fresh), CURRENT_BALANCES)


def as_recent(events: DataFrame, updated_at: Column) -> DataFrame:
    return conform(events.withColumn("updated_at", updated_at), RECENT_TRANSACTIONS)


def newest_deliveries(rows: DataFrame) -> DataFrame:
    """One row per (account, transaction): by event time, then by write time."""
    return one_per_key(rows, EVENT_KEY, EVENT_ORDER)


def merge_recent(existing: DataFrame, new: DataFrame, limit: int = fv.RECENT_LIMIT) -> DataFrame:
    """The newest ``limit`` transactions of every account over both frames."""
    return keep_recent(existing.unionByName(new), limit)


def keep_recent(rows: DataFrame, limit: int = fv.RECENT_LIMIT) -> DataFrame:
    """By event time, then id.  The time of writing only tells deliveries of one transaction apart, so
    the result does not depend on how events were split into batches."""
    return newest_per_key(newest_deliveries(rows), "account_id", ["transaction_timestamp"], limit, ["transaction_id"])
