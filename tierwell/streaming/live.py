"""Balances and recent transactions kept current from a folder of event files.

Structured Streaming queries, one a table, read the same folder, each with its own checkpoint: files
are remembered there by name, whatever time they are stamped with, so a restart neither skips nor
repeats one.  There is no watermark on event times, because late events must count.  Events that cannot count go to
a table of their own."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tierwell import fixed_values as fv
from tierwell.functions.money import balance, signed, zero
from tierwell.schemas import CURRENT_BALANCES, RECENT_TRANSACTIONS, conform
from tierwell.sources.readers import stream_jsonl
from tierwell.sources.sinks import overwrite
from tierwell.streaming import latency, repeats
from tierwell.streaming.events import EVENT_KEY, as_recent, impact, keep_recent, rejected_events, valid_events, with_record
from tierwell.streaming.keyed_log import BUCKETS, KeyedLog

Clock = Callable[[], datetime]
TABLES = ("current_balances", "recent_transactions", "rejected_events")
_CHANGE = T.StructType(
    [
        T.StructField("account_id", T.StringType()),
        T.StructField("delta_sum", T.DecimalType(18, 2)),
        T.StructField("last_transaction_timestamp", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("seed", T.DecimalType(18, 2)),
    ]
)
_REJECT = T.StructType([T.StructField(n, T.StringType()) for n in ("source", "record_key", "reason", "record")])


def _added_up(rows: DataFrame) -> DataFrame:
    return rows.groupBy("account_id").agg(
        F.sum("delta_sum").cast(fv.MONEY).alias("delta_sum"),
        F.max("last_transaction_timestamp").alias("last_transaction_timestamp"),
        F.max("updated_at").alias("updated_at"),
        # The balance an account started from when it was first touched, whatever it is later on.
        F.min_by("seed", F.when(F.col("seed").isNotNull(), F.col("batch"))).alias("seed"),
        F.max("batch").alias("batch"),
    )


def _deliveries(events: DataFrame) -> DataFrame:
    """Per (account, transaction), over the whole stream: the newest delivery, and the times of the
    first and the last micro-batch that brought one.

    Kept in Spark's state store.  Deliveries are combined per task before they are shuffled, so
    neither a busy account nor an endlessly repeated transaction loads one task."""
    newest = F.max(F.struct("transaction_timestamp", "amount", "transaction_type"))
    return (
        # The time of the micro-batch, the same for all its rows and on a retry.
        events.withColumn("_batch_time", F.current_timestamp())
        .groupBy(*EVENT_KEY)
        .agg(newest.alias("newest"), F.min("_batch_time").alias("first_seen"), F.max("_batch_time").alias("last_seen"))
    )


def _change(touched: DataFrame) -> DataFrame:
    """What one micro-batch does to the accounts: effects of transactions seen for the first time,
    and the last event time over all.  A repeat moves the clock but not the balance."""
    effect = signed("newest.amount", "newest.transaction_type")
    new = F.col("first_seen") == F.col("last_seen")
    return touched.select(
        "account_id",
        F.when(new, effect).otherwise(zero()).alias("signed_amount"),
        F.col("newest.transaction_timestamp").alias("transaction_timestamp"),
    )


def _now() -> datetime:
    return datetime.now(timezone.utc)


class LiveTables:
    """The tables below ``root``.  ``root`` must be reachable by every executor.

    ``buckets`` says into how many parts the accounts are dealt; a compaction rewrites only parts with
    an account that has had events."""

    def __init__(self, spark: SparkSession, root: str, limit: int = fv.RECENT_LIMIT, buckets: int = BUCKETS):
        self.spark, self.root, self.limit = spark, root.rstrip("/"), limit
        # A log row holds what one batch changed, so the rows of an account add up.
        self.balances = KeyedLog(spark, f"{self.root}/current_balances", _CHANGE, _added_up, "account_id", buckets)
        # Cutting each batch to its own newest rows loses nothing: whatever is beyond the limit
        # in one batch is beyond it in any union that contains the batch.
        self.recent = KeyedLog(
            spark, f"{self.root}/recent_transactions", RECENT_TRANSACTIONS, lambda rows: keep_recent(rows, limit), "account_id", buckets
        )
        self.rejects = KeyedLog(spark, f"{self.root}/rejected_events", _REJECT, lambda rows: rows)
        self.repeats = KeyedLog(spark, f"{self.root}/repeated_deliveries", _REJECT, lambda rows: rows)
        self.delays = KeyedLog(spark, f"{self.root}/latency", latency.HISTOGRAM, latency.merged, "sla", 1)

    # -- reading -----------------------------------------------------------------------------

    def current_balances(
        self, accounts: DataFrame | None = None, keep_orphans: bool = True, only: Sequence[str] | None = None
    ) -> DataFrame:
        """One row per account with events: its starting balance plus all effects.  ``only`` names
        accounts to look up, of which only the buckets are read.

        An account starts from the balance stored when it was first touched (see ``start``), else from
        its balance in ``accounts``, else from zero.  With ``keep_orphans`` off, accounts unknown to
        ``accounts`` are left out."""
        changes = self.balances.read() if only is None else self.balances.lookup(only)
        if accounts is None:
            total = (balance("seed") + F.coalesce("delta_sum", zero())).cast(fv.MONEY)
            return conform(changes.withColumn("current_balance", total), CURRENT_BALANCES)
        seeds = accounts.select(F.col("account_id").alias("_seed_account"), F.col("current_balance").alias("_seed"))
        joined = changes.join(
            seeds, F.col("account_id") == F.col("_seed_account"), "left" if keep_orphans else "inner"
        )
        total = (balance("seed", "_seed") + F.coalesce("delta_sum", zero())).cast(fv.MONEY)
        return conform(joined.withColumn("current_balance", total), CURRENT_BALANCES)

    def recent_transactions(self, only: Sequence[str] | None = None) -> DataFrame:
        return self.recent.read() if only is None else self.recent.lookup(only)

    def rejected_events(self) -> DataFrame:
        """Events that could not count, each as delivered and with its reason; with ``repeats_within``
        also the deliveries that were dropped as repeats."""
        return self.rejects.read().unionByName(self.repeats.read())

    def latency(self) -> DataFrame:
        """How long after their events the rows of ``recent_transactions`` were written: their number by
        class and step (see ``streaming.latency``), over all micro-batches."""
        return self.delays.read()

    def publish(self, accounts: DataFrame | None = None, fmt: str = "parquet") -> dict[str, str]:
        """Write both tables as of the last micro-batch, in their specified schemas, for any reader of
        files; the path of each.  An older state stays where it is."""
        tables = {"current_balances": (self.balances, self.current_balances(accounts)), "recent_transactions": (self.recent, self.recent_transactions())}
        return {name: overwrite(df, f"{self.root}/tables/{name}/batch={log.newest()}", fmt) for name, (log, df) in tables.items() if log.newest() is not None}

    # -- running -----------------------------------------------------------------------------

    def start(
        self,
        folder: str,
        files_per_batch: int | None = None,
        count_repeats: bool = False,
        clock: Clock = _now,
        every: str | None = None,
        glob: str = fv.STREAM_FILE_GLOB,
        tables: Sequence[str] = TABLES,
        accounts: DataFrame | None = None,
        repeats_within: str | None = None,
        listener: StreamingQueryListener | None = None,
    ) -> list[StreamingQuery]:
        """Start the queries for ``tables``: over what is there now, or with ``every`` (e.g.
        "30 seconds") for good.

        A repeated delivery of an (account, transaction) counts once; with ``count_repeats`` each
        delivery counts.  Copies are taken to carry the same amount: what counts is the newest of those
        in the first micro-batch that brings one.  With ``accounts`` an account's balance there is stored
        when it is first touched (zero if it has none), so that later states of ``accounts`` change nothing.

        Transactions are remembered for good.  With ``repeats_within`` (e.g. "7 days") one is forgotten that
        long after it first arrived, which bounds the state; a repeat within that time does not count and
        becomes a rejected event, one after it counts again.  Repeats of one transaction within a micro-batch
        then meet in one task.  The checkpoint below ``root`` holds the kind of state it was started with, so
        this choice stays.  ``listener`` is told about each micro-batch (``latency.BatchTimes`` remembers them)."""
        if count_repeats and repeats_within:
            raise ValueError("either every delivery counts or repeats are dropped for a time, not both")
        session = self._session()
        if listener is not None:
            session.streams.addListener(listener)

        def append(log: KeyedLog, prepare: Callable[[DataFrame], DataFrame]):
            def write(batch: DataFrame, number: int) -> None:
                log.on(batch.sparkSession).append(prepare(batch), number)

            return write

        def append_recent(batch: DataFrame, number: int) -> None:
            mine = self.recent.on(batch.sparkSession)
            mine.append(keep_recent(as_recent(batch, stamp()), self.limit), number)
            self.delays.on(batch.sparkSession).append(latency.histogram(mine.written(number)), number)

        def append_within(batch: DataFrame, number: int) -> None:
            # Two tables are written from one pass over the state.
            each = repeats.deliveries(batch).persist()
            found = repeats.judged(each)
            try:
                self.repeats.on(batch.sparkSession).append(repeats.dropped(found), number)
                self.balances.on(batch.sparkSession).append(changes(repeats.effects(found)), number)
            finally:
                each.unpersist()

        def changes(effects: DataFrame) -> DataFrame:
            return seeded(impact(effects)).withColumn("updated_at", stamp())

        def stamp():
            return F.lit(clock()).cast("timestamp")

        def run(name: str, df: DataFrame, mode: str, write) -> StreamingQuery:
            writer = (
                df.writeStream.queryName(name)
                .outputMode(mode)
                .foreachBatch(write)
                .option("checkpointLocation", f"{self.root}/_checkpoints/{name}")
            )
            trigger = {"processingTime": every} if every else {"availableNow": True}
            return writer.trigger(**trigger).start()

        raw = stream_jsonl(session, folder, files_per_batch=files_per_batch, glob=glob)
        events = valid_events(raw)

        def seeded(change: DataFrame) -> DataFrame:
            if accounts is None:
                return change.withColumn("seed", F.lit(None).cast(fv.MONEY))
            seeds = accounts.select(F.col("account_id").alias("_seed_account"), F.col("current_balance").alias("_seed"))
            return change.join(seeds, F.col("account_id") == F.col("_seed_account"), "left").withColumn("seed", balance("_seed"))

        def start_balances(name: str) -> StreamingQuery:
            if repeats_within:
                delivered = valid_events(with_record(raw), ["_record"])
                return run(name, repeats.marked(delivered, repeats_within), "append", append_within)
            if count_repeats:
                return run(name, events, "append", append(self.balances, changes))
            return run(name, _deliveries(events), "update", append(self.balances, lambda b: changes(_change(b))))

        starts = {
            "current_balances": start_balances,
            "recent_transactions": lambda name: run(name, events, "append", append_recent),
            "rejected_events": lambda name: run(name, rejected_events(raw), "append", append(self.rejects, lambda b: b)),
        }
        return [starts[name](name) for name in tables]

    def drain(self, folder: str, **settings) -> None:
        """Process every file that is there, then return."""
        for query in self.start(folder, **settings):
            query.awaitTermination()

    def compact(self) -> None:
        for log in (self.balances, self.recent, self.rejects, self.repeats, self.delays):
            log.compact()

    def _session(self) -> SparkSession:
        """A sibling session whose state store keeps keys on disk, so state may exceed memory."""
        session = self.spark.newSession()
        for name in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
            session.conf.set(name, self.spark.conf.get(name))
        session.conf.set(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
        session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        return session
