"""Stream events, the batch formulas over them, and the live tables."""

from datetime import timezone

from pyspark.sql import functions as F

from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import FIRST_WRITE, HALFWAY, SECOND_WRITE, Roles
from tierwell.catalogue.sql import parsed_date, shown, sql
from tierwell.functions.temporal import latency_seconds, sla_class
from tierwell.schemas import CURRENT_BALANCES
from tierwell.sources.readers import empty, read_table
from tierwell.sources.shared import fresh_path, stored
from tierwell.streaming import events as ev
from tierwell.streaming import latency
from tierwell.streaming.live import LiveTables

_EVENT = shown("account_id", "transaction_id", "transaction_timestamp:t", "amount:n", "transaction_type", "channel")
_RECENT = _EVENT + ", updated_at"
_BALANCE = shown("account_id", "current_balance:n", "last_transaction_timestamp:t") + ", updated_at"


def _stamp(moment):
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp")


@query("stream_valid_events", sql(f"SELECT {_EVENT} FROM stream_events", "stream_events"))
def _(spark, folder):
    return Roles(spark, folder).events.drop("signed_amount")


@query(
    "stream_orphan_filter",
    sql(
        f"SELECT {_EVENT} FROM stream_events WHERE account_id IN (SELECT account_id FROM stream_accounts)",
        "stream_events",
        "stream_accounts",
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    return ev.known_events(roles.events, roles.stream_accounts).drop("signed_amount")


@query(
    "event_impact",
    sql(
        f"""SELECT {shown("account_id", "delta_sum:n", "last_transaction_timestamp:t")} FROM (
            SELECT account_id, sum(signed_amount) AS delta_sum, max(transaction_timestamp) AS last_transaction_timestamp
            FROM stream_events GROUP BY account_id)""",
        "stream_events",
    ),
)
def _(spark, folder):
    return ev.impact(Roles(spark, folder).events)


#: Of the earlier half every transaction whose number ends in 0 comes again with the later half.
_AGAIN = "transaction_id LIKE '%0'"
_LATER = f"transaction_timestamp >= TIMESTAMP '{HALFWAY}'"
_ONCE = f"""SELECT account_id, any_value(signed_amount) AS signed_amount, max(transaction_timestamp) AS last_at,
        bool_or({_LATER} OR {_AGAIN}) AS second, bool_or(NOT {_LATER} OR {_AGAIN}) AS second_if_later_first
    FROM stream_events GROUP BY account_id, transaction_id"""
_EACH = f"SELECT account_id, signed_amount, transaction_timestamp AS last_at, {_LATER} AS second FROM stream_events"


def _balances_sql(events: str, second: str = "second") -> str:
    return f"""SELECT {_BALANCE} FROM (
        SELECT e.account_id AS account_id, coalesce(any_value(a.current_balance), 0) + sum(signed_amount) AS current_balance,
            max(last_at) AS last_transaction_timestamp,
            CASE WHEN bool_or({second}) THEN '{SECOND_WRITE}' ELSE '{FIRST_WRITE}' END AS updated_at
        FROM ({events}) e LEFT JOIN stream_accounts a ON e.account_id = a.account_id GROUP BY e.account_id)"""


def _in_two_steps(roles: Roles, first, second, **settings):
    start = empty(roles.spark, CURRENT_BALANCES)
    state = ev.upsert_balances(start, first, roles.stream_accounts, _stamp(FIRST_WRITE), **settings)
    seen = None if settings.get("count_repeats") else first.select(*ev.EVENT_KEY)
    return ev.upsert_balances(
        stored(state, "balances"), second, roles.stream_accounts, _stamp(SECOND_WRITE), seen=seen, **settings
    )


@query("balance_upsert", sql(_balances_sql(_ONCE), "stream_events", "stream_accounts"))
def _(spark, folder):
    """Some of the first half is delivered again with the second, and still counts once."""
    roles = Roles(spark, folder)
    again = roles.earlier_events.filter(F.col("transaction_id").endswith("0"))
    return _in_two_steps(roles, roles.earlier_events, roles.later_events.unionByName(again))


@query(
    "balance_upsert_every_delivery",
    sql(_balances_sql(_EACH), "stream_events", "stream_accounts"),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    return _in_two_steps(roles, roles.earlier_events, roles.later_events, count_repeats=True)


@query(
    "late_event_semantics",
    sql(_balances_sql(_ONCE, "second_if_later_first"), "stream_events", "stream_accounts"),
)
def _(spark, folder):
    """The later half arrives first, with some of the earlier; late events still count, repeats count
    once, and the last event time never falls."""
    roles = Roles(spark, folder)
    again = roles.later_events.filter(F.col("transaction_id").endswith("0"))
    return _in_two_steps(roles, roles.later_events, roles.earlier_events.unionByName(again))


_NEWEST = f"""SELECT *, CASE WHEN transaction_timestamp >= TIMESTAMP '{HALFWAY}'
        THEN '{SECOND_WRITE}' ELSE '{FIRST_WRITE}' END AS updated_at FROM stream_events
    QUALIFY row_number() OVER (PARTITION BY account_id, transaction_id
        ORDER BY transaction_timestamp DESC, amount DESC, transaction_type DESC, channel DESC NULLS LAST) = 1"""


def _top_sql(events: str, limit: int) -> str:
    return f"""SELECT {_RECENT} FROM (SELECT * FROM ({events})
        QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY transaction_timestamp DESC, transaction_id) <= {limit})"""


def _stamped(roles: Roles):
    earlier = ev.as_recent(roles.earlier_events, _stamp(FIRST_WRITE))
    return earlier, ev.as_recent(roles.later_events, _stamp(SECOND_WRITE))


@query("recent_dedupe", sql(f"SELECT {_RECENT} FROM ({_NEWEST})", "stream_events"))
def _(spark, folder):
    earlier, later = _stamped(Roles(spark, folder))
    return ev.newest_deliveries(earlier.unionByName(later))


@query("top_n_per_key", sql(_top_sql(_NEWEST, 50), "stream_events"))
def _(spark, folder):
    earlier, later = _stamped(Roles(spark, folder))
    return ev.keep_recent(earlier.unionByName(later))


@query("recent_merge", sql(_top_sql(_NEWEST, 10), "stream_events"))
def _(spark, folder):
    """The first half cut to its newest rows, then merged with the second half."""
    earlier, later = _stamped(Roles(spark, folder))
    return ev.merge_recent(ev.keep_recent(earlier, 10), later, 10)


#: A write delay that depends on the amount: three seconds per unit, and a fraction for even ones.
_MICROS = """CAST(floor(amount) AS BIGINT) * 3000000
            + CASE WHEN CAST(floor(amount) AS BIGINT) % 2 = 0 THEN 900000 ELSE 0 END AS micros"""


def _written(roles: Roles):
    whole = F.floor("amount").cast("bigint")
    micros = whole * 3_000_000 + F.when(whole % 2 == 0, 900_000).otherwise(0)
    return roles.events.withColumn("updated_at", F.timestamp_micros(F.unix_micros("transaction_timestamp") + micros))


@query(
    "latency_histogram",
    sql(
        f"""SELECT sla, up_to_seconds, count(*) AS rows FROM (SELECT
            CASE WHEN micros <= 300000000 THEN 'full' WHEN micros <= 600000000 THEN 'partial' ELSE 'none' END AS sla,
            CASE WHEN micros <= 0 THEN 0 ELSE (SELECT min(1 << k) FROM range(41) t(k)
                WHERE (CAST(1 AS BIGINT) << k) * 1000000 >= micros) END AS up_to_seconds
            FROM (SELECT {_MICROS} FROM stream_events)) GROUP BY ALL""",
        "stream_events",
    ),
)
def _(spark, folder):
    """Histograms of the earlier and the later half, merged."""
    rows = _written(Roles(spark, folder))
    later = F.col("transaction_timestamp") >= F.lit(HALFWAY).cast("timestamp")
    halves = [latency.histogram(rows.filter(half)) for half in (later, ~later)]
    return latency.merged(halves[0].unionByName(halves[1]))


@query(
    "sla_latency_class",
    sql(
        """SELECT transaction_id, CAST(micros // 1000000 AS BIGINT) AS latency,
            CASE WHEN micros <= 300000000 THEN 'full' WHEN micros <= 600000000 THEN 'partial' ELSE 'none' END AS sla
        FROM (SELECT transaction_id, CAST(floor(amount) AS BIGINT) * 3000000
            + CASE WHEN CAST(floor(amount) AS BIGINT) % 2 = 0 THEN 900000 ELSE 0 END AS micros FROM stream_events)""",
        "stream_events",
    ),
)
def _(spark, folder):
    """A write delay that depends on the amount: three seconds per unit, and a fraction for even ones."""
    return _written(Roles(spark, folder)).select(
        "transaction_id",
        latency_seconds("transaction_timestamp", "updated_at").alias("latency"),
        sla_class("transaction_timestamp", "updated_at").alias("sla"),
    )


def _live(roles: Roles, **settings) -> LiveTables:
    """Run the stream over the events, written as JSON lines, in about three micro-batches."""
    spark = roles.spark
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    incoming = fresh_path(spark, "stream-in")
    roles.stream_raw.repartition(files).write.json(incoming)
    live = LiveTables(spark, fresh_path(spark, "stream-out"))
    live.drain(
        incoming,
        files_per_batch=-(-files // 3),
        clock=lambda: FIRST_WRITE.replace(tzinfo=timezone.utc),
        glob="*.json",
        **settings,
    )
    return live


@query(
    "stream_rejects",
    sql(
        """SELECT nullif(trim(transaction_id), '') AS record_key, trim(account_id) AS account_id, amount AS delivered_amount,
            CASE WHEN coalesce(trim(account_id), '') = '' OR coalesce(trim(transaction_id), '') = '' THEN 'NULL_REQUIRED'
                WHEN day IS NULL OR NOT coalesce(regexp_full_match(trim(transaction_time), '\\d{2}:\\d{2}:\\d{2}'), false)
                    THEN 'MISSING_TRANSACTION_TIMESTAMP'
                WHEN TRY_CAST(amount AS DECIMAL(18,2)) IS NULL THEN 'MISSING_AMOUNT' ELSE 'MISSING_TRANSACTION_TYPE' END AS reason
        FROM (SELECT *, """
        + parsed_date("transaction_date")
        + """ AS day FROM stream_raw)
        WHERE coalesce(trim(account_id), '') = '' OR coalesce(trim(transaction_id), '') = '' OR day IS NULL
            OR NOT coalesce(regexp_full_match(trim(transaction_time), '\\d{2}:\\d{2}:\\d{2}'), false)
            OR TRY_CAST(amount AS DECIMAL(18,2)) IS NULL OR transaction_type IS NULL""",
        "stream_raw",
    ),
)
def _(spark, folder):
    """What the stream leaves out, with fields read back from the records as delivered."""
    found = ev.rejected_events(Roles(spark, folder).stream_raw)
    return found.select(
        "record_key",
        F.trim(F.get_json_object("record", "$.account_id")).alias("account_id"),
        F.get_json_object("record", "$.amount").alias("delivered_amount"),
        "reason",
    )


_LIVE_BALANCES = sql(
    f"""SELECT {shown("account_id", "current_balance:n", "last_transaction_timestamp:t")} FROM (
        SELECT e.account_id AS account_id, coalesce(any_value(a.current_balance), 0) + sum(signed_amount) AS current_balance,
            max(last_at) AS last_transaction_timestamp
        FROM (SELECT account_id, transaction_id, any_value(signed_amount) AS signed_amount,
                max(transaction_timestamp) AS last_at FROM stream_events GROUP BY account_id, transaction_id) e
            LEFT JOIN stream_accounts a ON e.account_id = a.account_id GROUP BY e.account_id)""",
    "stream_events",
    "stream_accounts",
)


@query("live_current_balances", _LIVE_BALANCES)
def _(spark, folder):
    roles = Roles(spark, folder)
    live = _live(roles, tables=["current_balances"], accounts=roles.stream_accounts)
    path = live.publish()["current_balances"]
    return read_table(spark, path).drop("updated_at")


@query("live_balances_bounded", _LIVE_BALANCES)
def _(spark, folder):
    """With a memory of repeats that ends, here long after the stream does."""
    roles = Roles(spark, folder)
    live = _live(roles, tables=["current_balances"], accounts=roles.stream_accounts, repeats_within="30 days")
    return live.current_balances().drop("updated_at")


@query(
    "live_repeats_recorded",
    sql(
        """SELECT transaction_id AS record_key, account_id, count(*) - 1 AS dropped FROM stream_events
        GROUP BY transaction_id, account_id HAVING count(*) > 1""",
        "stream_events",
    ),
)
def _(spark, folder):
    """Every delivery beyond the first of a transaction is among the rejected events."""
    live = _live(Roles(spark, folder), tables=["current_balances"], repeats_within="30 days")
    account = F.trim(F.get_json_object("record", "$.account_id")).alias("account_id")
    return live.rejected_events().groupBy("record_key", account).agg(F.count(F.lit(1)).alias("dropped"))


@query(
    "live_recent_transactions",
    sql(
        f"""SELECT {_EVENT} FROM (SELECT * FROM ({_NEWEST}) QUALIFY row_number() OVER (
            PARTITION BY account_id ORDER BY transaction_timestamp DESC, transaction_id) <= 50)""",
        "stream_events",
    ),
)
def _(spark, folder):
    live = _live(Roles(spark, folder), tables=["recent_transactions"])
    return read_table(spark, live.publish()["recent_transactions"]).drop("updated_at")
