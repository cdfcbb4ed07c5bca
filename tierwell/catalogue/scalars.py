"""Column functions and predicates."""

from pyspark.sql import functions as F

from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import AS_OF, Roles
from tierwell.catalogue.sql import parsed_date, shown, sql, stamp, surrogate
from tierwell.fixed_values import CHANNELS, DEFAULT_NULL_FIELDS, TRANSACTION_TYPES
from tierwell.functions import keys, money, temporal, text
from tierwell.operators import key_map
from tierwell.plans.silver import typed_transactions
from tierwell.sources.shared import fresh_path


@query(
    "norm_trim_upper",
    sql(
        """SELECT trim(customer_id) AS customer_id, upper(trim(gender)) AS gender,
            upper(trim(income_band)) AS income_band, upper(trim(segment)) AS segment,
            upper(trim(kyc_status)) AS kyc_status FROM raw_customers""",
        "raw_customers",
    ),
)
def _(spark, folder):
    names = ["gender", "income_band", "segment", "kyc_status"]
    return Roles(spark, folder).customers.select(
        text.text("customer_id").alias("customer_id"), *[text.code(c).alias(c) for c in names]
    )


@query(
    "json_field_extract",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
        json_extract_string(props, '$.absent') AS absent FROM events""",
)
def _(spark, folder):
    return Roles(spark, folder).table("events").select(
        "event_id",
        F.get_json_object("props", "$.k").try_cast("bigint").alias("k"),
        F.get_json_object("props", "$.absent").alias("absent"),
    )


@query(
    "parse_date_multiformat",
    sql(
        f"""SELECT transaction_id, raw, strftime(parsed, '%Y-%m-%d') AS parsed FROM (
            SELECT transaction_id, transaction_date AS raw, {parsed_date("transaction_date")} AS parsed FROM stream_raw)""",
        "stream_raw",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).stream_raw.select(
        "transaction_id", F.col("transaction_date").alias("raw"), temporal.parse_date("transaction_date").alias("parsed")
    )


@query(
    "compose_timestamp",
    sql(
        f"""SELECT transaction_id, strftime(composed, '%Y-%m-%d %H:%M:%S') AS composed FROM (
            SELECT transaction_id, {stamp("day", "transaction_time")} AS composed FROM (
                SELECT transaction_id, {parsed_date("transaction_date")} AS day, transaction_time FROM raw_transactions))""",
        "raw_transactions",
    ),
)
def _(spark, folder):
    day = temporal.parse_date("transaction_date")
    return Roles(spark, folder).transactions.select(
        "transaction_id", temporal.compose_timestamp(day, "transaction_time").alias("composed")
    )


@query(
    "amount_try_cast",
    sql(
        """SELECT transaction_id, amount AS raw, CAST(TRY_CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount
        FROM raw_transactions""",
        "raw_transactions",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).transactions.select(
        "transaction_id", F.col("amount").alias("raw"), money.money("amount").alias("amount")
    )


@query(
    "currency_normalise",
    sql(
        """SELECT currency AS raw, 'ZAR' AS loose,
            CASE WHEN upper(trim(currency)) IN ('ZAR', 'R', 'RANDS', '710') THEN 'ZAR' END AS strict,
            count(*) AS records FROM raw_transactions GROUP BY 1, 2, 3""",
        "raw_transactions",
    ),
)
def _(spark, folder):
    return (
        Roles(spark, folder)
        .transactions.groupBy(
            F.col("currency").alias("raw"),
            text.currency("currency").alias("loose"),
            text.currency("currency", strict=True).alias("strict"),
        )
        .agg(F.count(F.lit(1)).alias("records"))
    )


@query(
    "surrogate_key_hash",
    sql(f"SELECT account_id, {surrogate('account_id')} AS account_sk FROM raw_accounts", "raw_accounts"),
)
def _(spark, folder):
    return Roles(spark, folder).accounts.select("account_id", keys.hashed_key("account_id").alias("account_sk"))


@query(
    "surrogate_key_rownum",
    sql(
        """SELECT account_id, row_number() OVER (ORDER BY account_id) AS account_sk
        FROM (SELECT DISTINCT account_id FROM raw_accounts WHERE account_id IS NOT NULL)""",
        "raw_accounts",
    ),
)
def _(spark, folder):
    ids = Roles(spark, folder).accounts.select("account_id").dropna().distinct()
    return keys.sequential_key(ids, "account_id", "account_sk")


@query(
    "surrogate_key_kept",
    sql(
        """SELECT account_id, CASE WHEN early THEN row_number() OVER (PARTITION BY early ORDER BY account_id)
            ELSE row_number() OVER (PARTITION BY early ORDER BY account_id) + count(*) FILTER (WHERE early) OVER () END AS account_sk
        FROM (SELECT DISTINCT account_id, right(account_id, 1) > '4' AS early FROM raw_accounts WHERE account_id IS NOT NULL)""",
        "raw_accounts",
    ),
)
def _(spark, folder):
    """Two runs: the second brings keys that sort before those of the first, which keep their numbers."""
    ids = Roles(spark, folder).accounts.select("account_id")
    kept = key_map.KeyMap(spark, fresh_path(spark, "key-map"))
    kept.extend(ids.filter(F.right("account_id", F.lit(1)) > "4"), "account_id")
    kept.extend(ids, "account_id")
    return kept.numbered(ids.dropna().distinct(), "account_id", "account_sk")


@query(
    "explode_flags",
    sql(
        """SELECT flag, count(*) AS customers, count(DISTINCT customer_id) AS distinct_customers FROM (
            SELECT customer_id, trim(unnest(string_split(product_flags, '|'))) AS flag
            FROM raw_customers WHERE trim(product_flags) <> '') GROUP BY flag""",
        "raw_customers",
    ),
)
def _(spark, folder):
    return (
        Roles(spark, folder)
        .customers.select("customer_id", F.explode(text.flags("product_flags")).alias("flag"))
        .groupBy("flag")
        .agg(F.count(F.lit(1)).alias("customers"), F.count_distinct("customer_id").alias("distinct_customers"))
    )


@query(
    "parse_coordinates",
    sql(
        """SELECT coordinates, TRY_CAST(string_split(coordinates, ',')[1] AS DOUBLE) AS latitude,
            TRY_CAST(string_split(coordinates, ',')[2] AS DOUBLE) AS longitude, count(*) AS records
        FROM raw_transactions GROUP BY coordinates""",
        "raw_transactions",
    ),
)
def _(spark, folder):
    counted = (
        Roles(spark, folder)
        .transactions.groupBy(F.col("location.coordinates").alias("coordinates"))
        .agg(F.count(F.lit(1)).alias("records"))
    )
    parsed = counted.withColumn("_at", text.latitude_longitude("coordinates"))
    return parsed.select("coordinates", "_at.latitude", "_at.longitude", "records")


@query(
    "age_band",
    sql(
        """SELECT s.customer_id, CAST(floor((DATE '2026-01-01' - dob) / 365.25) AS BIGINT) AS age, age_band
        FROM silver_customers s JOIN dim_customers d ON s.customer_id = d.customer_id""",
        "silver_customers",
        "dim_customers",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).silver_customers.select(
        "customer_id",
        temporal.age_years("dob", AS_OF).alias("age"),
        temporal.age_band("dob", AS_OF).alias("age_band"),
    )


@query(
    "signed_amount",
    sql(
        f"SELECT {shown('account_id', 'transaction_id', 'transaction_type', 'amount:n', 'signed_amount:n')} FROM stream_events",
        "stream_events",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).events.select(
        "account_id", "transaction_id", "transaction_type", "amount", "signed_amount"
    )


def _missing_sql(field: str) -> str:
    return f"count(*) FILTER (coalesce(trim({field}), '') = '') AS {field}"


@query(
    "missing_required",
    sql(
        f"""SELECT {", ".join(_missing_sql(f) for f in DEFAULT_NULL_FIELDS)},
            count(*) FILTER (null_required) AS any_missing, count(*) AS records FROM decided""",
        "decided",
    ),
)
def _(spark, folder):
    typed = typed_transactions(Roles(spark, folder).transactions)
    tests = {f: text.missing(f) for f in DEFAULT_NULL_FIELDS}
    return typed.agg(
        *[F.count_if(t).alias(f) for f, t in tests.items()],
        F.count_if(text.any_of(tests.values())).alias("any_missing"),
        F.count(F.lit(1)).alias("records"),
    )


@query(
    "domain_violation",
    sql(
        """SELECT transaction_type, channel,
            coalesce(transaction_type NOT IN ('DEBIT', 'CREDIT', 'FEE', 'REVERSAL'), false) AS bad_type,
            coalesce(channel NOT IN ('POS', 'APP', 'ATM', 'EFT', 'USSD', 'INTERNAL'), false) AS bad_channel,
            false AS unrestricted, count(*) AS records
        FROM typed_transactions GROUP BY ALL""",
        "typed_transactions",
    ),
)
def _(spark, folder):
    return (
        typed_transactions(Roles(spark, folder).transactions)
        .groupBy("transaction_type", "channel")
        .agg(F.count(F.lit(1)).alias("records"))
        .select(
            "transaction_type",
            "channel",
            text.outside("transaction_type", TRANSACTION_TYPES).alias("bad_type"),
            text.outside("channel", CHANNELS).alias("bad_channel"),
            text.outside("channel", []).alias("unrestricted"),
            "records",
        )
    )
