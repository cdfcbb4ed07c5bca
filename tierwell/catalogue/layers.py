"""Deduplication, joins and the layer tables."""

from pyspark.sql import functions as F

from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import Roles
from tierwell.catalogue.sql import shown, sql
from tierwell.operators.dedupe import group_sizes, one_per_key
from tierwell.operators.linking import keep_known, mark_known, orphan
from tierwell.plans import gold, silver
from tierwell.sources.shared import stored
from tierwell.sources.sinks import quarantine_rows

_SILVER_TXN = shown(
    "transaction_id", "account_id", "transaction_date:d", "transaction_time", "transaction_timestamp:t",
    "transaction_type", "merchant_category", "merchant_subcategory", "amount:n", "currency", "channel",
    "province", "dq_flag", "dq_exclusion", "ingestion_timestamp:t",
)
_SURVIVOR = ["transaction_id", "account_id", "transaction_timestamp", "amount", "ingestion_timestamp", "copies"]
_SURVIVOR_SQL = shown(
    "transaction_id", "account_id", "transaction_timestamp:t", "amount:n", "ingestion_timestamp:t"
) + ", dup_count AS copies"


def _survivors(roles: Roles, keep: str):
    return roles.judged(keep=keep).withColumnRenamed("_dup_count", "copies").select(*_SURVIVOR)


@query("dedupe_txn_latest", sql(f"SELECT {_SURVIVOR_SQL} FROM single", "single"))
def _(spark, folder):
    return _survivors(Roles(spark, folder), "latest")


@query("dedupe_txn_earliest", sql(f"SELECT {_SURVIVOR_SQL} FROM single_earliest", "single_earliest"))
def _(spark, folder):
    return _survivors(Roles(spark, folder), "earliest")


@query(
    "dedupe_latest",
    """SELECT * EXCLUDE (l_shipdate), strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC,
        l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
        l_linestatus DESC) = 1""",
)
def _(spark, folder):
    return one_per_key(Roles(spark, folder).table("lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query(
    "dup_count",
    sql(
        """SELECT transaction_id, count(*) AS copies FROM raw_transactions
        WHERE coalesce(transaction_id, '') <> '' GROUP BY transaction_id""",
        "raw_transactions",
    ),
)
def _(spark, folder):
    return group_sizes(Roles(spark, folder).transactions, "transaction_id", "copies")


@query(
    "orphan_mark",
    sql(
        """SELECT transaction_id, trim(t.account_id) AS account_id, a.account_id AS matched, a.account_id IS NULL AS orphaned
        FROM raw_transactions t LEFT JOIN silver_accounts a ON trim(t.account_id) = a.account_id""",
        "raw_transactions",
        "silver_accounts",
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    trimmed = roles.transactions.select("transaction_id", F.trim("account_id").alias("account_id"))
    return mark_known(trimmed, "account_id", roles.silver_accounts, "account_id", "matched").withColumn(
        "orphaned", orphan("matched")
    )


@query(
    "referential_cut",
    sql(
        """SELECT account_id, customer_ref FROM silver_accounts
        WHERE customer_ref IN (SELECT customer_id FROM silver_customers)""",
        "silver_accounts",
        "silver_customers",
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    return keep_known(roles.silver_accounts, "customer_ref", roles.silver_customers, "customer_id").select(
        "account_id", "customer_ref"
    )


@query(
    "silver_accounts",
    sql(
        f"""SELECT {shown(
            "account_id", "customer_ref", "account_type", "account_status", "open_date:d", "product_tier",
            "mobile_number", "digital_channel", "credit_limit:n", "current_balance:n", "last_activity_date:d",
            "ingestion_timestamp:t")} FROM silver_accounts""",
        "silver_accounts",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).silver_accounts


@query(
    "silver_customers",
    sql(
        f"""SELECT {shown(
            "customer_id", "id_number", "first_name", "last_name", "dob:d", "gender", "province", "income_band",
            "segment", "risk_score", "kyc_status", "product_flags", "ingestion_timestamp:t")} FROM silver_customers""",
        "silver_customers",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).silver_customers


@query("silver_transactions", sql(f"SELECT {_SILVER_TXN} FROM judged", "judged"))
def _(spark, folder):
    return Roles(spark, folder).silver_transactions


@query("gold_dim_customers", sql("SELECT * FROM dim_customers", "dim_customers"))
def _(spark, folder):
    return Roles(spark, folder).dim_customers


@query(
    "gold_dim_accounts",
    sql(
        f"""SELECT {shown(
            "account_sk", "account_id", "customer_id", "account_type", "account_status", "open_date:d", "product_tier",
            "digital_channel", "credit_limit:n", "current_balance:n", "last_activity_date:d")} FROM dim_accounts""",
        "dim_accounts",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).dim_accounts


@query(
    "gold_fact",
    sql(
        f"""SELECT {shown(
            "transaction_sk", "transaction_id", "account_sk", "customer_sk", "transaction_date:d",
            "transaction_timestamp:t", "transaction_type", "merchant_category", "merchant_subcategory", "amount:n",
            "currency", "channel", "province", "dq_flag", "ingestion_timestamp:t")} FROM fact""",
        "fact",
    ),
)
def _(spark, folder):
    return Roles(spark, folder).fact


REJECTED_STEPS = ("judged", "silver_accounts", "dim_customers", "typed_accounts", "newest_accounts")
#: Why a row of ``judged t`` with its account ``a`` and customer ``c`` becomes no fact.
REASON = """CASE WHEN coalesce(transaction_id, '') = '' THEN 'NULL_REQUIRED'
        WHEN dq_exclusion IS NOT NULL THEN dq_exclusion
        WHEN a.account_id IS NULL THEN 'ORPHANED_ACCOUNT' WHEN c.customer_id IS NULL THEN 'UNKNOWN_CUSTOMER'
        WHEN transaction_date IS NULL THEN 'MISSING_TRANSACTION_DATE'
        WHEN transaction_timestamp IS NULL THEN 'MISSING_TRANSACTION_TIMESTAMP'
        WHEN transaction_type IS NULL THEN 'MISSING_TRANSACTION_TYPE' WHEN amount IS NULL THEN 'MISSING_AMOUNT'
        WHEN channel IS NULL THEN 'MISSING_CHANNEL' END AS reason
    FROM judged t LEFT JOIN silver_accounts a ON t.account_id = a.account_id
        LEFT JOIN dim_customers c ON a.customer_ref = c.customer_id"""
REJECTED_TRANSACTIONS = f"""
    SELECT transaction_id, t.account_id AS account_id, amount_raw, currency_raw, amount, currency_variant, bits, {REASON}"""
REJECTED_ACCOUNTS = """
    SELECT account_id, 'NULL_REQUIRED_ACCOUNT' AS reason, current_balance FROM typed_accounts WHERE coalesce(account_id, '') = ''
    UNION ALL
    SELECT account_id, CASE WHEN customer_ref IS NULL THEN 'NO_CUSTOMER_REF' ELSE 'UNKNOWN_CUSTOMER' END, current_balance
    FROM newest_accounts
    WHERE customer_ref IS NULL OR customer_ref NOT IN (SELECT customer_id FROM dim_customers)"""


@query(
    "quarantine_rows",
    sql(
        f"""SELECT 'transactions' AS source, transaction_id AS record_key, reason, account_id AS record_account,
            CASE WHEN bits <> 0 THEN amount_raw END AS delivered_amount,
            CASE WHEN bits <> 0 THEN currency_raw END AS delivered_currency, NULL AS delivered_balance
            FROM ({REJECTED_TRANSACTIONS}) WHERE reason IS NOT NULL
        UNION ALL SELECT 'accounts', account_id, reason, account_id, NULL, NULL, CAST(current_balance AS VARCHAR) FROM ({REJECTED_ACCOUNTS})""",
        *REJECTED_STEPS,
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    customers = stored(roles.dim_customers, "dim-customers")
    known = stored(roles.silver_accounts, "silver-accounts")
    transactions = gold.rejected_from_bronze(roles.transactions, known, customers)
    accounts = silver.rejected_accounts(roles.accounts, customers)
    rows = quarantine_rows(transactions, "transactions", "transaction_id").unionByName(
        quarantine_rows(accounts, "accounts", "account_id")
    )
    # The record itself is JSON, and so are the values as delivered in it; fields read back show them.
    raw = F.get_json_object("record", "$.raw")
    return rows.select(
        "source",
        "record_key",
        "reason",
        F.get_json_object("record", "$.account_id").alias("record_account"),
        F.get_json_object(raw, "$.amount_raw").alias("delivered_amount"),
        F.get_json_object(raw, "$.currency_raw").alias("delivered_currency"),
        F.get_json_object(raw, "$.current_balance").alias("delivered_balance"),
    )
