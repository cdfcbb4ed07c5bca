"""Checks on the layer tables."""

from pyspark.sql import functions as F

from tierwell.catalogue.layers import REJECTED_ACCOUNTS, REJECTED_STEPS, REJECTED_TRANSACTIONS
from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import Roles
from tierwell.catalogue.sql import sql
from tierwell.operators import checks
from tierwell.operators.report import removed_duplicates
from tierwell.plans import gold, silver, validation
from tierwell.schemas import DIM_CUSTOMERS
from tierwell.sources.shared import stored


def _unique_sql(table: str, key: str, name: str) -> str:
    return f"""SELECT '{name}.{key} unique' AS "check", count({key}) - count(DISTINCT {key}) AS violations FROM {table}
    UNION ALL SELECT '{name}.{key} present', count(*) - count({key}) FROM {table}"""


@query(
    "check_key_unique",
    sql(
        " UNION ALL ".join(
            [
                _unique_sql("fact", "transaction_sk", "fact_transactions"),
                _unique_sql("dim_accounts", "account_sk", "dim_accounts"),
                _unique_sql("raw_transactions", "transaction_id", "raw"),
            ]
        ),
        "fact",
        "dim_accounts",
        "raw_transactions",
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    return (
        checks.key_unique(roles.fact, "transaction_sk", "fact_transactions")
        .unionAll(checks.key_unique(roles.dim_accounts, "account_sk", "dim_accounts"))
        .unionAll(checks.key_unique(roles.transactions, "transaction_id", "raw"))
    )


@query(
    "check_fk",
    sql(
        """SELECT 'fact to accounts' AS "check", count(*) AS violations FROM fact
            WHERE account_sk NOT IN (SELECT account_sk FROM dim_accounts)
        UNION ALL SELECT 'fact to customers', count(*) FROM fact
            WHERE customer_sk NOT IN (SELECT customer_sk FROM dim_customers)
        UNION ALL SELECT 'accounts to customers', count(*) FROM dim_accounts
            WHERE customer_id NOT IN (SELECT customer_id FROM dim_customers)
        UNION ALL SELECT 'silver accounts to customers', count(*) FROM silver_accounts
            WHERE customer_ref NOT IN (SELECT customer_id FROM dim_customers)""",
        "fact",
        "silver_accounts",
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    accounts, customers = stored(roles.dim_accounts, "dim-accounts"), stored(roles.dim_customers, "dim-customers")
    fact = stored(gold.fact_from_bronze(roles.transactions, roles.silver_accounts, customers), "fact")
    return (
        checks.references(fact, "account_sk", accounts, "account_sk", "fact to accounts")
        .unionAll(checks.references(fact, "customer_sk", customers, "customer_sk", "fact to customers"))
        .unionAll(checks.references(accounts, "customer_id", customers, "customer_id", "accounts to customers"))
        .unionAll(
            checks.references(
                roles.silver_accounts, "customer_ref", customers, "customer_id", "silver accounts to customers"
            )
        )
    )


@query(
    "check_domains",
    sql(
        """SELECT 'currency standard' AS "check", count(*) FILTER (currency IS NULL OR currency <> 'ZAR') AS violations FROM fact
        UNION ALL SELECT 'dq_flag known', count(*) FILTER (dq_flag NOT IN ('NULL_REQUIRED', 'TYPE_MISMATCH', 'DATE_FORMAT',
            'CURRENCY_VARIANT', 'ORPHANED_ACCOUNT', 'DUPLICATE_DEDUPED')) FROM fact""",
        "fact",
    ),
)
def _(spark, folder):
    return checks.domains(Roles(spark, folder).fact)


_REQUIRED = [f.name for f in DIM_CUSTOMERS.fields if not f.nullable]


@query(
    "check_required",
    sql(
        " UNION ALL ".join(
            f"""SELECT 'dim_customers.{c} present' AS "check", count(*) - count({c}) AS violations FROM dim_customers"""
            for c in _REQUIRED
        ),
        "dim_customers",
    ),
)
def _(spark, folder):
    return checks.required_nulls(Roles(spark, folder).dim_customers, DIM_CUSTOMERS, "dim_customers")


@query(
    "check_tolerance",
    sql(
        """SELECT transaction_type, CAST(measured AS DOUBLE) AS measured, CAST(expected AS DOUBLE) AS expected,
            coalesce(abs(measured - expected) <= 0.25 * expected, false) AS within
        FROM (SELECT transaction_type, count(*) AS measured FROM fact GROUP BY 1)
        FULL JOIN (SELECT transaction_type, count(*) AS expected FROM typed_transactions
            WHERE transaction_type IS NOT NULL GROUP BY 1) USING (transaction_type)""",
        "fact",
        "typed_transactions",
    ),
)
def _(spark, folder):
    """Facts per type against deliveries per type."""
    roles = Roles(spark, folder)
    expected = (
        silver.typed_transactions(roles.transactions)
        .groupBy("transaction_type")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .dropna()
    )
    return checks.within_tolerance(
        validation.volume_by_type(roles.fact), expected, "transaction_type", "record_count", 0.25
    )


@query(
    "row_reconcile",
    sql(
        f"""SELECT *, source_rows - kept_rows - rejected_rows - duplicates_rows AS unexplained FROM (
            SELECT 'transactions' AS table_name, (SELECT count(*) FROM raw_transactions) AS source_rows,
                (SELECT count(*) FROM fact) AS kept_rows,
                (SELECT count(*) FROM ({REJECTED_TRANSACTIONS}) WHERE reason IS NOT NULL) AS rejected_rows,
                (SELECT CAST(sum(dup_count - 1) AS BIGINT) FROM judged) AS duplicates_rows
            UNION ALL SELECT 'accounts', (SELECT count(*) FROM raw_accounts), (SELECT count(*) FROM dim_accounts),
                (SELECT count(*) FROM ({REJECTED_ACCOUNTS})),
                (SELECT count(account_id) - count(DISTINCT account_id) FROM typed_accounts)
            UNION ALL SELECT 'customers', (SELECT count(*) FROM raw_customers), (SELECT count(*) FROM dim_customers),
                (SELECT count(*) FROM silver_customers WHERE coalesce(customer_id, '') = ''),
                (SELECT count(customer_id) - count(DISTINCT customer_id) FROM silver_customers))""",
        *REJECTED_STEPS,
        "raw_transactions",
        "raw_accounts",
        "raw_customers",
        "silver_customers",
        "fact",
    ),
)
def _(spark, folder):
    """Transactions in one pass over what one join found out about them."""
    roles = Roles(spark, folder)
    accounts = stored(roles.silver_accounts, "silver-accounts")
    customers = stored(roles.dim_customers, "dim-customers")
    owned = gold.owned_transactions(roles.transactions, accounts, customers, evidence=False)
    reason = gold.reject_reason(owned.columns)
    transactions = checks.reconciled_counts(
        roles.transactions,
        owned.agg(
            F.count_if(reason.isNull()).alias("kept"),
            F.count_if(reason.isNotNull()).alias("rejected"),
            removed_duplicates(owned).alias("duplicates"),
        ),
        "transactions",
    )
    account_copies, customer_copies = silver.account_copies(roles.accounts), silver.customer_copies(roles.customers)
    return transactions.unionAll(
        checks.reconcile(
            roles.accounts,
            gold.dim_accounts(accounts, customers),
            silver.rejected_accounts(roles.accounts, customers),
            account_copies.agg(removed_duplicates(account_copies).alias("records")),
            "accounts",
        )
    ).unionAll(
        checks.reconcile(
            roles.customers,
            customers,
            silver.rejected_customers(roles.customers),
            customer_copies.agg(removed_duplicates(customer_copies).alias("records")),
            "customers",
        )
    )
