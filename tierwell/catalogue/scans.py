"""Reading and writing files.  The files are written by Spark from the given tables first."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import Roles
from tierwell.catalogue.sql import sql
from tierwell.functions.money import amount_is_text
from tierwell.schemas import CORRUPT, RAW_CUSTOMERS, RAW_TRANSACTIONS
from tierwell.sources import readers, sinks
from tierwell.sources.shared import fresh_path

def csv_file_of(df: DataFrame, path: str, cut: Column, fields: int) -> None:
    """Append ``df`` to a folder of CSV files with headers, the lines where ``cut`` holds cut off after so many
    fields."""
    names = df.columns
    blanks = dict(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false")
    whole, short = F.to_csv(F.struct(*names), blanks), F.to_csv(F.struct(*names[:fields]), blanks)
    # The separator never occurs, so that lines and header come out as they are.
    options = dict(header=True, sep="\u0001", escapeQuotes=False, **blanks)
    df.select(F.when(cut, short).otherwise(whole).alias(",".join(names))).write.options(**options).mode("append").csv(path)


#: A folder name as users have them; it is no glob.
ODD_FOLDER = "in coming [1] 100%25 {x}"
_CUT_CUSTOMER = "risk_score = 'n/a' AND gender <> 'm'"
# An empty value reads as NULL, and so does what a line that was cut off lacks.
_CUSTOMER = ", ".join(
    f"nullif({c}, '') AS {c}" if c in ("customer_id", "id_number", "first_name") else f"CASE WHEN NOT cut THEN nullif({c}, '') END AS {c}"
    for c in RAW_CUSTOMERS.fieldNames()
)


@query(
    "scan_csv_bronze",
    sql(f"SELECT {_CUSTOMER}, cut AS malformed FROM (SELECT *, coalesce({_CUT_CUSTOMER}, false) AS cut FROM raw_customers)", "raw_customers"),
)
def _(spark, folder):
    """CSV files with their columns this way and the other way round, some lines cut off, in a folder whose
    name looks like a glob."""
    path = f"{fresh_path(spark, 'customers-csv')}/{ODD_FOLDER}"
    rows = Roles(spark, folder).customers.select(*RAW_CUSTOMERS.fieldNames())
    reverse = F.col("gender") == "m"
    csv_file_of(rows.filter(~reverse), path, F.col("risk_score") == "n/a", 3)
    csv_file_of(rows.filter(reverse).select(*reversed(rows.columns)), path, F.lit(False), 3)
    return readers.read_csv(spark, path, RAW_CUSTOMERS).select(*RAW_CUSTOMERS.fieldNames(), F.col(CORRUPT).isNotNull().alias("malformed"))


def json_lines(transactions: DataFrame) -> Column:
    """A transaction as the JSON line a source would deliver: the amount as a number or as text."""
    names = [c for c in RAW_TRANSACTIONS.fieldNames() if c not in ("amount", CORRUPT)]
    as_text = F.to_json(F.struct(*names, "amount"))
    as_number = F.to_json(F.struct(*names, F.col("amount").try_cast("decimal(18,2)").alias("amount")))
    return F.when(F.col("amount_is_text"), as_text).otherwise(as_number)


def amounts_as_delivered(roles: Roles) -> DataFrame:
    """Transactions with ``amount_is_text`` found from JSON lines, not taken from the role table."""
    line = json_lines(roles.transactions)
    return roles.transactions.withColumn("amount_is_text", amount_is_text(line))


def json_files_of(lines: DataFrame, path: str, lines_a_file: int = 500_000) -> None:
    """Write a folder of compressed files.  Readers do not split such files, so each holds so many lines at most."""
    lines.write.options(compression="gzip", maxRecordsPerFile=lines_a_file).text(path)


_CUT = "cat_7"


@query(
    "scan_jsonl_nested",
    sql(
        f"""SELECT province, city, device_id, retry_flag, broken, count(*) AS records, count(amount) AS amounts,
            count(DISTINCT transaction_id) AS transactions
        FROM (SELECT merchant_category IS NOT DISTINCT FROM '{_CUT}' AS broken,
                CASE WHEN NOT broken THEN location_province END AS province, CASE WHEN NOT broken THEN city END AS city,
                CASE WHEN NOT broken THEN device_id END AS device_id, CASE WHEN NOT broken THEN retry_flag END AS retry_flag,
                CASE WHEN NOT broken THEN amount END AS amount,
                CASE WHEN NOT broken THEN transaction_id END AS transaction_id
            FROM raw_transactions)
        GROUP BY ALL""",
        "raw_transactions",
    ),
)
def _(spark, folder):
    """Nested fields from JSON lines; the lines of one merchant category are cut off in the middle."""
    roles = Roles(spark, folder)
    path = fresh_path(spark, "transactions-jsonl")
    line = json_lines(roles.transactions)
    cut = F.when(F.col("merchant_category") == _CUT, F.substring(line, 1, 40)).otherwise(line)
    json_files_of(roles.transactions.select(cut.alias("value")), path)
    return (
        readers.read_jsonl(spark, path)
        .groupBy(
            F.col("location.province").alias("province"),
            F.col("location.city").alias("city"),
            F.col("metadata.device_id").alias("device_id"),
            F.col("metadata.retry_flag").alias("retry_flag"),
            F.col(CORRUPT).isNotNull().alias("broken"),
        )
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count("amount").alias("amounts"),
            F.count_distinct("transaction_id").alias("transactions"),
        )
    )


@query(
    "bronze_stamp",
    sql("SELECT account_id, '2026-01-03 04:05:06' AS ingestion_timestamp FROM raw_accounts", "raw_accounts"),
)
def _(spark, folder):
    raw = Roles(spark, folder).accounts.drop("ingestion_timestamp")
    return sinks.stamped(raw, "2026-01-03 04:05:06").select("account_id", "ingestion_timestamp")


@query(
    "bronze_by_source",
    sql(
        """SELECT 'customers' AS source, count(*) AS records, count(customer_id) AS customer_ids, 0 AS account_ids,
            0 AS transaction_ids FROM raw_customers
        UNION ALL SELECT 'accounts', count(*), 0, count(account_id), 0 FROM raw_accounts
        UNION ALL SELECT 'transactions', count(*), 0, count(account_id), count(transaction_id) FROM raw_transactions""",
        "raw_customers",
        "raw_accounts",
        "raw_transactions",
    ),
)
def _(spark, folder):
    """One table per source on disk, and one view over all of them."""
    roles = Roles(spark, folder)
    root = fresh_path(spark, "bronze")
    views = []
    for source in ("customers", "accounts", "transactions"):
        path = sinks.overwrite(getattr(roles, source), f"{root}/{source}")
        views.append(sinks.from_source(readers.read_table(spark, path), source))
    return (
        sinks.union_sources(views)
        .groupBy(F.col("_source").alias("source"))
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count("customer_id").alias("customer_ids"),
            F.count("account_id").alias("account_ids"),
            F.count("transaction_id").alias("transaction_ids"),
        )
    )


@query(
    "schema_drift_optional_col",
    sql(
        """SELECT 'old' AS feed, NULL AS merchant_subcategory, NULL AS province, count(*) AS records FROM raw_transactions
        UNION ALL SELECT 'new', trim(merchant_subcategory), location_province, count(*) FROM raw_transactions
        GROUP BY 2, 3""",
        "raw_transactions",
    ),
)
def _(spark, folder):
    """A feed from before two fields existed next to one that has them."""
    new = Roles(spark, folder).transactions
    old = new.drop("merchant_subcategory", "location")

    def shape(df: DataFrame, feed: str) -> DataFrame:
        return df.select(
            F.lit(feed).alias("feed"),
            F.trim(readers.optional(df, "merchant_subcategory")).alias("merchant_subcategory"),
            readers.optional(df, "location.province").alias("province"),
        )

    both = shape(old, "old").unionByName(shape(new, "new"))
    return both.groupBy(*both.columns).agg(F.count(F.lit(1)).alias("records"))


@query(
    "state_scan_or_empty",
    """SELECT 'written' AS state, count(*) AS records, CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
    FROM customer UNION ALL SELECT 'absent', 0, NULL""",
)
def _(spark, folder):
    accounts = Roles(spark, folder).stream_accounts
    path = sinks.overwrite(accounts, fresh_path(spark, "state"))

    def totals(where: str, state: str) -> DataFrame:
        return readers.read_or_empty(spark, where, accounts.schema).agg(
            F.lit(state).alias("state"), F.count(F.lit(1)).alias("records"), F.sum("current_balance").alias("balance")
        )

    return totals(path, "written").unionByName(totals(fresh_path(spark, "absent"), "absent"))
