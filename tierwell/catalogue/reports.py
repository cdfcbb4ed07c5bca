"""Validation reports and the data-quality report."""

from pyspark.sql import functions as F

from tierwell.catalogue.issues import ledger_of, ledger_sql
from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import Roles
from tierwell.catalogue.sql import sql
from tierwell.operators import checks, ledger, report
from tierwell.operators.rules import RuleSet
from tierwell.plans import gold, validation
from tierwell.sources.bucketed import overwrite_bucketed, read_bucketed
from tierwell.sources.shared import fresh_path, stored
from tierwell.sources.sinks import document


@query(
    "q1_volume_by_type",
    sql(
        """SELECT transaction_type, count(*) AS record_count, CAST(sum(amount) AS DOUBLE) AS total_amount,
            CAST(round(count(*) * 100.0 / sum(count(*)) OVER (), 2) AS DOUBLE) AS pct_of_total
        FROM fact GROUP BY transaction_type ORDER BY transaction_type""",
        "fact",
    ),
)
def _(spark, folder):
    return validation.volume_by_type(Roles(spark, folder).fact)


@query(
    "q2_unlinked_accounts",
    sql(
        """SELECT count(*) AS unlinked_accounts FROM dim_accounts a
        LEFT JOIN dim_customers c ON a.customer_id = c.customer_id WHERE c.customer_id IS NULL""",
        "dim_accounts",
        "dim_customers",
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    return validation.unlinked_accounts(roles.dim_accounts, roles.dim_customers)


@query(
    "q2_unlinked_silver_accounts",
    sql(
        """SELECT count(*) AS unlinked_accounts FROM silver_accounts a
        LEFT JOIN dim_customers c ON a.customer_ref = c.customer_id WHERE c.customer_id IS NULL""",
        "silver_accounts",
        "dim_customers",
    ),
)
def _(spark, folder):
    """The same report before the referential cut, where it has something to find."""
    roles = Roles(spark, folder)
    uncut = roles.silver_accounts.withColumnRenamed("customer_ref", "customer_id")
    return validation.unlinked_accounts(uncut, roles.dim_customers)


@query(
    "q3_region_distribution",
    sql(
        """SELECT c.province AS province, count(DISTINCT a.account_id) AS account_count
        FROM dim_accounts a JOIN dim_customers c ON a.customer_id = c.customer_id GROUP BY 1 ORDER BY 1""",
        "dim_accounts",
        "dim_customers",
    ),
)
def _(spark, folder):
    roles = Roles(spark, folder)
    return validation.accounts_by_province(roles.dim_accounts, roles.dim_customers)


@query(
    "q3_region_distribution_sketch",
    sql(
        """SELECT c.province AS province, CAST(count(DISTINCT a.account_id) AS DOUBLE) AS expected, true AS within
        FROM dim_accounts a JOIN dim_customers c ON a.customer_id = c.customer_id GROUP BY 1""",
        "dim_accounts",
        "dim_customers",
    ),
)
def _(spark, folder):
    """Sketches of two runs that share a third of the accounts, united, against the exact counts."""
    roles = Roles(spark, folder)
    part = F.pmod(F.xxhash64("account_id"), F.lit(3))
    runs = [validation.province_sketches(roles.dim_accounts.filter(part != n), roles.dim_customers) for n in (0, 1)]
    over_runs = validation.accounts_by_province_over_runs(stored(runs[0].unionByName(runs[1]), "sketches"))
    exact = validation.accounts_by_province(roles.dim_accounts, roles.dim_customers)
    return checks.within_tolerance(over_runs, exact, "province", "account_count", 0.05).drop("measured")


@query(
    "bucketed_account_join",
    sql(
        """SELECT a.account_type AS account_type, count(*) AS facts, CAST(sum(f.amount) AS DOUBLE) AS total_amount
        FROM fact f JOIN dim_accounts a ON f.account_sk = a.account_sk GROUP BY 1""",
        "fact",
        "dim_accounts",
    ),
)
def _(spark, folder):
    """Facts and accounts stored in buckets of the account's key and joined where they lie."""
    roles = Roles(spark, folder)
    paths = [fresh_path(spark, label) for label in ("facts", "accounts")]
    for df, path in zip((roles.fact, roles.dim_accounts), paths):
        overwrite_bucketed(df, path, "account_sk", 16)
    facts, accounts = (read_bucketed(spark, path) for path in paths)
    return facts.join(accounts, "account_sk").groupBy("account_type").agg(
        F.count(F.lit(1)).alias("facts"), F.sum("amount").alias("total_amount")
    )


@query(
    "flag_reconcile",
    sql(
        """SELECT 'fact_transactions' AS source, count(*) AS flagged_count FROM fact WHERE dq_flag IS NOT NULL
        UNION ALL SELECT 'clean_records', count(*) FROM fact WHERE dq_flag IS NULL ORDER BY source""",
        "fact",
    ),
)
def _(spark, folder):
    return validation.flagged_and_clean(Roles(spark, folder).fact)


@query(
    "flag_counts",
    sql(
        "SELECT dq_flag AS issue_code, count(*) AS records FROM judged WHERE dq_flag IS NOT NULL GROUP BY dq_flag",
        "judged",
    ),
)
def _(spark, folder):
    return report.flag_counts(Roles(spark, folder).silver_transactions)


def _sources(roles: Roles):
    return report.record_counts(
        {
            "accounts_raw": roles.accounts,
            "customers_raw": roles.customers,
            "transactions_raw": roles.transactions,
        }
    )


def _counts(roles: Roles, silver_transactions):
    rules = RuleSet.default()
    return report.flag_counts(silver_transactions).unionByName(report.null_key_count(roles.accounts, rules))


_SOURCES_SQL = """SELECT 'accounts_raw' AS name, count(*) AS records FROM raw_accounts
    UNION ALL SELECT 'customers_raw', count(*) FROM raw_customers
    UNION ALL SELECT 'transactions_raw', count(*) FROM raw_transactions"""
_NULL_KEYS_SQL = """SELECT 'NULL_REQUIRED_ACCOUNT' AS issue_code,
    count(*) FILTER (coalesce(trim(account_id), '') = '') AS records FROM raw_accounts"""
_COUNTS_SQL = f"""SELECT dq_flag AS issue_code, count(*) AS records FROM judged WHERE dq_flag IS NOT NULL GROUP BY 1
    UNION ALL {_NULL_KEYS_SQL}"""
_STEPS = ("raw_accounts", "raw_customers", "raw_transactions", "judged")


@query("source_record_counts", sql(_SOURCES_SQL, *_STEPS[:3]))
def _(spark, folder):
    return _sources(Roles(spark, folder))


@query("null_key_count", sql(_NULL_KEYS_SQL, "raw_accounts"))
def _(spark, folder):
    return report.null_key_count(Roles(spark, folder).accounts, RuleSet.default())


_SUMMARY_SQL = f"""SELECT total_records, flagged_records, greatest(total_records - flagged_records, 0) AS clean_records
    FROM (SELECT CAST((SELECT sum(records) FROM ({_SOURCES_SQL})) AS BIGINT) AS total_records,
        CAST((SELECT sum(records) FROM ({_COUNTS_SQL})) AS BIGINT) AS flagged_records)"""


@query("dq_summary", sql(_SUMMARY_SQL, *_STEPS))
def _(spark, folder):
    roles = Roles(spark, folder)
    return report.summary(_counts(roles, roles.silver_transactions), _sources(roles))


_ISSUE_SETTINGS = """(VALUES
    ('transactions', 'NULL_REQUIRED', 0, 'null_required', 'EXCLUDED_NULL_PK'),
    ('transactions', 'TYPE_MISMATCH', 1, 'type_mismatch', 'CAST_TO_DECIMAL'),
    ('transactions', 'DATE_FORMAT', 2, 'date_format_inconsistency', 'NORMALISED_DATE'),
    ('transactions', 'CURRENCY_VARIANT', 3, 'currency_variants', 'NORMALISED_CURRENCY'),
    ('transactions', 'ORPHANED_ACCOUNT', 4, 'orphaned_transactions', 'QUARANTINED'),
    ('transactions', 'DUPLICATE_DEDUPED', 5, 'duplicate_transactions', 'DEDUPLICATED_KEEP_FIRST'),
    ('accounts', 'NULL_REQUIRED_ACCOUNT', NULL, 'null_account_id', 'EXCLUDED_NULL_PK'),
    ('accounts', 'DATE_FORMAT_ACCOUNT', NULL, 'date_format_inconsistency', 'NORMALISED_DATE'),
    ('customers', 'DATE_FORMAT_CUSTOMER', NULL, 'date_format_inconsistency', 'NORMALISED_DATE'),
    ('accounts', 'DUPLICATE_DEDUPED', NULL, 'duplicate_accounts', 'DEDUPLICATED_KEEP_LAST'))
    AS s(source, issue_code, place, issue_type, handling_action)"""
_ISSUES_SQL = f"""SELECT c.source AS source, c.issue_code AS issue_code, coalesce(issue_type, lower(c.issue_code) || '_' || c.source) AS issue_type,
    CAST(c.affected AS BIGINT) AS records_affected, CAST(round(c.affected * 100.0 / d.records, 2) AS DOUBLE) AS percentage_of_total,
    coalesce(handling_action, 'QUARANTINED') AS handling_action, CAST(c.reached AS BIGINT) AS records_in_output, place
    FROM (SELECT source, issue_code, sum(CASE WHEN issue_code = 'DUPLICATE_DEDUPED' AND outcome <> 'removed copy' THEN 0 ELSE records END) AS affected,
            coalesce(sum(records) FILTER (outcome = 'gold'), 0) AS reached FROM ledger GROUP BY 1, 2) c
    LEFT JOIN {_ISSUE_SETTINGS} ON s.source = c.source AND s.issue_code = c.issue_code
    JOIN ({_SOURCES_SQL}) d ON d.name = c.source || '_raw' WHERE c.affected > 0"""
_FLAGS_SQL = "SELECT issue_code, sum(flagged) AS records FROM ledger GROUP BY 1 HAVING sum(flagged) > 0"


@query("dq_issue_report", ledger_sql(_ISSUES_SQL))
def _(spark, folder):
    """Every record under each of its issues, dates of all three sources included."""
    roles = Roles(spark, folder)
    entries = stored(ledger.totals(ledger_of(roles, RuleSet.default(), summed=True)[0]), "ledger-totals")
    return ledger.issues(entries, _sources(roles), RuleSet.default())


@query(
    "dq_report_json",
    ledger_sql(
        f"""SELECT '2' AS stage, '2026-01-01T00:00:00Z' AS run_timestamp, total_records, total_records - flagged_records AS clean_records, flagged_records,
            (SELECT records FROM ({_SOURCES_SQL}) WHERE name = 'transactions_raw') AS transactions_raw,
            (SELECT count(*) FROM fact) AS fact_transactions, (SELECT count(*) FROM dim_accounts) AS dim_accounts,
            (SELECT count(*) FROM dim_customers) AS dim_customers,
            (SELECT string_agg(issue_type || ':' || records_affected || ':' || records_in_output, ',' ORDER BY place NULLS LAST, issue_code, issue_type,
                records_affected) FROM ({_ISSUES_SQL})) AS issues,
            (SELECT string_agg(issue_code || '=' || CAST(records AS BIGINT), ',' ORDER BY issue_code) FROM ({_FLAGS_SQL})) AS flag_counts
        FROM (SELECT CAST((SELECT sum(records) FROM ({_SOURCES_SQL})) AS BIGINT) AS total_records,
            CAST((SELECT sum(flagged) FROM ledger) AS BIGINT) AS flagged_records)"""
    ),
)
def _(spark, folder):
    """The report as a JSON document; every column here is read back out of the document."""
    roles, rules = Roles(spark, folder), RuleSet.default()
    entries, work, accounts = ledger_of(roles, rules, summed=True)
    entries, sources = stored(ledger.totals(entries), "ledger-totals"), stored(_sources(roles), "sources")
    gold_counts = report.record_counts(
        {"fact_transactions": gold.facts(work), "dim_accounts": gold.dim_accounts_from(accounts), "dim_customers": roles.dim_customers}
    )
    whole = report.report_document(
        ledger.flag_totals(entries), sources, gold_counts, rules, "2026-01-01T00:00:00Z", issues=ledger.issues(entries, sources, rules)
    )
    text = whole.select(document(F.struct(*whole.columns)).alias("document"))
    back = text.select(F.from_json("document", whole.schema).alias("d")).select("d.*")
    issue = F.transform(
        "dq_issues", lambda i: F.concat_ws(":", i["issue_type"], i["records_affected"], i["records_in_output"])
    )
    flags = F.transform(F.map_entries("flag_counts"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return back.select(
        "stage",
        "run_timestamp",
        "total_records",
        "clean_records",
        "flagged_records",
        F.col("source_record_counts")["transactions_raw"].alias("transactions_raw"),
        F.col("gold_layer_record_counts")["fact_transactions"].alias("fact_transactions"),
        F.col("gold_layer_record_counts")["dim_accounts"].alias("dim_accounts"),
        F.col("gold_layer_record_counts")["dim_customers"].alias("dim_customers"),
        F.array_join(issue, ",").alias("issues"),
        F.array_join(F.array_sort(flags), ",").alias("flag_counts"),
    )

