"""The issue ledger, quarantine of all sources, and members nobody has described yet."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.catalogue.layers import REASON, REJECTED_STEPS
from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import Roles
from tierwell.catalogue.scans import ODD_FOLDER, csv_file_of
from tierwell.catalogue.sql import parsed_date, sql, surrogate
from tierwell.operators import checks, ledger
from tierwell.operators.rules import RuleSet
from tierwell.plans import gold, silver
from tierwell.schemas import RAW_ACCOUNTS
from tierwell.sources import readers, sinks
from tierwell.sources.shared import fresh_path, stored

# -- the ledger ---------------------------------------------------------------------------------


def ledger_of(roles: Roles, rules: RuleSet, summed: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The ledger of all three sources, and the frames of transactions and accounts it comes from.  The ledger
    shows no delivered text, so none is kept."""
    customers = stored(silver.judged_customers(roles.customers, rules), "work-customers")
    people = stored(gold.dim_customers(silver.customers_from(customers), roles.as_of), "dim-customers")
    accounts = stored(silver.judged_accounts(roles.accounts, people, rules), "work-accounts")
    owned = gold.owned_transactions(roles.transactions, silver.accounts_from(accounts), people, rules, raw_text=False)
    owned = stored(owned, "work-transactions")
    entries = ledger.transaction_entries(owned, rules, gold.reject_reason(owned.columns, rules), summed)
    others = ledger.account_entries(accounts, rules, summed).unionByName(ledger.customer_entries(customers, summed))
    return entries.unionByName(others), owned, accounts


_ROW_RULES = {"null_required": "NULL_REQUIRED", "type_mismatch": "TYPE_MISMATCH", "date_format": "DATE_FORMAT", "currency_variant": "CURRENCY_VARIANT"}


def _bad(*fields: str) -> str:
    return " OR ".join(f"({f} IS NOT NULL AND ({parsed_date(f)}) IS NULL)" for f in fields)


def _entries(source: str, table: str, key: str, issues: list[tuple[str, str, str]]) -> list[str]:
    """SELECTs from a table with ``outcome``, ``reason``, ``flag``, ``dup_count``: ``issues`` are (code, test, total)."""
    lead = f"SELECT '{source}' AS source, {key} AS record_key, "
    out = []
    for code, test, total in issues:
        out.append(f"{lead}'{code}' AS issue_code, outcome, reason, 1 AS records, CAST(coalesce(flag = '{code}', false) AS INTEGER) AS flagged FROM {table} WHERE {test}")
        if total:
            out.append(f"{lead}'{code}', 'removed copy', NULL, {total} - CAST({test} AS INTEGER), 0 FROM {table} WHERE {total} > CAST({test} AS INTEGER)")
    out.append(f"{lead}'DUPLICATE_DEDUPED', 'removed copy', NULL, dup_count - 1, dup_count - 1 FROM {table} WHERE dup_count > 1")
    listed = " OR ".join(f"({test} AND reason = '{code}')" for code, test, _ in issues)
    some = " OR ".join(f"({test})" for _, test, _ in issues)
    out.append(
        f"{lead}reason, outcome, reason, 1, CAST(flag IS NULL AS INTEGER) FROM {table} WHERE reason IS NOT NULL AND NOT coalesce({listed}, false)"
        f" AND (NOT ({some}) OR reason NOT LIKE 'MISSING_%')"
    )
    return out


_OUTCOME = "CASE WHEN reason IS NULL THEN 'gold' ELSE 'quarantine' END AS outcome"
_ACCOUNT_ORDER = """ORDER BY ingestion_timestamp DESC, trim(customer_ref) DESC NULLS LAST, upper(trim(account_type)) DESC NULLS LAST,
    upper(trim(account_status)) DESC NULLS LAST, opened DESC NULLS LAST, upper(trim(product_tier)) DESC NULLS LAST,
    trim(mobile_number) DESC NULLS LAST, upper(trim(digital_channel)) DESC NULLS LAST, TRY_CAST(credit_limit AS DECIMAL(18,2)) DESC NULLS LAST,
    TRY_CAST(current_balance AS DECIMAL(18,2)) DESC NULLS LAST, active DESC NULLS LAST"""
_STEPS_SQL = f"""
    lt AS (SELECT t.*, dq_flag AS flag, {REASON}),
    lo AS (SELECT lt.*, {_OUTCOME}, {", ".join(f"CASE WHEN lt.transaction_id IS NULL THEN CAST(lt.{r} AS INTEGER) ELSE n_{r} END AS t_{r}" for r in _ROW_RULES)}
        FROM lt LEFT JOIN (SELECT transaction_id, {", ".join(f"CAST(sum(CAST({r} AS INTEGER)) AS INTEGER) AS n_{r}" for r in _ROW_RULES)}
            FROM decided WHERE transaction_id IS NOT NULL GROUP BY 1) n ON n.transaction_id = lt.transaction_id),
    la0 AS (SELECT *, {_bad("open_date", "last_activity_date")} AS bad, {parsed_date("open_date")} AS opened, {parsed_date("last_activity_date")} AS active
        FROM raw_accounts),
    la1 AS (SELECT trim(account_id) AS account_id, trim(customer_ref) AS customer_ref, coalesce(bad, false) AS bad,
            CASE WHEN account_id IS NULL THEN 1 ELSE count(*) OVER w END AS dup_count,
            CASE WHEN account_id IS NULL THEN CAST(coalesce(bad, false) AS INTEGER) ELSE CAST(sum(CAST(coalesce(bad, false) AS INTEGER)) OVER w AS INTEGER) END AS n_bad,
            row_number() OVER (PARTITION BY account_id {_ACCOUNT_ORDER}) AS place
        FROM la0 WINDOW w AS (PARTITION BY account_id)),
    la AS (SELECT *, {_OUTCOME}, CASE WHEN coalesce(account_id, '') = '' THEN 'NULL_REQUIRED_ACCOUNT' WHEN bad THEN 'DATE_FORMAT_ACCOUNT' END AS flag
        FROM (SELECT *, CASE WHEN account_id IS NULL THEN 'NULL_REQUIRED_ACCOUNT' WHEN customer_ref IS NULL THEN 'NO_CUSTOMER_REF'
                WHEN customer_ref NOT IN (SELECT customer_id FROM dim_customers) THEN 'UNKNOWN_CUSTOMER' END AS reason
            FROM la1 WHERE account_id IS NULL OR place = 1)),
    lc AS (SELECT trim(customer_id) AS customer_id, coalesce({_bad("dob")}, false) AS bad, 1 AS dup_count, NULL AS reason, 'gold' AS outcome,
            CASE WHEN {_bad("dob")} THEN 'DATE_FORMAT_CUSTOMER' END AS flag FROM raw_customers),
    ledger AS ({" UNION ALL ".join(
        _entries("transactions", "lo", "transaction_id", [
            *[(code, column, f"t_{column}") for column, code in _ROW_RULES.items()],
            ("ORPHANED_ACCOUNT", "orphaned", ""), ("DUPLICATE_DEDUPED", "(dup_count > 1)", "")])
        + _entries("accounts", "la", "account_id", [
            ("NULL_REQUIRED_ACCOUNT", "(account_id IS NULL)", ""), ("DATE_FORMAT_ACCOUNT", "bad", "n_bad")])
        + _entries("customers", "lc", "customer_id", [("DATE_FORMAT_CUSTOMER", "bad", "")])
    )})"""
LEDGER_STEPS = (*REJECTED_STEPS, "decided", "raw_accounts", "raw_customers", "raw_transactions", "fact")


def ledger_sql(select: str) -> str:
    """``select`` over ``ledger`` and the named steps of all layers."""
    return sql(f"--ledger {select}", *LEDGER_STEPS).replace("\n--ledger ", f",{_STEPS_SQL}\n")


@query(
    "issue_ledger",
    ledger_sql("SELECT source, record_key, issue_code, outcome, reason, CAST(records AS BIGINT) AS records, CAST(flagged AS BIGINT) AS flagged FROM ledger"),
)
def _(spark, folder):
    return ledger_of(Roles(spark, folder), RuleSet.default())[0]


@query(
    "quarantine_counts",
    ledger_sql("SELECT source, reason, CAST(sum(flagged) AS BIGINT) AS records FROM ledger WHERE outcome = 'quarantine' GROUP BY ALL"),
)
def _(spark, folder):
    """Records in quarantine by reason, from the ledger."""
    return ledger.quarantined(ledger_of(Roles(spark, folder), RuleSet.default())[0])


# -- quarantine from files ------------------------------------------------------------------------

_CUT = "account_status = 'closed' AND account_type = 'credit'"


@query(
    "quarantine_from_files",
    sql(
        f"""SELECT record_key, reason, delivered_opened, line FROM (
            SELECT NULL AS record_key, 'MALFORMED_LINE' AS reason, CASE WHEN false THEN '' END AS delivered_opened,
                concat_ws(',', coalesce(account_id, ''), coalesce(customer_ref, ''), account_type) AS line
            FROM raw_accounts WHERE {_CUT}
            UNION ALL
            SELECT account_id, CASE WHEN account_id IS NULL THEN 'NULL_REQUIRED_ACCOUNT' WHEN customer_ref IS NULL THEN 'NO_CUSTOMER_REF'
                    ELSE 'UNKNOWN_CUSTOMER' END, trim(open_date), NULL
            FROM (SELECT *, {parsed_date("open_date")} AS opened, {parsed_date("last_activity_date")} AS active,
                    row_number() OVER (PARTITION BY account_id {_ACCOUNT_ORDER.replace("ingestion_timestamp DESC, ", "").replace("opened", parsed_date("open_date")).replace("active DESC", parsed_date("last_activity_date") + " DESC")}) AS place
                FROM raw_accounts WHERE NOT ({_CUT}))
            WHERE (account_id IS NULL OR place = 1)
                AND (account_id IS NULL OR customer_ref IS NULL OR customer_ref NOT IN (SELECT customer_id FROM dim_customers)))""",
        "raw_accounts",
        "dim_customers",
    ),
)
def _(spark, folder):
    """Accounts from CSV files with cut-off lines: such lines go to quarantine whole, other rejects with the
    values as they were delivered."""
    roles = Roles(spark, folder)
    path = f"{fresh_path(spark, 'accounts-csv')}/{ODD_FOLDER}"
    rows = roles.accounts.select(*RAW_ACCOUNTS.fieldNames())
    csv_file_of(rows, path, (F.col("account_status") == "closed") & (F.col("account_type") == "credit"), 3)
    bronze = sinks.stamped(readers.read_csv(spark, path, RAW_ACCOUNTS), "2026-01-01 06:00:00")
    out = sinks.quarantine_rows(silver.rejected_accounts(bronze, roles.dim_customers), "accounts", "account_id")
    raw = F.get_json_object("record", "$.raw")
    cut = F.col("reason") == fv.MALFORMED_LINE
    return out.select(
        "record_key", "reason",
        F.when(~cut, F.get_json_object(raw, "$.open_date")).alias("delivered_opened"),
        F.get_json_object(raw, "$._corrupt_record").alias("line"),
    )


# -- members nobody has described yet --------------------------------------------------------------

_KEEP = {fv.ORPHANED_ACCOUNT: {"handling_action": "FLAGGED"}}
_UNKNOWN = surrogate("'UNKNOWN'")
_MEMBER = "CASE WHEN coalesce(t.account_id, '') = '' THEN 'UNKNOWN' ELSE t.account_id END"
#: Facts when orphans are kept, over the accounts of ``{0}``.
_KEPT_SQL = """SELECT t.transaction_id, {member} AS account_id, e.account_id IS NULL AS orphan, c.customer_sk, c.province,
        CASE WHEN type_mismatch THEN 'TYPE_MISMATCH' WHEN date_format THEN 'DATE_FORMAT' WHEN currency_variant THEN 'CURRENCY_VARIANT'
            WHEN e.account_id IS NULL THEN 'ORPHANED_ACCOUNT' WHEN dup_count > 1 THEN 'DUPLICATE_DEDUPED' END AS dq_flag
    FROM single_earliest t LEFT JOIN {accounts} e ON t.account_id = e.account_id LEFT JOIN dim_customers c ON e.customer_ref = c.customer_id
    WHERE NOT null_required AND t.transaction_id IS NOT NULL AND transaction_date IS NOT NULL AND transaction_timestamp IS NOT NULL
        AND transaction_type IS NOT NULL AND amount IS NOT NULL AND channel IS NOT NULL AND (e.account_id IS NULL OR c.customer_id IS NOT NULL)"""
_KEPT = _KEPT_SQL.format(member=_MEMBER, accounts="silver_accounts")


@query(
    "orphans_kept",
    sql(
        f"""SELECT transaction_id, {surrogate("account_id")} AS account_sk, CASE WHEN orphan THEN {_UNKNOWN} ELSE customer_sk END AS customer_sk,
            CASE WHEN orphan THEN 'UNKNOWN' ELSE province END AS province, dq_flag FROM ({_KEPT})""",
        "single_earliest", "silver_accounts", "dim_customers",
    ),
)
def _(spark, folder):
    """Facts when the orphan rule's action alone is changed: orphans are in, under the unknown customer."""
    roles, rules = Roles(spark, folder), RuleSet.default().changed(**_KEEP)
    facts = gold.fact_from_bronze(roles.transactions, roles.silver_accounts, roles.dim_customers, rules)
    return facts.select("transaction_id", "account_sk", "customer_sk", "province", "dq_flag")


@query(
    "orphans_kept_keys",
    sql(
        f"""SELECT 'placeholders' AS "check", count(DISTINCT account_id) AS violations FROM ({_KEPT}) WHERE orphan
        UNION ALL SELECT 'fact to accounts', 0 UNION ALL SELECT 'fact to customers', 0 UNION ALL SELECT 'accounts to customers', 0""",
        "single_earliest", "silver_accounts", "dim_customers",
    ),
)
def _(spark, folder):
    """The dimensions hold a member for every key of such facts."""
    roles, rules = Roles(spark, folder), RuleSet.default().changed(**_KEEP)
    accounts, real = stored(roles.silver_accounts, "silver-accounts"), stored(roles.dim_customers, "dim-customers")
    owned = stored(gold.owned_transactions(roles.transactions, accounts, real, rules, keep_keyless=False, evidence=False), "owned")
    facts, blanks = gold.facts(owned, rules), stored(gold.placeholder_accounts(owned, rules), "placeholders")
    members = gold.dim_accounts(accounts, real).unionByName(blanks)
    customers = real.unionByName(gold.placeholder_customer(spark))
    return (
        checks.references(facts, "account_sk", members, "account_sk", "fact to accounts")
        .unionAll(checks.references(facts, "customer_sk", customers, "customer_sk", "fact to customers"))
        .unionAll(checks.references(members, "customer_id", customers, "customer_id", "accounts to customers"))
        .unionAll(blanks.agg(F.lit("placeholders").alias("check"), F.count(F.lit(1)).alias("violations")))
    )


_EARLY = "CAST(substr(account_id, 5) AS BIGINT) % 3 <> 0"


@query(
    "late_accounts_rekeyed",
    sql(
        f"""SELECT k.transaction_id, {surrogate("k.account_id")} AS account_sk, k.dq_flag,
            CASE WHEN NOT k.orphan THEN k.customer_sk ELSE coalesce(c.customer_sk, {_UNKNOWN}) END AS customer_sk,
            CASE WHEN NOT k.orphan THEN k.province WHEN c.customer_sk IS NULL THEN 'UNKNOWN' ELSE c.province END AS province
        FROM ({_KEPT_SQL.format(member=_MEMBER, accounts=f"(SELECT * FROM silver_accounts WHERE {_EARLY})")}) k
        LEFT JOIN dim_accounts a ON a.account_id = k.account_id LEFT JOIN dim_customers c ON c.customer_id = a.customer_id""",
        "single_earliest", "silver_accounts", "dim_customers", "dim_accounts",
    ),
)
def _(spark, folder):
    """Facts delivered when a third of the accounts had not arrived yet, after they have."""
    roles, rules = Roles(spark, folder), RuleSet.default().changed(**_KEEP)
    accounts, customers = stored(roles.silver_accounts, "silver-accounts"), stored(roles.dim_customers, "dim-customers")
    early = accounts.filter(F.substring("account_id", 5, 20).cast("bigint") % 3 != 0)
    facts = gold.fact_from_bronze(roles.transactions, early, customers, rules)
    rekeyed = gold.rekeyed(stored(facts, "early-facts"), gold.dim_accounts(accounts, customers), customers)
    return rekeyed.select("transaction_id", "account_sk", "customer_sk", "province", "dq_flag")
