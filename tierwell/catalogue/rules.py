"""Data-quality rules."""

from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.catalogue.layers import REJECTED_STEPS, REJECTED_TRANSACTIONS
from tierwell.catalogue.registry import query
from tierwell.catalogue.roles import Roles
from tierwell.catalogue.scans import amounts_as_delivered
from tierwell.catalogue.sql import parsed_date, sql
from tierwell.operators.report import issue_counts
from tierwell.operators.rules import RuleSet, split_by_action
from tierwell.plans import gold
from tierwell.plans.silver import ACCOUNT_DATES, CUSTOMER_DATES, typed_transactions, unreadable_dates
from tierwell.sources.shared import stored

_ISO = r"regexp_full_match(transaction_date_raw, '\d{4}-\d{2}-\d{2}')"
_ROW_RULES = [
    ("dq_null_required", fv.NULL_REQUIRED, False, "null_required"),
    ("dq_type_mismatch", fv.TYPE_MISMATCH, False, "type_mismatch"),
    ("dq_date_format", fv.DATE_FORMAT, False, "date_format"),
    ("dq_date_format_strict", fv.DATE_FORMAT, True, f"(transaction_date_raw IS NOT NULL AND NOT {_ISO})"),
    ("dq_currency_variant", fv.CURRENCY_VARIANT, False, "currency_variant"),
    ("dq_currency_variant_strict", fv.CURRENCY_VARIANT, True, "coalesce(currency_raw <> 'ZAR', false)"),
]
_SHOWN = ["transaction_id", "account_id", "transaction_date_raw", "amount_raw", "currency_raw"]


def _row_rule(name: str, code: str, strict: bool, test: str) -> None:
    @query(name, sql(f"SELECT {', '.join(_SHOWN)} FROM decided WHERE {test}", "decided"))
    def _(spark, folder):
        typed = typed_transactions(Roles(spark, folder).transactions.drop("amount_is_text"))
        rules = RuleSet.default().changed(**{code: {"strict": strict}})
        return typed.filter(rules.predicate(code, typed.columns)).select(*_SHOWN)


for _rule in _ROW_RULES:
    _row_rule(*_rule)


@query(
    "dq_type_mismatch_strict",
    sql(
        """SELECT transaction_id, amount_raw, amount_is_text FROM decided
        WHERE type_mismatch OR (amount_is_text AND amount_raw IS NOT NULL)""",
        "decided",
    ),
)
def _(spark, folder):
    delivered = amounts_as_delivered(Roles(spark, folder))
    typed = typed_transactions(delivered)
    rules = RuleSet.default().changed(**{fv.TYPE_MISMATCH: {"strict": True}})
    hit = typed.filter(rules.predicate(fv.TYPE_MISMATCH, typed.columns))
    return hit.select("transaction_id", "amount_raw", "amount_is_text")


@query("dq_orphan", sql("SELECT transaction_id, account_id FROM judged WHERE orphaned", "judged"))
def _(spark, folder):
    judged = Roles(spark, folder).judged()
    hit = RuleSet.default().predicate(fv.ORPHANED_ACCOUNT, judged.columns)
    return judged.filter(hit).select("transaction_id", "account_id")


@query("dq_duplicate", sql("SELECT transaction_id, dup_count AS copies FROM judged WHERE dup_count > 1", "judged"))
def _(spark, folder):
    judged = Roles(spark, folder).judged()
    hit = RuleSet.default().predicate(fv.DUPLICATE_DEDUPED, judged.columns)
    return judged.filter(hit).select("transaction_id", F.col("_dup_count").alias("copies"))


@query("dq_flag_priority", sql("SELECT transaction_id, dq_flag FROM judged", "judged"))
def _(spark, folder):
    return Roles(spark, folder).judged().select("transaction_id", "dq_flag")


@query(
    "dq_rules_disabled",
    sql(
        """SELECT CASE WHEN date_format THEN 'DATE_FORMAT' WHEN type_mismatch THEN 'TYPE_MISMATCH'
            WHEN dup_count > 1 THEN 'DUPLICATE_DEDUPED' END AS dq_flag, count(*) AS records
        FROM judged GROUP BY 1""",
        "judged",
    ),
)
def _(spark, folder):
    """Two rules switched off, one left out of the priority list, the others reordered."""
    config = {
        **fv.DEFAULT_RULES,
        "dq_flag_priority": [
            fv.NULL_REQUIRED, fv.DATE_FORMAT, "UNKNOWN_RULE", fv.TYPE_MISMATCH, fv.CURRENCY_VARIANT,
            fv.DUPLICATE_DEDUPED,
        ],
    }
    rules = RuleSet(config).changed(
        **{fv.NULL_REQUIRED: {"enabled": False}, fv.CURRENCY_VARIANT: {"enabled": False}}
    )
    judged = Roles(spark, folder).judged(rules)
    return judged.groupBy("dq_flag").agg(F.count(F.lit(1)).alias("records"))


ALL_ISSUES = """SELECT unnest([CASE WHEN null_required THEN 'NULL_REQUIRED' END,
        CASE WHEN type_mismatch THEN 'TYPE_MISMATCH' END, CASE WHEN date_format THEN 'DATE_FORMAT' END,
        CASE WHEN currency_variant THEN 'CURRENCY_VARIANT' END, CASE WHEN orphaned THEN 'ORPHANED_ACCOUNT' END,
        CASE WHEN dup_count > 1 THEN 'DUPLICATE_DEDUPED' END]) AS issue_code FROM judged"""


@query(
    "dq_all_issues",
    sql(
        f"""SELECT issue_code, count(*) AS records FROM ({ALL_ISSUES}) WHERE issue_code IS NOT NULL GROUP BY issue_code""",
        "judged",
    ),
)
def _(spark, folder):
    return issue_counts(Roles(spark, folder).judged())


_OUTCOME = "CASE WHEN reason IS NULL THEN 'fact' ELSE reason END"


@query(
    "dq_apply_actions",
    sql(
        f"""SELECT 'default' AS rule_set, {_OUTCOME} AS outcome, count(*) AS records, CAST(sum(amount) AS DOUBLE) AS amount
            FROM ({REJECTED_TRANSACTIONS}) GROUP BY 2
        UNION ALL SELECT 'currency quarantined', CASE WHEN reason = 'NULL_REQUIRED' THEN reason
                WHEN currency_variant THEN 'CURRENCY_VARIANT' ELSE {_OUTCOME} END, count(*), CAST(sum(amount) AS DOUBLE)
            FROM ({REJECTED_TRANSACTIONS}) GROUP BY 2""",
        *REJECTED_STEPS,
    ),
)
def _(spark, folder):
    """Facts and quarantine under two rule sets that differ in one handling action."""
    roles = Roles(spark, folder)
    changed = RuleSet.default().changed(**{fv.CURRENCY_VARIANT: {"handling_action": "QUARANTINED"}})
    rule_sets = {"default": RuleSet.default(), "currency quarantined": changed}
    owned_by = gold.owned_under_each(roles.transactions, roles.owned_accounts, roles.owning_customers, rule_sets, evidence=False)

    def outcome(name: str):
        owned = owned_by[name]
        kept = gold.facts(owned).select(F.lit("fact").alias("outcome"), "amount")
        out = gold.rejects(owned).select(F.col("reason").alias("outcome"), "amount")
        return kept.unionByName(out).groupBy(F.lit(name).alias("rule_set"), "outcome").agg(F.count(F.lit(1)).alias("records"), F.sum("amount").alias("amount"))

    return outcome("default").unionByName(outcome("currency quarantined"))


def _dates(name: str, source: str, key: str, fields: list[str]) -> None:
    rows = " UNION ALL ".join(
        f"SELECT trim({key}) AS key, '{f}' AS field, trim({f}) AS raw FROM raw_{source} WHERE {f} IS NOT NULL AND ({parsed_date(f)}) IS NULL" for f in fields
    )

    @query(name, sql(rows, f"raw_{source}"))
    def _(spark, folder):
        return unreadable_dates(getattr(Roles(spark, folder), source), key, fields)


_dates("dq_date_format_accounts", "accounts", "account_id", ACCOUNT_DATES)
_dates("dq_date_format_customers", "customers", "customer_id", CUSTOMER_DATES)


@query(
    "dq_split_rows",
    sql(
        "SELECT transaction_id, CASE WHEN date_format THEN 'DATE_FORMAT' END AS reason FROM decided",
        "decided",
    ),
)
def _(spark, folder):
    """A rule's action changed by settings alone: unreadable dates are now quarantined."""
    typed = typed_transactions(Roles(spark, folder).transactions)
    config = {**fv.DEFAULT_RULES, "dq_flag_priority": [fv.DATE_FORMAT, fv.CURRENCY_VARIANT]}
    rules = RuleSet(config).changed(**{fv.DATE_FORMAT: {"handling_action": "QUARANTINED"}})
    kept, out = split_by_action(typed, rules)
    return kept.select("transaction_id", F.lit(None).cast("string").alias("reason")).unionByName(
        out.select("transaction_id", "reason")
    )
