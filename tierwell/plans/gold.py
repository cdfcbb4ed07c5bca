"""Silver to gold: the star schema, and what is left out of it."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tierwell import fixed_values as fv
from tierwell.functions.keys import hashed_key
from tierwell.functions.temporal import age_band
from tierwell.functions.text import missing
from tierwell.operators.linking import keep_known, keep_unknown
from tierwell.operators.rules import RuleSet
from tierwell.plans.silver import SILVER_TRANSACTIONS, judged_transactions, linked_transactions
from tierwell.schemas import DIM_ACCOUNTS, DIM_CUSTOMERS, FACT_TRANSACTIONS, conform
from tierwell.sources.shared import stored


def dim_customers(silver: DataFrame, as_of: date) -> DataFrame:
    keyed = silver.filter(F.col("customer_id").isNotNull()).select(
        "*", hashed_key("customer_id").alias("customer_sk"), age_band("dob", as_of).alias("age_band")
    )
    return conform(keyed, DIM_CUSTOMERS)


def dim_accounts(silver: DataFrame, customers: DataFrame) -> DataFrame:
    """Accounts whose customer exists.  Only account columns survive, so a semi join is enough."""
    usable = silver.filter(F.col("account_id").isNotNull() & F.col("customer_ref").isNotNull())
    owned = keep_known(usable, "customer_ref", customers, "customer_id")
    keyed = owned.select(
        "*", F.col("customer_ref").alias("customer_id"), hashed_key("account_id").alias("account_sk")
    )
    return conform(keyed, DIM_ACCOUNTS)


def dim_accounts_from(judged: DataFrame) -> DataFrame:
    """The same out of ``silver.judged_accounts``, which knows the owners: no further join."""
    kept = judged.filter(F.col("reason").isNull())
    return conform(kept.select("*", F.col("customer_ref").alias("customer_id"), hashed_key("account_id").alias("account_sk")), DIM_ACCOUNTS)


_OWNER = ["_account_sk", "_customer_sk", "_province"]
#: What ``account_owners`` reads of both tables.
OWNED_ACCOUNT = ["account_id", "customer_ref"]
OWNING_CUSTOMER = ["customer_id", "province"]


def account_owners(accounts: DataFrame, customers: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row per account with both surrogate keys and the owner's province, NULL for no owner.

    Joining accounts and customers first means the transactions are shuffled once, by account,
    instead of once by account and again by customer."""
    owners = customers.select(
        F.col("customer_id").alias("_owner"), F.col("customer_sk").alias("_customer_sk"), F.col("province").alias("_province")
    )
    return accounts.join(owners, F.col(key) == F.col("_owner"), "left").select(
        "account_id", hashed_key("account_id").alias("_account_sk"), "_customer_sk", "_province"
    )


def owned_transactions(
    bronze: DataFrame,
    silver_accounts: DataFrame,
    customers: DataFrame,
    rules: RuleSet | None = None,
    keep: str | None = None,
    keep_keyless: bool = True,
    evidence: bool = True,
    raw_text: bool = True,
) -> DataFrame:
    """Judged transactions with the keys and the province of their owner.

    One shuffle by transaction to deduplicate, one by account to find orphans and bring the owner.
    Silver, facts and quarantine are projections and filters of this frame."""
    owners = account_owners(silver_accounts, customers, "customer_ref")
    return judged_transactions(bronze, owners, rules, keep, _OWNER, keep_keyless, evidence, raw_text)


def owned_under_each(
    bronze: DataFrame, silver_accounts: DataFrame, customers: DataFrame, rule_sets: Mapping[str, RuleSet], evidence: bool = True
) -> dict[str, DataFrame]:
    """``owned_transactions`` under each of several rule sets, by name.

    Those whose rules test the same and keep the same delivery share one frame, deduplicated, joined and
    stored once; what their handling actions make of it is a projection."""
    owners = account_owners(silver_accounts, customers, "customer_ref")
    linked: dict[str, DataFrame] = {}
    found = {}
    for name, rules in rule_sets.items():
        tests = rules.tests_key()
        if tests not in linked:
            linked[tests] = stored(linked_transactions(bronze, owners, rules, carry=_OWNER, evidence=evidence), "linked")
        found[name] = rules.resolve(linked[tests], "_bits")
    return found


def fact_from_bronze(
    bronze: DataFrame, silver_accounts: DataFrame, customers: DataFrame, rules: RuleSet | None = None, keep: str | None = None
) -> DataFrame:
    """Facts straight from bronze, without rows that could only be rejected."""
    return facts(owned_transactions(bronze, silver_accounts, customers, rules, keep, keep_keyless=False, evidence=False), rules)


def rejected_from_bronze(
    bronze: DataFrame, silver_accounts: DataFrame, customers: DataFrame, rules: RuleSet | None = None, keep: str | None = None
) -> DataFrame:
    return rejects(owned_transactions(bronze, silver_accounts, customers, rules, keep), rules)


def reject_reason(columns: list[str], rules: RuleSet | None = None) -> Column:
    """Why an owned transaction does not become a fact; NULL if it does.

    The handling action of the orphan rule decides about transactions of unknown accounts: they are
    rejected, or become facts of an unknown member (see ``placeholder_accounts``)."""
    orphan = F.col("_valid_account_id").isNull()
    keeps = (rules or RuleSet.default()).keeps_orphans
    malformed = F.col("_malformed") if "_malformed" in columns else F.lit(False)
    reason = (
        F.when(malformed, F.lit(fv.MALFORMED_LINE))
        .when(missing("transaction_id"), F.lit(fv.NULL_REQUIRED))
        .when(F.col("dq_exclusion").isNotNull(), F.col("dq_exclusion"))
        .when(orphan & F.lit(not keeps), F.lit(fv.ORPHANED_ACCOUNT))
        .when(~orphan & F.col("_customer_sk").isNull(), F.lit(fv.UNKNOWN_CUSTOMER))
    )
    for name in fv.FACT_REQUIRED:
        reason = reason.when(F.col(name).isNull(), F.lit(f"MISSING_{name.upper()}"))
    return reason


def becomes_fact(columns: list[str], rules: RuleSet | None = None) -> Column:
    """Where ``reject_reason`` is NULL, as one condition after the other: Spark then tests those on the
    transaction before the join by account, shuffles no column only they need, and drops orphans in it."""
    known = F.col("_valid_account_id").isNotNull()
    keeps = (rules or RuleSet.default()).keeps_orphans
    tests = [~F.coalesce(F.col("_malformed"), F.lit(False))] if "_malformed" in columns else []
    tests += [~missing("transaction_id"), F.col("dq_exclusion").isNull()]
    owned = F.col("_customer_sk").isNotNull()
    tests += [~known | owned] if keeps else [known, owned]
    return reduce(and_, tests + [F.col(name).isNotNull() for name in fv.FACT_REQUIRED])


def _member() -> Column:
    """The account a fact names; those that name none share the unknown one."""
    return F.when(missing("account_id"), F.lit(fv.UNKNOWN_MEMBER)).otherwise(F.col("account_id"))


def facts(owned: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Complete transactions that no rule keeps out, with the province of the owner.

    Those of accounts nobody has described yet, if the rules keep them, carry the key that the account
    will have, and the customer and province of the unknown member."""
    orphan = F.col("_valid_account_id").isNull()
    keyed = owned.filter(becomes_fact(owned.columns, rules)).withColumns(
        {
            "transaction_sk": hashed_key("transaction_id"),
            "account_sk": F.when(orphan, hashed_key(_member())).otherwise(F.col("_account_sk")),
            "customer_sk": F.when(orphan, hashed_key(F.lit(fv.UNKNOWN_MEMBER))).otherwise(F.col("_customer_sk")),
            "province": F.when(orphan, F.lit(fv.UNKNOWN_MEMBER)).otherwise(F.col("_province")),
            "currency": F.lit(fv.CURRENCY),
        }
    )
    return conform(keyed, FACT_TRANSACTIONS)


# -- members nobody has described yet ---------------------------------------------------------

_NO_DATE = date(1900, 1, 1)


def placeholder_accounts(owned: DataFrame, rules: RuleSet) -> DataFrame:
    """A row of the account dimension for every unknown account that has facts; none unless the rules keep
    orphans.  The key is the one the account will have, so its facts keep theirs."""
    orphan = F.col("_valid_account_id").isNull() & F.lit(rules.keeps_orphans)
    named = owned.filter(orphan & reject_reason(owned.columns, rules).isNull()).select(_member().alias("account_id"))
    unknown = {c: F.lit(fv.UNKNOWN_MEMBER) for c in ("customer_id", "account_type", "account_status", "product_tier", "digital_channel")}
    others = {"open_date": F.lit(_NO_DATE), "credit_limit": F.lit(None), "current_balance": F.lit(0), "last_activity_date": F.lit(None)}
    return conform(named.distinct().withColumns({"account_sk": hashed_key("account_id"), **unknown, **others}), DIM_ACCOUNTS)


def placeholder_customer(spark: SparkSession) -> DataFrame:
    """The unknown customer, to whom all placeholder accounts belong."""
    unknown = {f.name: F.lit(fv.UNKNOWN_MEMBER) for f in DIM_CUSTOMERS.fields if isinstance(f.dataType, StringType)}
    row = spark.range(1).withColumns({**unknown, "customer_sk": hashed_key(F.lit(fv.UNKNOWN_MEMBER)), "risk_score": F.lit(0)})
    return conform(row, DIM_CUSTOMERS)


def with_arrived(earlier: DataFrame, later: DataFrame, key: str) -> DataFrame:
    """A dimension after more members have been described: all of ``later``, and what only ``earlier`` has.
    A placeholder gives way to its member and never takes the place of one."""
    owner = "customer_id" if key == "account_id" else key
    described = later.filter(F.col(owner) != fv.UNKNOWN_MEMBER)
    known = earlier.filter(F.col(owner) != fv.UNKNOWN_MEMBER)
    real = described.unionByName(keep_unknown(known, key, described, key))
    blanks = earlier.filter(F.col(owner) == fv.UNKNOWN_MEMBER).unionByName(later.filter(F.col(owner) == fv.UNKNOWN_MEMBER))
    return real.unionByName(keep_unknown(blanks.dropDuplicates([key]), key, real, key))


def rekeyed(facts: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Facts after accounts have arrived: those of the unknown customer get the customer and province their
    account has now.  The flag still says what was wrong when they were delivered.

    All other facts pass by without a shuffle; only waiting ones meet the dimensions."""
    unknown = hashed_key(F.lit(fv.UNKNOWN_MEMBER))
    owners = account_owners(accounts.filter(F.col("customer_id") != fv.UNKNOWN_MEMBER), customers)
    waiting = facts.filter(F.col("customer_sk") == unknown)
    found = waiting.join(owners, F.col("account_sk") == F.col("_account_sk"), "left").withColumns(
        {
            "province": F.when(F.col("_customer_sk").isNull(), F.col("province")).otherwise(F.col("_province")),
            "customer_sk": F.coalesce("_customer_sk", "customer_sk"),
        }
    )
    return conform(facts.filter(F.col("customer_sk") != unknown).unionByName(found.select(*facts.columns)), FACT_TRANSACTIONS)


def rejects(owned: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """The rows ``facts`` leaves out, each with its reason and, where a rule was broken, the delivered
    values."""
    judged = owned.withColumn("reason", reject_reason(owned.columns, rules)).filter(F.col("reason").isNotNull())
    raw = [F.col("_raw").alias("raw")] if "_raw" in owned.columns else []
    return judged.select(*SILVER_TRANSACTIONS, *raw, "reason")
