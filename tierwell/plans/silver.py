"""Bronze to silver: typed, canonical, one row per key, judged by the rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.functions.money import money
from tierwell.functions.temporal import compose_timestamp, parse_date
from tierwell.functions.text import any_of, code, currency, missing, text
from tierwell.operators.dedupe import group_sizes, one_per_key
from tierwell.operators.linking import mark_known
from tierwell.operators.rules import RuleSet
from tierwell.schemas import CORRUPT
from tierwell.sources.readers import optional

SILVER_TRANSACTIONS = [
    "transaction_id", "account_id", "transaction_date", "transaction_time", "transaction_timestamp",
    "transaction_type", "merchant_category", "merchant_subcategory", "amount", "currency", "channel",
    "province", "dq_flag", "dq_exclusion", "ingestion_timestamp",
]
#: What a source delivered, kept for rows that break a rule.
RAW_EVIDENCE = ["transaction_date_raw", "transaction_time", "amount_raw", "currency_raw", CORRUPT]


def readable(bronze: DataFrame) -> DataFrame:
    """The rows whose line was a whole record."""
    return bronze.filter(F.col(CORRUPT).isNull()) if CORRUPT in bronze.columns else bronze


def typed_accounts(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return bronze.select(
        text("account_id").alias("account_id"),
        text("customer_ref").alias("customer_ref"),
        code("account_type").alias("account_type"),
        code("account_status").alias("account_status"),
        parse_date("open_date").alias("open_date"),
        code("product_tier").alias("product_tier"),
        text("mobile_number").alias("mobile_number"),
        code("digital_channel").alias("digital_channel"),
        money("credit_limit").alias("credit_limit"),
        money("current_balance").alias("current_balance"),
        parse_date("last_activity_date").alias("last_activity_date"),
        F.col("ingestion_timestamp").cast("timestamp").alias("ingestion_timestamp"),
        *carry,
    )


def silver_accounts(bronze: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """The newest delivery of every account, if it names a customer.  ``only``, with customer_ref among them,
    names the columns a reader wants."""
    newest = one_per_key(typed_accounts(readable(bronze)), "account_id", ["ingestion_timestamp"], only=only)
    return newest.filter(F.col("customer_ref").isNotNull())


def account_copies(bronze: DataFrame) -> DataFrame:
    """How often every account was delivered."""
    return group_sizes(typed_accounts(readable(bronze)), "account_id", "_dup_count")


def typed_customers(bronze: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    return bronze.select(
        text("customer_id").alias("customer_id"),
        text("id_number").alias("id_number"),
        text("first_name").alias("first_name"),
        text("last_name").alias("last_name"),
        parse_date("dob").alias("dob"),
        code("gender").alias("gender"),
        text("province").alias("province"),
        code("income_band").alias("income_band"),
        code("segment").alias("segment"),
        F.col("risk_score").try_cast("int").alias("risk_score"),
        code("kyc_status").alias("kyc_status"),
        text("product_flags").alias("product_flags"),
        F.col("ingestion_timestamp").cast("timestamp").alias("ingestion_timestamp"),
        *carry,
    )


def silver_customers(bronze: DataFrame, only: Sequence[str] | None = None) -> DataFrame:
    """The newest delivery of every customer, whole or ``only`` some columns."""
    return one_per_key(typed_customers(readable(bronze)), "customer_id", ["ingestion_timestamp"], only=only)


def typed_transactions(bronze: DataFrame) -> DataFrame:
    """Every bronze transaction, typed, with the raw text the rules look at.

    Three small steps rather than one: a value with several readers is then computed once, and no
    generated method grows past what the JVM is willing to compile."""
    read = bronze.select(
        text("transaction_id").alias("transaction_id"),
        text("account_id").alias("account_id"),
        text("transaction_date").alias("transaction_date_raw"),
        text("transaction_time").alias("transaction_time"),
        code("transaction_type").alias("transaction_type"),
        code("merchant_category").alias("merchant_category"),
        F.trim(optional(bronze, "merchant_subcategory")).alias("merchant_subcategory"),
        F.col("amount").cast("string").alias("amount_raw"),
        text("currency").alias("currency_raw"),
        code("channel").alias("channel"),
        F.trim(optional(bronze, "location.province")).alias("province"),
        F.col("ingestion_timestamp").cast("timestamp").alias("ingestion_timestamp"),
        *[F.col(c) for c in ("amount_is_text", CORRUPT) if c in bronze.columns],
    )
    dated = read.withColumn("transaction_date", parse_date("transaction_date_raw"))
    return dated.select(
        "transaction_id",
        "account_id",
        "transaction_date_raw",
        "transaction_date",
        "transaction_time",
        compose_timestamp("transaction_date", "transaction_time").alias("transaction_timestamp"),
        "transaction_type",
        "merchant_category",
        "merchant_subcategory",
        "amount_raw",
        money("amount_raw").alias("amount"),
        "currency_raw",
        currency("currency_raw").alias("currency"),
        "channel",
        "province",
        "ingestion_timestamp",
        *[F.col(c) for c in ("amount_is_text", CORRUPT) if c in bronze.columns],
    )


def judged_transactions(
    bronze: DataFrame,
    accounts: DataFrame,
    rules: RuleSet | None = None,
    keep: str | None = None,
    carry: Sequence[str] = (),
    keep_keyless: bool = True,
    evidence: bool = False,
    raw_text: bool = True,
) -> DataFrame:
    """One row per transaction with ``dq_flag``, all ``dq_issues``, ``dq_exclusion`` and the
    number of deliveries.

    Rules that need only the row are decided before the shuffle and travel as one integer, so the
    raw text does not.  Transactions without an id are all kept, each on its own, unless the caller
    has no use for them.  ``keep`` says which delivery stays, by default what the rules' handling of
    duplicates says.  ``carry`` names columns of ``accounts`` that the one join against them brings
    along.  With ``evidence`` rows that break a rule of their own carry the delivered values as JSON in
    ``_raw`` (unless ``raw_text`` is off), ``_malformed`` tells lines that were no record at all, and
    ``_n_<rule>`` counts the deliveries that break a row rule."""
    rules = rules or RuleSet.default()
    return rules.resolve(linked_transactions(bronze, accounts, rules, keep, carry, keep_keyless, evidence, raw_text), "_bits")


def linked_transactions(
    bronze: DataFrame,
    accounts: DataFrame,
    rules: RuleSet,
    keep: str | None = None,
    carry: Sequence[str] = (),
    keep_keyless: bool = True,
    evidence: bool = False,
    raw_text: bool = True,
) -> DataFrame:
    """What ``judged_transactions`` judges: one row per transaction with the broken row rules as ``_bits`` and
    its account.  Rule sets that differ in handling actions alone can share it."""
    typed = typed_transactions(bronze)
    slim = [c for c in SILVER_TRANSACTIONS if c not in ("dq_flag", "dq_exclusion", "currency")]
    decided = typed.select("*", rules.row_bits(typed.columns).alias("_bits"))
    malformed = optional(typed, CORRUPT).isNotNull()
    raw = F.when((F.col("_bits") != 0) | malformed, F.to_json(F.struct(*[c for c in RAW_EVIDENCE if c in typed.columns])))
    shown = ([raw.alias("_raw")] if raw_text else []) + [malformed.alias("_malformed")]
    decided = decided.select(*slim, "_bits", *(shown if evidence else []))
    single = one_per_key(
        decided,
        "transaction_id",
        ["ingestion_timestamp", "transaction_timestamp"],
        keep=keep or rules.keep,
        count_as="_dup_count",
        keep_keyless=keep_keyless,
        totals=rules.broken_totals("_bits", typed.columns) if evidence else None,
    ).withColumn("currency", F.lit(fv.CURRENCY))
    return mark_known(single, "account_id", accounts, "account_id", "_valid_account_id", carry)


def silver_transactions(
    bronze: DataFrame, accounts: DataFrame, rules: RuleSet | None = None, keep: str | None = None
) -> DataFrame:
    return judged_transactions(bronze, accounts, rules, keep).select(*SILVER_TRANSACTIONS)


ACCOUNT_COLUMNS = [
    "account_id", "customer_ref", "account_type", "account_status", "open_date", "product_tier", "mobile_number",
    "digital_channel", "credit_limit", "current_balance", "last_activity_date", "ingestion_timestamp",
]
CUSTOMER_COLUMNS = [
    "customer_id", "id_number", "first_name", "last_name", "dob", "gender", "province", "income_band", "segment",
    "risk_score", "kyc_status", "product_flags", "ingestion_timestamp",
]
#: The dates of the other two sources.
ACCOUNT_DATES = ["open_date", "last_activity_date"]
CUSTOMER_DATES = ["dob"]


def _judged(bronze: DataFrame, typed: Callable[..., DataFrame], key: str, dates: Sequence[str], converted: Sequence[str], rules: RuleSet) -> DataFrame:
    """The newest delivery of every record, with what was delivered of ``converted`` (``_raw``), whether its
    line was malformed, whether a date breaks the date rule, the number of deliveries and of those with
    a broken date.  Malformed lines have no key and, like other rows without one, stay on their own."""
    raw = {f"_raw_{c}": text(c) for c in converted} | {f"_raw_{CORRUPT}": optional(bronze, CORRUPT)}
    rows = typed(bronze.withColumns(raw | {"_malformed": optional(bronze, CORRUPT).isNotNull()}), ["_malformed", *raw])
    broken = any_of(rules.broken_date(f"_raw_{c}", c, rows.columns) for c in dates)
    kept = [c for c in rows.columns if c not in raw]
    rows = rows.select(
        *[F.when(~F.col("_malformed"), F.col(key)).alias(key) if c == key else F.col(c) for c in kept],
        F.struct(*[F.col(n).alias(n.removeprefix("_raw_")) for n in raw]).alias("_raw"),
        (broken & ~F.col("_malformed")).alias("_bad_date"),
    )
    return one_per_key(
        rows, key, ["ingestion_timestamp"], count_as="_dup_count", keep_keyless=True, totals={"_n_bad_date": F.sum(F.col("_bad_date").cast("bigint"))}
    )


def judged_accounts(bronze: DataFrame, customers: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Every account record that deduplication leaves, with ``reason``: why it reaches no gold table, else NULL.

    Silver, the dimension, quarantine and the ledger are projections and filters of this frame."""
    rules = rules or RuleSet.default()
    newest = _judged(bronze, typed_accounts, "account_id", ACCOUNT_DATES, [*ACCOUNT_DATES, "credit_limit", "current_balance"], rules)
    linked = mark_known(newest, "customer_ref", customers, "customer_id", "_customer")
    reason = (
        F.when(F.col("_malformed"), fv.MALFORMED_LINE)
        .when(missing("account_id"), fv.NULL_REQUIRED_ACCOUNT)
        .when(F.lit(rules.excludes(fv.DATE_FORMAT)) & F.col("_bad_date"), fv.DATE_FORMAT_ACCOUNT)
        .when(F.col("customer_ref").isNull(), fv.NO_CUSTOMER_REF)
        .when(F.col("_customer").isNull(), fv.UNKNOWN_CUSTOMER)
    )
    return linked.withColumn("reason", reason).drop("_customer")


def accounts_from(judged: DataFrame) -> DataFrame:
    """The silver table out of ``judged_accounts``."""
    kept = F.col("reason").isNull() | (F.col("reason") == fv.UNKNOWN_CUSTOMER)
    return judged.filter(kept).select(*ACCOUNT_COLUMNS)


def judged_customers(bronze: DataFrame, rules: RuleSet | None = None) -> DataFrame:
    """Every customer record that deduplication leaves, with ``reason`` as for accounts."""
    rules = rules or RuleSet.default()
    newest = _judged(bronze, typed_customers, "customer_id", CUSTOMER_DATES, [*CUSTOMER_DATES, "risk_score"], rules)
    reason = (
        F.when(F.col("_malformed"), fv.MALFORMED_LINE)
        .when(missing("customer_id"), fv.NULL_REQUIRED)
        .when(F.lit(rules.excludes(fv.DATE_FORMAT)) & F.col("_bad_date"), fv.DATE_FORMAT_CUSTOMER)
    )
    return newest.withColumn("reason", reason)


def customers_from(judged: DataFrame) -> DataFrame:
    """The silver table out of ``judged_customers``."""
    return judged.filter(F.col("reason").isNull()).select(*CUSTOMER_COLUMNS)


def rejected(judged: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Records that reach no gold table, each with its reason and the values as delivered.

    Older deliveries of a record that was kept are duplicates, not rejects."""
    raw = F.to_json("_raw").alias("raw")
    return judged.filter(F.col("reason").isNotNull()).select(*columns, raw, "reason")


def rejected_accounts(bronze: DataFrame, customers: DataFrame) -> DataFrame:
    return rejected(judged_accounts(bronze, customers), ACCOUNT_COLUMNS)


def rejected_customers(bronze: DataFrame) -> DataFrame:
    return rejected(judged_customers(bronze), CUSTOMER_COLUMNS)


def customer_copies(bronze: DataFrame) -> DataFrame:
    """How often every customer was delivered."""
    return group_sizes(typed_customers(readable(bronze)), "customer_id", "_dup_count")


def unreadable_dates(bronze: DataFrame, key: str, fields: Sequence[str], rules: RuleSet | None = None) -> DataFrame:
    """``(key, field, raw)`` of every date of a source that breaks the date rule."""
    rules = rules or RuleSet.default()
    raw_name, parsed_name = "transaction_date_raw", "transaction_date"
    pairs = [F.struct(F.lit(f).alias("field"), text(f).alias(raw_name), parse_date(f).alias(parsed_name)) for f in fields]
    rows = bronze.select(text(key).alias("key"), F.inline(F.array(*pairs)))
    plain = rules.changed(**{fv.DATE_FORMAT: {"source_field": raw_name, "parsed_field": parsed_name}})
    return rows.filter(plain.predicate(fv.DATE_FORMAT, rows.columns)).select("key", "field", F.col(raw_name).alias("raw"))
