"""The issue ledger: every delivered record with an issue, under each of its issues, and what became of it.

Rows are ``(source, record_key, issue_code, outcome, reason, records, flagged)``.  ``outcome`` is where the
records ended up: gold, quarantine, or removed as a copy of another delivery.  ``reason`` says why they
are in quarantine.  ``records`` counts deliveries, 1 except for removed copies, of which a key may
have many.  ``flagged`` counts those of them that no other row of the ledger counts as flagged: under the
issue of highest priority, so that its sum is the number of records with an issue.

The ledger comes from the frames that deduplication and one join have left (``work/...`` of a run), by
projection alone; report and quarantine counts are aggregates of it.  Every quarantined record is in
it, under its reason where it has no issue of its own.  Link rules are judged on the delivery that stays;
a removed copy counts under the row rules it breaks and as a duplicate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwell import fixed_values as fv
from tierwell.functions.money import percent_of
from tierwell.operators.rules import RuleSet, first_match

LEDGER = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("source", "record_key", "issue_code", "outcome", "reason")]
    + [T.StructField(n, T.LongType()) for n in ("records", "flagged")]
)


def _entry(code: str | Column, outcome: Column, records: Column, flagged: Column) -> Column:
    code = F.lit(code) if isinstance(code, str) else code
    return F.struct(
        code.alias("issue_code"), outcome.alias("outcome"), records.cast("bigint").alias("records"), flagged.cast("bigint").alias("flagged")
    )


def _entries(
    judged: DataFrame, source: str, key: str, reason: Column, issues: list[tuple[str, Column, Column | None]], flag: Column, alike: list[str] | None = None
) -> DataFrame:
    """``issues`` are (code, whether the delivery that stays has it, how many deliveries of its key have it or
    None); ``flag`` is the code that counts the delivery that stays as flagged, NULL for none.  A malformed
    line is no record that could have issues.  ``alike`` names the columns the issues are told from: records
    that agree in them are then counted first and entered together, without their key."""
    whole = ~F.col("_malformed")
    shown = judged.withColumns({"_reason": reason, "_flag": F.when(whole, flag)})
    if alike is None:
        record_key, number = F.col(key), F.lit(1)
    else:
        told = dict.fromkeys([*alike, "_malformed", "_dup_count", "_reason", "_flag"])
        shown = shown.groupBy(*told).agg(F.count(F.lit(1)).alias("_alike"))
        record_key, number = F.lit(None).cast("string"), F.col("_alike")
    why = F.col("_reason")
    outcome = F.when(why.isNull(), F.lit(fv.GOLD)).otherwise(F.lit(fv.QUARANTINE))
    removed = F.lit(fv.REMOVED_COPY)
    entries, any_issue, listed = [], F.lit(False), F.lit(False)
    for code, test, total in issues:
        has = whole & F.coalesce(test, F.lit(False))
        listed = listed | (has & (why == code))
        entries.append(_entry(code, outcome, has.cast("int"), (has & (F.col("_flag") == code)).cast("int")))
        if total is not None:
            entries.append(_entry(code, removed, F.when(whole, total - has.cast("int")), F.lit(0)))
        any_issue = any_issue | has
    # A copy that was removed is flagged as that.
    entries.append(_entry(fv.DUPLICATE_DEDUPED, removed, F.col("_dup_count") - 1, F.col("_dup_count") - 1))
    # What is missing is the consequence of an issue, where there is one.
    own = why.isNotNull() & ~listed & (~any_issue | ~why.startswith("MISSING_"))
    entries.append(_entry(why, outcome, own.cast("int"), (own & F.col("_flag").isNull()).cast("int")))
    concerned = shown.filter(any_issue | (F.col("_dup_count") > 1) | why.isNotNull())
    rows = concerned.select(F.lit(source).alias("source"), record_key.alias("record_key"), "_reason", number.alias("_number"), F.inline(F.array(*entries)))
    return rows.filter(F.col("records") > 0).select(
        "source", "record_key", "issue_code", "outcome",
        F.when(F.col("outcome") == fv.QUARANTINE, F.col("_reason")).alias("reason"),
        (F.col("records") * F.col("_number")).alias("records"), (F.col("flagged") * F.col("_number")).alias("flagged"),
    )


def transaction_entries(owned: DataFrame, rules: RuleSet, reason: Column, summed: bool = False) -> DataFrame:
    """From ``gold.owned_transactions`` with evidence; ``reason`` is ``gold.reject_reason``.  ``summed``, here
    and below: an entry for all records alike, for readers that only sum."""
    row_rules = [c for c in owned.columns if c.startswith("_n_")]
    codes = [c for c in rules.priority if c in fv.FLAG_PRIORITY]
    issues = [
        (c, F.array_contains("dq_issues", c), F.col(f"_n_{c}") if f"_n_{c}" in row_rules else None) for c in dict.fromkeys(codes)
    ]
    alike = ["dq_issues", *row_rules] if summed else None
    return _entries(owned, "transactions", "transaction_id", reason, issues, F.col("dq_flag"), alike)


def _account_code(rules: RuleSet) -> str:
    return rules.config.get("account_null_required", {}).get("issue_code", fv.NULL_REQUIRED_ACCOUNT)


_ALIKE = ["reason", "_bad_date", "_n_bad_date"]


def account_entries(judged: DataFrame, rules: RuleSet, summed: bool = False) -> DataFrame:
    """From ``silver.judged_accounts``."""
    code = _account_code(rules)
    reason = F.when(F.col("reason") == fv.NULL_REQUIRED_ACCOUNT, F.lit(code)).otherwise(F.col("reason"))
    issues = [(code, reason == code, None), (fv.DATE_FORMAT_ACCOUNT, F.col("_bad_date"), F.col("_n_bad_date"))]
    return _entries(judged, "accounts", "account_id", reason, issues, first_match([(c, t) for c, t, _ in issues]), _ALIKE if summed else None)


def customer_entries(judged: DataFrame, summed: bool = False) -> DataFrame:
    """From ``silver.judged_customers``."""
    issues = [(fv.DATE_FORMAT_CUSTOMER, F.col("_bad_date"), F.col("_n_bad_date"))]
    flag = first_match([(c, t) for c, t, _ in issues])
    return _entries(judged, "customers", "customer_id", F.col("reason"), issues, flag, _ALIKE if summed else None)


# -- aggregates --------------------------------------------------------------------------------


def totals(ledger: DataFrame) -> DataFrame:
    """The ledger summed over its records, a few rows; all aggregates below are the same of it.  The column
    ``record_key`` is NULL."""
    sums = ledger.groupBy("source", "issue_code", "outcome", "reason").agg(F.sum("records").alias("records"), F.sum("flagged").alias("flagged"))
    return sums.select(*[F.col(f.name) if f.name in sums.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in LEDGER.fields])


def quarantined(ledger: DataFrame) -> DataFrame:
    """``(source, reason, records)`` of the records in quarantine."""
    rows = ledger.filter(F.col("outcome") == fv.QUARANTINE)
    # Each record is flagged once; a reason of its own counts only where nothing else was found.
    return rows.groupBy("source", "reason").agg(F.sum("flagged").alias("records"))


def flag_totals(ledger: DataFrame) -> DataFrame:
    """``(issue_code, records)``: every record with an issue once, under the one of highest priority."""
    return ledger.groupBy("issue_code").agg(F.sum("flagged").alias("records")).filter(F.col("records") > 0)


def _settings(ledger: DataFrame, rules: RuleSet) -> DataFrame:
    """What the rules say of each (source, issue code): a few rows."""
    account, date = rules.config.get("account_null_required", {}), rules.setting(fv.DATE_FORMAT)
    rows = []

    def add(source: str, code: str, setting, issue_type: str, action: str, place: int | None = None, denominator: str | None = None) -> None:
        rows.append(
            (source, code, place, setting.get("issue_type", issue_type), setting.get("handling_action", action), denominator or f"{source}_raw")
        )

    for code in dict.fromkeys([*rules.priority, *rules.rules]):
        place = rules.priority.index(code) if code in rules.priority else None
        add("transactions", code, rules.setting(code), code.lower(), "FLAGGED", place, rules.setting(code).get("denominator"))
    for source, code in (("accounts", fv.DATE_FORMAT_ACCOUNT), ("customers", fv.DATE_FORMAT_CUSTOMER)):
        add(source, code, date, code.lower(), "FLAGGED")
        add(source, fv.DUPLICATE_DEDUPED, {}, f"duplicate_{source}", fv.KEEP_LATEST_ACTIONS[0])
    add("accounts", _account_code(rules), account, "null_account_id", "EXCLUDED_NULL_PK", denominator=account.get("denominator"))
    add("customers", fv.NULL_REQUIRED, {}, "null_customer_id", "EXCLUDED_NULL_PK")
    names = "source string, issue_code string, place int, issue_type string, handling_action string, denominator string"
    return ledger.sparkSession.createDataFrame(rows, names)


def issues(ledger: DataFrame, sources: DataFrame, rules: RuleSet) -> DataFrame:
    """One row per source and issue that occurred, in priority order, then by code and source.

    ``sources`` is ``(name, records)``.  A record counts under each of its issues, once.  Of duplicates
    the removed copies are affected and the deliveries that stayed and reached gold are in the output.
    Codes no rule speaks of are reasons for quarantine and reported as such."""
    copy = F.col("issue_code") == fv.DUPLICATE_DEDUPED
    affected = F.when(copy & (F.col("outcome") != fv.REMOVED_COPY), 0).otherwise(F.col("records"))
    totals = ledger.groupBy("source", "issue_code").agg(
        F.sum(affected).alias("records_affected"),
        F.coalesce(F.sum(F.when(F.col("outcome") == fv.GOLD, F.col("records"))), F.lit(0)).alias("records_in_output"),
    )
    whole = sources.select(F.col("name").alias("denominator"), F.col("records").alias("_whole"))
    settled = totals.filter(F.col("records_affected") > 0).join(_settings(ledger, rules), ["source", "issue_code"], "left")
    own_table = F.concat(F.col("source"), F.lit("_raw"))
    joined = settled.withColumn("denominator", F.coalesce("denominator", own_table)).join(whole, "denominator", "left")
    own_name = F.concat(F.lower("issue_code"), F.lit("_"), F.col("source"))
    return joined.select(
        "source",
        "issue_code",
        F.coalesce("issue_type", own_name).alias("issue_type"),
        "records_affected",
        percent_of("records_affected", F.coalesce("_whole", F.lit(0))).alias("percentage_of_total"),
        F.coalesce("handling_action", F.lit(fv.EXCLUDING_ACTIONS[0])).alias("handling_action"),
        "records_in_output",
        "place",
    ).orderBy(F.col("place").asc_nulls_last(), "issue_code", "source")
