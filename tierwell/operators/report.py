"""Counts and the data-quality report.

Every figure is computed by Spark as a row of ``(name, records)``; only the finished report, a
row per issue code, is ever small enough to be looked at as a whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierwell import fixed_values as fv
from tierwell.functions.money import percent_of
from tierwell.functions.text import missing
from tierwell.operators.rules import RuleSet


def record_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(name, records)`` for every table, one aggregate each."""
    out = None
    for name, table in tables.items():
        one = table.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("name"), "records")
        out = one if out is None else out.unionAll(one)
    return out


def flag_counts(silver: DataFrame) -> DataFrame:
    """``(issue_code, records)`` for the flag each row ended up with."""
    flagged = silver.filter(F.col("dq_flag").isNotNull())
    return flagged.groupBy(F.col("dq_flag").alias("issue_code")).agg(F.count(F.lit(1)).alias("records"))


def issue_counts(judged: DataFrame) -> DataFrame:
    """``(issue_code, records)`` counting a row under every rule it breaks."""
    return (
        judged.select(F.explode("dq_issues").alias("issue_code"))
        .groupBy("issue_code")
        .agg(F.count(F.lit(1)).alias("records"))
    )


def removed_duplicates(judged: DataFrame) -> Column:
    """How many delivered copies deduplication removed."""
    return F.coalesce(F.sum(F.col("_dup_count") - 1), F.lit(0))


def null_key_count(accounts: DataFrame, rules: RuleSet) -> DataFrame:
    """``(issue_code, records)`` for account records without a key; zero if the column is absent."""
    setting = rules.config.get("account_null_required", {})
    key = setting.get("key_field", "account_id")
    test = missing(key) if key in accounts.columns else F.lit(False)
    return accounts.agg(F.count_if(test).alias("records")).select(
        F.lit(setting.get("issue_code", "NULL_REQUIRED_ACCOUNT")).alias("issue_code"), "records"
    )


def _catalogue(spark: SparkSession, rules: RuleSet) -> DataFrame:
    """The rule settings as a table: one row per rule."""
    account = rules.config.get("account_null_required", {})
    account_code = account.get("issue_code", "NULL_REQUIRED_ACCOUNT")
    rows = []
    dates = {fv.DATE_FORMAT_ACCOUNT: "accounts_raw", fv.DATE_FORMAT_CUSTOMER: "customers_raw"}
    for code in dict.fromkeys([*rules.priority, *rules.rules, account_code, *dates]):
        setting = account if code == account_code else rules.setting(code)
        default = ("EXCLUDED_NULL_PK", "accounts_raw") if code == account_code else ("FLAGGED", "transactions_raw")
        if code in dates:
            setting, default = {**rules.setting(fv.DATE_FORMAT), "denominator": dates[code]}, ("FLAGGED", dates[code])
        rows.append(
            (
                code,
                rules.priority.index(code) if code in rules.priority else None,
                setting.get("issue_type", code.lower()),
                setting.get("handling_action", default[0]),
                setting.get("denominator", default[1]),
            )
        )
    return spark.createDataFrame(
        rows, "issue_code string, place int, issue_type string, handling_action string, denominator string"
    )


def date_counts(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """``(issue_code, records)`` of the date rule for accounts and customers, from ``unreadable_dates``."""
    parts = [(accounts, fv.DATE_FORMAT_ACCOUNT), (customers, fv.DATE_FORMAT_CUSTOMER)]
    counted = [df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(code).alias("issue_code"), "records") for df, code in parts]
    return counted[0].unionByName(counted[1])


def issue_report(counts: DataFrame, sources: DataFrame, rules: RuleSet, in_output: DataFrame | None = None) -> DataFrame:
    """One row per issue that occurred, in priority order, then by code.

    ``counts`` is ``(issue_code, records)``, ``sources`` is ``(name, records)``, ``in_output`` is
    ``(issue_code, records)`` of the facts (``flag_counts`` of them); without it the handling action
    tells whether records reach the output.  All sides are reports of a few rows."""
    totals = counts.groupBy("issue_code").agg(F.sum("records").alias("records_affected"))
    known = _catalogue(counts.sparkSession, rules)
    whole = sources.select(F.col("name").alias("denominator"), F.col("records").alias("_whole"))
    joined = (
        totals.filter(F.col("records_affected") > 0)
        .join(known, "issue_code", "left")
        .withColumns(
            {
                "issue_type": F.coalesce("issue_type", F.lower("issue_code")),
                "handling_action": F.coalesce("handling_action", F.lit("FLAGGED")),
                "denominator": F.coalesce("denominator", F.lit("transactions_raw")),
            }
        )
        .join(whole, "denominator", "left")
    )
    if in_output is not None:
        reached = in_output.groupBy("issue_code").agg(F.sum("records").alias("_reached"))
        joined = joined.join(reached, "issue_code", "left")
        output = F.coalesce("_reached", F.lit(0))
    else:
        output = F.when(F.col("handling_action").isin(*fv.EXCLUDING_ACTIONS), F.lit(0)).otherwise(F.col("records_affected"))
    return joined.select(
        "issue_code",
        "issue_type",
        "records_affected",
        percent_of("records_affected", F.coalesce("_whole", F.lit(0))).alias("percentage_of_total"),
        "handling_action",
        output.cast("bigint").alias("records_in_output"),
        "place",
    ).orderBy(F.col("place").asc_nulls_last(), "issue_code")


def summary(counts: DataFrame, sources: DataFrame) -> DataFrame:
    """One row: total, flagged and clean records (never below zero)."""
    parts = sources.select("records", F.lit(0).cast("bigint").alias("flagged")).unionAll(
        counts.select(F.lit(0).cast("bigint"), "records")
    )
    total, flagged = F.coalesce(F.sum("records"), F.lit(0)), F.coalesce(F.sum("flagged"), F.lit(0))
    return parts.agg(
        total.alias("total_records"),
        flagged.alias("flagged_records"),
        F.greatest(total - flagged, F.lit(0)).alias("clean_records"),
    )


ISSUE = T.StructType(
    [
        T.StructField("issue_type", T.StringType()),
        T.StructField("records_affected", T.LongType()),
        T.StructField("percentage_of_total", T.DoubleType()),
        T.StructField("handling_action", T.StringType()),
        T.StructField("records_in_output", T.LongType()),
    ]
)


def report_document(
    counts: DataFrame,
    sources: DataFrame,
    gold: DataFrame,
    rules: RuleSet,
    run_timestamp: str,
    duration_seconds: int = 0,
    stage: str | None = None,
    schema_name: str = "dq-report/v1",
    in_output: DataFrame | None = None,
    issues: DataFrame | None = None,
) -> DataFrame:
    """The whole report as one row.

    ``counts`` has every flagged record once.  ``issues`` is ``ledger.issues``, which counts a record under
    each of its issues; without it the issues are those of ``counts``.

    The parts are put into one long frame of small rows and folded by a single aggregate, so no
    join without a key is needed.  ``stage`` defaults to "2" when anything was flagged, else "1"."""
    issues = issue_report(counts, sources, rules, in_output) if issues is None else issues
    flags = counts.groupBy("issue_code").agg(F.sum("records").alias("records")).filter(F.col("records") > 0)

    def rows(df: DataFrame, part: str, code: str, n: str) -> DataFrame:
        return df.select(
            F.lit(part).alias("part"),
            F.lit(None).cast("int").alias("place"),
            F.col(code).alias("code"),
            F.col(n).alias("n"),
            F.lit(None).cast(ISSUE).alias("issue"),
        )

    long = (
        rows(sources, "source", "name", "records")
        .unionByName(rows(gold, "gold", "name", "records"))
        .unionByName(rows(flags, "flag", "issue_code", "records"))
        .unionByName(
            issues.select(
                F.lit("issue").alias("part"), "place", F.col("issue_code").alias("code"),
                F.col("records_affected").alias("n"),
                F.struct(*[F.col(f.name) for f in ISSUE.fields]).alias("issue"),
            )
        )
    )
    def part_map(part: str) -> Column:
        pairs = F.collect_list(F.when(F.col("part") == part, F.struct("code", "n")))
        return F.map_from_entries(F.array_sort(pairs))

    def part_sum(part: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("part") == part, F.col("n"))), F.lit(0))

    last = F.lit(2**31 - 1)
    folded = long.agg(
        part_map("source").alias("source_record_counts"),
        F.transform(
            F.array_sort(
                F.collect_list(
                    F.when(F.col("part") == "issue", F.struct(F.coalesce("place", last).alias("place"), "code", "issue"))
                )
            ),
            lambda x: x["issue"],
        ).alias("dq_issues"),
        part_map("gold").alias("gold_layer_record_counts"),
        part_sum("source").alias("total_records"),
        part_sum("flag").alias("flagged_records"),
        part_map("flag").alias("flag_counts"),
    )
    default_stage = F.when(F.col("flagged_records") > 0, "2").otherwise("1")
    return folded.select(
        F.lit(schema_name).alias("$schema"),
        F.lit(run_timestamp).alias("run_timestamp"),
        (F.lit(str(stage)) if stage else default_stage).alias("stage"),
        "source_record_counts",
        "dq_issues",
        "gold_layer_record_counts",
        F.lit(int(duration_seconds)).alias("execution_duration_seconds"),
        "total_records",
        F.greatest(F.col("total_records") - F.col("flagged_records"), F.lit(0)).alias("clean_records"),
        "flagged_records",
        "flag_counts",
    )
