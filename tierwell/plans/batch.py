"""The whole batch run: raw files to bronze, silver, gold, quarantine and report.

Every layer is written once and read back by the next, so no plan spans two layers, nothing is
computed twice, and a lost executor costs at most the current layer."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tierwell import fixed_values as fv
from tierwell import schemas
from tierwell.operators import checks, ledger, report
from tierwell.operators.rules import RuleSet
from tierwell.plans import gold, silver
from tierwell.sources import readers, sinks
from tierwell.sources.bucketed import overwrite_bucketed, read_bucketed
from tierwell.sources.shared import remove
from tierwell.tuning import tune


UTC = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")


@dataclass(frozen=True)
class Inputs:
    customers: str
    accounts: str
    transactions: str


@dataclass(frozen=True)
class Run:
    """Where a run writes and what it is a function of; no clock is read anywhere.

    ``root`` should be new for every run (for example ``.../run=2026-01-01``): readers of an older
    run are then never disturbed."""

    root: str
    as_of: date
    ingestion_timestamp: datetime
    keep: str | None = None  # which duplicate stays: "latest" or "earliest"; by default what the rules say
    fmt: str = "parquet"
    partition_facts: bool = False
    #: Store facts and accounts in so many buckets of ``account_sk``, so that joining them needs no shuffle.
    buckets: int | None = None

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"


#: The layers' counts, taken while they were written: ``(layer, table, metric, value)``.
METRICS = "layer string, table string, metric string, value long"
_RECORDS = "records"
_REMOVED = "removed copies"
_PLACEHOLDERS = "placeholders"


def _counts(layer: str, table: str) -> list[Column]:
    """What is counted while a table is written: its rows, and what the checks want to know of gold."""
    counts = [F.count(F.lit(1)).alias(_RECORDS)]
    if layer == "work" and table != "ledger":
        counts.append(F.sum(F.col("_dup_count") - 1).alias(_REMOVED))
    if layer == "gold":
        counts += checks.required_counts(_GOLD[table], table)
        counts += checks.domain_counts() if table == "fact_transactions" else [F.count_if(F.col("customer_id") == fv.UNKNOWN_MEMBER).alias(_PLACEHOLDERS)]
    return counts


_GOLD = {"fact_transactions": schemas.FACT_TRANSACTIONS, "dim_accounts": schemas.DIM_ACCOUNTS, "dim_customers": schemas.DIM_CUSTOMERS}
_BY_ACCOUNT = ("gold/dim_accounts", "gold/fact_transactions")


def run_batch(spark: SparkSession, inputs: Inputs, run: Run, rules: RuleSet | None = None) -> dict[str, DataFrame]:
    """Write all layers and return every table as read back, by ``layer/table``.

    Besides the layers there are ``work/...``, what one pass found out of each source's records;
    ``work/ledger``, all issues (``operators.ledger``); and ``work/metrics``, counts taken while writing.
    The session has to run in UTC, as dates and times are delivered in it.  Two of its settings are
    changed where they are at their default, and stay so (see ``tuning``)."""
    if spark.conf.get("spark.sql.session.timeZone") not in UTC:
        raise ValueError("set spark.sql.session.timeZone to UTC")
    if run.buckets and run.partition_facts:
        raise ValueError("facts are stored in buckets of the account or by date, not both")
    tune(spark)
    rules = rules or RuleSet.default()
    tables: dict[str, DataFrame] = {}
    metrics: list[tuple[str, str, str, int]] = []

    def write(layer: str, table: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path = run.path(layer, table)
        if run.buckets and f"{layer}/{table}" in _BY_ACCOUNT:
            found = overwrite_bucketed(df, path, "account_sk", run.buckets, _counts(layer, table), run.fmt)
            metrics.extend((layer, table, name, value) for name, value in found.items())
            tables[f"{layer}/{table}"] = read_bucketed(spark, path)
            return tables[f"{layer}/{table}"]
        found = sinks.overwrite_counted(df, path, _counts(layer, table), run.fmt, partition_by)
        metrics.extend((layer, table, name, value) for name, value in found.items())
        # Partition values come back last; the layer's own column order is restored.
        tables[f"{layer}/{table}"] = readers.read_table(spark, path, run.fmt).select(*df.columns)
        return tables[f"{layer}/{table}"]

    def bronze(table: str, df: DataFrame) -> DataFrame:
        return write("bronze", table, sinks.stamped(df, run.ingestion_timestamp))

    def bronze_csv(table: str, path: str, schema: StructType) -> DataFrame:
        lines = run.path("work", f"lines-{table}")
        found = bronze(table, readers.read_csv(spark, path, schema, lines))
        remove(spark, lines)  # bronze has it all
        return found

    customers_raw = bronze_csv("customers", inputs.customers, schemas.RAW_CUSTOMERS)
    accounts_raw = bronze_csv("accounts", inputs.accounts, schemas.RAW_ACCOUNTS)
    transactions_raw = bronze("transactions", readers.read_jsonl_as_delivered(spark, inputs.transactions))

    # What is known of the records of each source, from one pass; what follows only projects and filters.
    customers = write("work", "customers", silver.judged_customers(customers_raw, rules))
    silver_customers = write("silver", "customers", silver.customers_from(customers))
    people = gold.dim_customers(silver_customers, run.as_of)
    if rules.keeps_orphans:
        people = people.unionByName(gold.placeholder_customer(spark))
    dim_customers = write("gold", "dim_customers", people)
    accounts = write("work", "accounts", silver.judged_accounts(accounts_raw, dim_customers, rules))
    silver_accounts = write("silver", "accounts", silver.accounts_from(accounts))
    owned = write("work", "transactions", gold.owned_transactions(transactions_raw, silver_accounts, dim_customers, rules, run.keep))

    members = gold.dim_accounts_from(accounts)
    if rules.keeps_orphans:
        members = members.unionByName(gold.placeholder_accounts(owned, rules))
    write("gold", "dim_accounts", members)
    write("silver", "transactions", owned.select(*silver.SILVER_TRANSACTIONS))
    write("gold", "fact_transactions", gold.facts(owned, rules), "transaction_date" if run.partition_facts else None)

    rejected = [
        (gold.rejects(owned, rules), "transactions", "transaction_id"),
        (silver.rejected(accounts, silver.ACCOUNT_COLUMNS), "accounts", "account_id"),
        (silver.rejected(customers, silver.CUSTOMER_COLUMNS), "customers", "customer_id"),
    ]
    for df, source, key in rejected:
        write("quarantine", source, sinks.quarantine_rows(df, source, key))
    entries = ledger.transaction_entries(owned, rules, gold.reject_reason(owned.columns, rules))
    write("work", "ledger", entries.unionByName(ledger.account_entries(accounts, rules)).unionByName(ledger.customer_entries(customers)))

    path = sinks.overwrite(spark.createDataFrame(metrics, METRICS).coalesce(1), run.path("work", "metrics"), run.fmt)
    tables["work/metrics"] = readers.read_table(spark, path, run.fmt)
    return tables


def _records(tables: dict[str, DataFrame], layer: str, names: dict[str, str]) -> DataFrame:
    """``(name, records)`` of the tables of a layer, from the counts taken while they were written."""
    found = tables["work/metrics"].filter((F.col("layer") == layer) & (F.col("metric") == _RECORDS))
    shown = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])[F.col("table")]
    return found.select(shown.alias("name"), F.col("value").alias("records")).filter(F.col("name").isNotNull())


def quality_report(
    tables: dict[str, DataFrame], run: Run, rules: RuleSet, run_timestamp: str, duration_seconds: int, stage: str | None = None
) -> DataFrame:
    """The report over the tables of a run as one row: aggregates of the ledger and the counts taken while
    writing.  No layer is read again."""
    found = tables["work/ledger"]
    sources = _records(tables, "bronze", {t: f"{t}_raw" for t in ("accounts", "transactions", "customers")})
    return report.report_document(
        ledger.flag_totals(found),
        sources,
        _records(tables, "gold", {t: t for t in _GOLD}),
        rules,
        run_timestamp,
        duration_seconds,
        stage,
        issues=ledger.issues(found, sources, rules),
    )


def write_report(document: DataFrame, path: str) -> str:
    return sinks.write_document(document.select(sinks.document(F.struct(*document.columns))), path)


def gold_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """All checks a finished gold layer must pass, as ``(check, violations)``.

    Keys are counted and matched; nulls, domains and emptiness were counted while the tables were
    written."""
    fact, accounts, customers = (tables[f"gold/{t}"] for t in _GOLD)
    counted = tables["work/metrics"].filter((F.col("layer") == "gold") & (F.col("metric") != _PLACEHOLDERS))
    empty = F.col("metric") == _RECORDS
    parts = [
        checks.key_unique(fact, "transaction_sk", "fact_transactions"),
        checks.key_unique(accounts, "account_sk", "dim_accounts"),
        checks.key_unique(customers, "customer_sk", "dim_customers"),
        checks.references(fact, "account_sk", accounts, "account_sk", "fact to accounts"),
        checks.references(fact, "customer_sk", customers, "customer_sk", "fact to customers"),
        checks.references(accounts, "customer_id", customers, "customer_id", "accounts to customers"),
        counted.select(
            F.when(empty, F.concat("table", F.lit(" not empty"))).otherwise(F.col("metric")).alias("check"),
            F.when(empty, (F.col("value") == 0).cast("bigint")).otherwise(F.col("value")).alias("violations"),
        ),
    ]
    out, *others = parts
    for other in others:
        out = out.unionAll(other)
    return out


def reconciled(tables: dict[str, DataFrame]) -> DataFrame:
    """Delivered rows of all three sources against gold, quarantine and removed copies, a row each, from
    the counts taken while they were written.  Placeholders were not delivered."""
    sources = {"transactions": "fact_transactions", "accounts": "dim_accounts", "customers": "dim_customers"}
    named = F.create_map(*[F.lit(x) for source, table in sources.items() for x in (table, source)])
    source = F.when(F.col("layer") == "gold", named[F.col("table")]).otherwise(F.col("table"))
    counted = tables["work/metrics"].withColumn("source", source).filter(F.col("source").isin(*sources))

    def total(layer: str, metric: str = _RECORDS) -> Column:
        return F.coalesce(F.sum(F.when((F.col("layer") == layer) & (F.col("metric") == metric), F.col("value"))), F.lit(0))

    return counted.groupBy(F.col("source").alias("table_name")).agg(
        total("bronze").alias("source_rows"),
        (total("gold") - total("gold", _PLACEHOLDERS)).alias("kept_rows"),
        total("quarantine").alias("rejected_rows"),
        total("work", _REMOVED).alias("duplicates_rows"),
    ).withColumn("unexplained", F.expr("source_rows - kept_rows - rejected_rows - duplicates_rows"))


def settle(earlier: dict[str, DataFrame], later: dict[str, DataFrame], run: Run) -> dict[str, DataFrame]:
    """Gold of an earlier run after accounts it did not know have arrived with a later one.

    The dimensions hold the members of both; placeholders give way to accounts that have arrived, and
    facts that waited for them get their owner's key and province.  Written below ``run.root`` as
    ``settled/...``; the earlier run stays as it is."""
    spark = later["gold/dim_accounts"].sparkSession
    merged = {
        "dim_customers": gold.with_arrived(earlier["gold/dim_customers"], later["gold/dim_customers"], "customer_id"),
        "dim_accounts": gold.with_arrived(earlier["gold/dim_accounts"], later["gold/dim_accounts"], "account_id"),
    }
    out: dict[str, DataFrame] = {}

    def write(table: str, df: DataFrame) -> None:
        path = sinks.overwrite(df, run.path("settled", table), run.fmt)
        out[f"settled/{table}"] = readers.read_table(spark, path, run.fmt).select(*df.columns)

    for table, df in merged.items():
        write(table, df)
    write("fact_transactions", gold.rekeyed(earlier["gold/fact_transactions"], out["settled/dim_accounts"], out["settled/dim_customers"]))
    return out
