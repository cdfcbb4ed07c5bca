"""What keeps the work of the layers in proportion to what a query wants of them."""

from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.catalogue.scans import json_files_of
from tierwell.operators import ledger
from tierwell.operators.dedupe import one_per_key
from tierwell.operators.rules import RuleSet
from tierwell.plans import gold
from tierwell.sources import readers

BRONZE = """transaction_id string, account_id string, transaction_date string, transaction_time string, transaction_type string,
    merchant_category string, amount string, currency string, channel string, ingestion_timestamp string"""
STAMP = "2026-01-01 06:00:00"


def bronze(spark):
    rows = [
        ("t1", "a1", "2025-01-01", "10:00:00", "DEBIT", "c", "1.50", "ZAR", "POS", STAMP),
        ("t1", "a1", "2025-01-01", "10:00:00", "DEBIT", "c", "1.50", "R", "POS", STAMP),
        ("t2", "a1", "2025-01-02", "10:00:00", "FEE", "c", "2.00", "rands", "POS", STAMP),
        ("t3", "a9", "2025-01-02", "10:00:00", "FEE", None, "2.00", "ZAR", "POS", STAMP),
        ("t4", "a2", "2025-01-02", "10:00:00", "FEE", None, "2.00", "ZAR", "POS", STAMP),
        ("t5", "a1", "2025-01-02", None, "FEE", None, "x", "ZAR", None, STAMP),
        ("t6", None, "no date", "10:00:00", None, None, "1", None, "POS", STAMP),
        (None, "a1", "2025-01-02", "10:00:00", "FEE", None, "2.00", "ZAR", "POS", STAMP),
        ("", "a1", "2025-01-02", "10:00:00", "FEE", None, "2.00", "ZAR", "POS", None),
    ]
    return spark.createDataFrame(rows, BRONZE)


def owners(spark):
    accounts = spark.createDataFrame([("a1", "c1"), ("a2", "c9")], "account_id string, customer_ref string")
    return accounts, spark.createDataFrame([("c1", "P", 7)], "customer_id string, province string, customer_sk long")


def test_facts_are_the_rows_without_a_reason_and_orphans_end_in_the_join(spark):
    keeping = RuleSet.default().changed(**{fv.ORPHANED_ACCOUNT: {"handling_action": "FLAGGED"}})
    for rules in (RuleSet.default(), keeping):
        for evidence in (False, True):
            owned = gold.owned_transactions(bronze(spark), *owners(spark), rules, evidence=evidence)
            want = owned.filter(gold.reject_reason(owned.columns, rules).isNull()).select("transaction_id").collect()
            assert sorted(gold.facts(owned, rules).select("transaction_id").collect()) == sorted(want)
            assert want
    plan = gold.facts(gold.owned_transactions(bronze(spark), *owners(spark))).select("dq_flag")._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftOuter" not in plan


def test_one_per_key_looks_at_no_column_behind_the_last_wanted(spark):
    rows = [("a", 1, "x", "p", "1"), ("a", 1, "x", "q", "2"), ("a", 1, None, "z", "3"), ("b", None, "x", "p", "4"), ("b", None, None, "q", "5"), (None, 1, "x", "p", "6")]
    df = spark.createDataFrame(rows, "k string, t int, v string, w string, last string")
    for keep in ("latest", "earliest"):
        for only in (["k"], ["k", "v"], ["v", "t"], ["w"], list(df.columns)):
            whole = one_per_key(df, "k", ["t"], keep=keep).select(*[c for c in df.columns if c in only])
            some = one_per_key(df, "k", ["t"], keep=keep, only=only)
            assert some.columns == whole.columns
            assert sorted(some.collect(), key=str) == sorted(whole.collect(), key=str)
    slim = one_per_key(df, "k", ["t"], only=["k", "v"])._jdf.queryExecution().optimizedPlan()
    assert "last" not in slim.toString().split("LogicalRDD")[0]


def test_rule_sets_that_differ_in_handling_share_one_stored_frame(spark, monkeypatch):
    default = RuleSet.default()
    moved = default.changed(**{fv.CURRENCY_VARIANT: {"handling_action": "QUARANTINED"}})
    strict = default.changed(**{fv.CURRENCY_VARIANT: {"strict": True}})
    latest = default.changed(**{fv.DUPLICATE_DEDUPED: {"handling_action": fv.KEEP_LATEST_ACTIONS[0]}})
    assert default.tests_key() == moved.tests_key()
    assert len({r.tests_key() for r in (default, strict, latest)}) == 3
    written, store = [], gold.stored
    monkeypatch.setattr(gold, "stored", lambda df, label: (written.append(label), store(df, label))[1])
    sets = {"default": default, "moved": moved, "latest": latest}
    found = gold.owned_under_each(bronze(spark), *owners(spark), sets, evidence=False)
    assert len(written) == 2
    for name, rules in sets.items():
        alone = gold.owned_transactions(bronze(spark), *owners(spark), rules, evidence=False)
        assert sorted(found[name].select(alone.columns).collect(), key=str) == sorted(alone.collect(), key=str)


def test_a_summed_ledger_has_the_sums_of_the_whole_one(spark):
    rules = RuleSet.default()
    owned = gold.owned_transactions(bronze(spark).unionByName(bronze(spark)), *owners(spark), rules, raw_text=False)
    assert "_raw" not in owned.columns
    reason = gold.reject_reason(owned.columns, rules)
    rows = [("a", None, False, False, 0, 1), ("b", None, False, True, 2, 3), ("c", None, False, True, 2, 3), (None, "NULL_REQUIRED_ACCOUNT", False, False, 0, 1), (None, "MALFORMED_LINE", True, False, 0, 1), ("d", "NO_CUSTOMER_REF", False, None, 0, 1)]
    kinds = "reason string, _malformed boolean, _bad_date boolean, _n_bad_date long, _dup_count long"
    accounts, customers = (spark.createDataFrame(rows, f"{key} string, {kinds}") for key in ("account_id", "customer_id"))

    def entries(summed):
        return [ledger.transaction_entries(owned, rules, reason, summed), ledger.account_entries(accounts, rules, summed), ledger.customer_entries(customers, summed)]

    for whole, summed in zip(entries(False), entries(True), strict=True):
        assert whole.columns == summed.columns
        assert sorted(ledger.totals(whole).collect(), key=str) == sorted(ledger.totals(summed).collect(), key=str)
        assert summed.count() < whole.count()
        assert sorted(ledger.flag_totals(ledger.totals(summed)).collect()) == sorted(ledger.flag_totals(whole).collect())
        assert sorted(ledger.quarantined(ledger.totals(summed)).collect(), key=str) == sorted(ledger.quarantined(whole).collect(), key=str)


def test_json_files_are_compressed_and_bounded(spark, tmp_path):
    lines = spark.range(0, 25, 1, 1).select(F.concat(F.lit('{"transaction_id": "'), F.col("id").cast("string"), F.lit('"}')).alias("value"))
    json_files_of(lines, str(tmp_path / "in"), 10)
    assert len(list((tmp_path / "in").glob("*.gz"))) == 3
    assert sorted(int(r[0]) for r in readers.read_jsonl(spark, str(tmp_path / "in")).select("transaction_id").collect()) == list(range(25))
