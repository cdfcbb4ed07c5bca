"""CSV files as users have them, the issue ledger against a recount, counts taken while writing, and
accounts that arrive late."""

import json
from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell import schemas
from tierwell.operators import checks, ledger
from tierwell.operators.rules import RuleSet
from tierwell.plans import batch, gold
from tierwell.sources import readers
from tierwell.sources.bucketed import overwrite_bucketed, read_bucketed
from tierwell.sources.shared import exists


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- CSV ----------------------------------------------------------------------------------------


@pytest.fixture()
def odd_folder(tmp_path):
    folder = tmp_path / "in [a] {b} 100% *?\\ c%20d"
    folder.mkdir()
    return folder


def test_csv_below_a_path_that_looks_like_a_glob(spark, odd_folder):
    (odd_folder / "one 1.csv").write_text("a,b\n1,2\n\n   \n3,4\n")
    (odd_folder / "two[2].csv").write_text('﻿B,A,more,,b\n"2, two",1,9,x,y\n')
    wanted = schemas._strings("a", "b", "c")
    df = readers.read_csv(spark, str(odd_folder), wanted)
    assert df.columns == ["a", "b", "c", "more", "_c3", "b_c4", schemas.CORRUPT]
    assert {tuple(r) for r in df.collect()} == {("1", "2", None, None, None, None, None), ("3", "4", None, None, None, None, None), ("1", "2, two", None, "9", "x", "y", None)}
    for name in ("one 1.csv", "two[2].csv"):
        assert readers.read_csv(spark, str(odd_folder / name), wanted).count() == {"o": 2, "t": 1}[name[0]]
    assert readers.read_csv(spark, [str(odd_folder / "one 1.csv"), str(odd_folder / "two[2].csv")], wanted).count() == 3


def test_globs_still_work(spark, tmp_path):
    for n in (1, 2, 3):
        (tmp_path / f"part{n}.csv").write_text(f"a\n{n}\n")
    assert sorted(r["a"] for r in readers.read_csv(spark, f"{tmp_path}/part[12].csv", schemas._strings("a")).collect()) == ["1", "2"]
    (tmp_path / "t.jsonl").write_text('{"transaction_id": "T"}\n')
    assert readers.read_jsonl(spark, f"{tmp_path}/*.jsonl").count() == 1


def test_lines_that_do_not_fit_are_kept_whole(spark, tmp_path):
    (tmp_path / "1.csv").write_text('a,b,c\n1,2\n1,2,3,4\n"x, y",2,3\n,,\n')
    (tmp_path / "2.csv").write_text("c,b,a\n3,2\n")
    found = readers.read_csv(spark, str(tmp_path), schemas._strings("a", "b", "c"))
    assert {tuple(r) for r in found.collect()} == {
        ("1", "2", None, "1,2"), ("1", "2", "3", "1,2,3,4"), ("x, y", "2", "3", None), (None, None, None, None), (None, "2", "3", "3,2"),
    }
    # One column alone is parsed like all of them.
    assert Counter(r[0] for r in found.select("c").collect()) == Counter([None, "3", "3", None, "3"])


def test_csv_text_is_read_once(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    lines = readers.csv_lines(spark, str(tmp_path), str(tmp_path / "lines"))
    assert "FileScan text" not in plan(lines) and plan(lines).count("FileScan parquet") == 1
    df = readers.read_csv(spark, str(tmp_path), schemas._strings("a", "b"), str(tmp_path / "lines2"))
    assert "FileScan text" not in plan(df) and "FileScan csv" not in plan(df)
    assert [tuple(r) for r in df.select("a", "b").collect()] == [("1", "2")] * 2


def test_many_blocks_of_a_file_share_its_header(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n" + "".join(f"{i},{i * i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        df = readers.read_csv(spark, str(tmp_path / "1.csv"), schemas._strings("a", "b"))
        assert {(int(r["a"]), int(r["b"])) for r in df.collect()} == {(i, i * i) for i in range(3000)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_csv_of_nothing(spark, tmp_path):
    (tmp_path / "empty.csv").write_text("")
    df = readers.read_csv(spark, str(tmp_path), schemas._strings("a"))
    assert df.columns == ["a", schemas.CORRUPT] and df.count() == 0
    (tmp_path / "empty.csv").write_text("a\n")
    assert readers.read_csv(spark, str(tmp_path), schemas._strings("a")).count() == 0


# -- a run with dirt in all sources --------------------------------------------------------------

CUSTOMERS = """customer_id,id_number,first_name,last_name,dob,gender,province,income_band,segment,risk_score,kyc_status,product_flags
C1,1,Ann,A,1980-05-01,f,Gauteng,low,mass,5,verified,HL
C2,2,Bo,B,never,M,Limpopo,HIGH,private,2,pending,
C2,2,Bo,B,never,M,Limpopo,HIGH,private,1,pending,
C3,3,Cy,C,soon,M,Limpopo,HIGH,private,1,pending,
,4,No,Key,1990-01-01,M,Limpopo,HIGH,private,1,pending,PL
C5,5,cut
"""
ACCOUNTS = """account_id,customer_ref,account_type,account_status,open_date,product_tier,mobile_number,digital_channel,credit_limit,current_balance,last_activity_date
A1,C1,savings,active,bad,basic,,app,,100.50,worse
A2,C2,credit,active,14/06/2021,basic,,app,5000,10,1711065600
A2,C2,credit,active,later,basic,,app,5000,10,1711065600
A3,C9,savings,active,2021-06-14,basic,,app,,1,
A4,C9,savings,active,17/13/2020,basic,,app,n/a,1,
,C1,savings,active,17/13/2020,basic,,app,,1,
A6,,savings,active,2021-06-14,basic,,app,,1,
A7,C1,savings
"""


def txn(number, account="A1", **changes):
    row = {
        "transaction_id": number, "account_id": account, "transaction_date": "2025-03-22", "transaction_time": "14:37:05",
        "transaction_type": "debit", "merchant_category": "fuel", "amount": 349.5, "currency": "ZAR", "channel": "pos",
    }
    return row | changes


TRANSACTIONS = [
    txn("T1"),
    txn("T2"), txn("T2", transaction_time="14:37:06", currency="R"), txn("T2", transaction_time="14:37:07", currency="R", amount="x"),
    txn("T3", "A9", currency="rands"),
    txn("T4", "A3", currency="710"),
    txn("T5", "A3"),
    txn("T6", transaction_date="soon", currency="R"),
    txn("T7", "A9", channel=None),
    txn(None, "A9"),
    txn("T8", "A7"),
    txn("T9", "A6", currency="R"),
    txn("T10", transaction_type="gift", currency="R"),
]


def files(folder, accounts=ACCOUNTS):
    folder.mkdir(exist_ok=True)
    (folder / "customers.csv").write_text(CUSTOMERS)
    (folder / "accounts.csv").write_text(accounts)
    lines = [json.dumps(t) for t in TRANSACTIONS] + ['{"transaction_id": "T11", "account']
    (folder / "transactions.jsonl").write_text("\n".join(lines) + "\n")
    return batch.Inputs(*[str(folder / n) for n in ("customers.csv", "accounts.csv", "transactions.jsonl")])


def run(spark, folder, name="run=1", rules=None, accounts=ACCOUNTS):
    at = batch.Run(str(folder / name), date(2026, 1, 1), datetime(2026, 1, 1, 6))
    return batch.run_batch(spark, files(folder / "in [1]", accounts), at, rules), at


@pytest.fixture(scope="module")
def dirty(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("issues")
    return *run(spark, folder), folder


def entries(tables, source):
    rows = tables["work/ledger"].filter(F.col("source") == source).collect()
    return Counter({(r["record_key"], r["issue_code"], r["outcome"], r["reason"]): r["records"] for r in rows})


def test_cut_lines_go_to_quarantine_whole(dirty):
    tables, _, _ = dirty
    assert {r["account_id"] for r in tables["gold/dim_accounts"].collect()} == {"A1", "A2"}
    found = {r["reason"]: json.loads(json.loads(r["record"])["raw"]) for r in tables["quarantine/accounts"].collect()}
    assert found["MALFORMED_LINE"][schemas.CORRUPT] == "A7,C1,savings"
    # What was delivered is still there for records that were no use.
    assert found["NULL_REQUIRED_ACCOUNT"]["open_date"] == "17/13/2020"
    by_key = {r["record_key"]: json.loads(json.loads(r["record"])["raw"]) for r in tables["quarantine/accounts"].collect()}
    assert by_key["A4"]["open_date"] == "17/13/2020" and by_key["A4"]["credit_limit"] == "n/a"
    found = {r["reason"]: json.loads(json.loads(r["record"])["raw"]) for r in tables["quarantine/customers"].collect()}
    assert found["MALFORMED_LINE"][schemas.CORRUPT] == "C5,5,cut" and set(found) == {"MALFORMED_LINE", "NULL_REQUIRED"}
    assert {r["unexplained"] for r in batch.reconciled(tables).collect()} == {0}


def test_ledger_holds_every_record_with_an_issue(dirty):
    tables, _, _ = dirty
    gold_, out, copy = fv.GOLD, fv.QUARANTINE, fv.REMOVED_COPY
    assert entries(tables, "accounts") == Counter({
        ("A1", "DATE_FORMAT_ACCOUNT", gold_, None): 1,  # two bad dates, one record
        ("A2", "DATE_FORMAT_ACCOUNT", copy, None): 1, ("A2", "DUPLICATE_DEDUPED", copy, None): 1,
        ("A3", "UNKNOWN_CUSTOMER", out, "UNKNOWN_CUSTOMER"): 1,
        ("A4", "UNKNOWN_CUSTOMER", out, "UNKNOWN_CUSTOMER"): 1, ("A4", "DATE_FORMAT_ACCOUNT", out, "UNKNOWN_CUSTOMER"): 1,
        (None, "NULL_REQUIRED_ACCOUNT", out, "NULL_REQUIRED_ACCOUNT"): 1, (None, "DATE_FORMAT_ACCOUNT", out, "NULL_REQUIRED_ACCOUNT"): 1,
        ("A6", "NO_CUSTOMER_REF", out, "NO_CUSTOMER_REF"): 1, (None, "MALFORMED_LINE", out, "MALFORMED_LINE"): 1,
    })
    assert entries(tables, "customers") == Counter({
        ("C2", "DATE_FORMAT_CUSTOMER", gold_, None): 1, ("C2", "DATE_FORMAT_CUSTOMER", copy, None): 1, ("C2", "DUPLICATE_DEDUPED", copy, None): 1,
        ("C3", "DATE_FORMAT_CUSTOMER", gold_, None): 1, (None, "NULL_REQUIRED", out, "NULL_REQUIRED"): 1,
        (None, "MALFORMED_LINE", out, "MALFORMED_LINE"): 1,
    })
    null, orphan, miss = "NULL_REQUIRED", "ORPHANED_ACCOUNT", "MISSING_TRANSACTION_DATE"
    assert entries(tables, "transactions") == Counter({
        ("T2", "DUPLICATE_DEDUPED", gold_, None): 1, ("T2", "DUPLICATE_DEDUPED", copy, None): 2,
        ("T2", "CURRENCY_VARIANT", copy, None): 2, ("T2", "TYPE_MISMATCH", copy, None): 1,
        ("T3", orphan, out, orphan): 1, ("T3", "CURRENCY_VARIANT", out, orphan): 1,
        ("T4", "UNKNOWN_CUSTOMER", out, "UNKNOWN_CUSTOMER"): 1, ("T4", "CURRENCY_VARIANT", out, "UNKNOWN_CUSTOMER"): 1,
        ("T5", "UNKNOWN_CUSTOMER", out, "UNKNOWN_CUSTOMER"): 1,
        ("T6", "DATE_FORMAT", out, miss): 1, ("T6", "CURRENCY_VARIANT", out, miss): 1,
        ("T7", null, out, null): 1, ("T7", orphan, out, null): 1, (None, null, out, null): 1, (None, orphan, out, null): 1,
        ("T8", orphan, out, orphan): 1, ("T9", orphan, out, orphan): 1, ("T9", "CURRENCY_VARIANT", out, orphan): 1,
        ("T10", "TYPE_MISMATCH", gold_, None): 1, ("T10", "CURRENCY_VARIANT", gold_, None): 1,
        (None, "MALFORMED_LINE", out, "MALFORMED_LINE"): 1,
    })


def test_report_and_quarantine_are_sums_of_the_ledger(dirty):
    tables, at, _ = dirty
    report = batch.quality_report(tables, at, RuleSet.default(), "t", 1).first()
    found = {i["issue_type"] + ("" if i["issue_type"] != "date_format_inconsistency" else f" {i['records_affected']}"): (i["records_affected"], i["records_in_output"]) for i in report["dq_issues"]}
    assert found == {
        "null_required": (2, 0), "type_mismatch": (2, 1), "date_format_inconsistency 1": (1, 0), "currency_variants": (7, 1),
        "orphaned_transactions": (5, 0), "duplicate_transactions": (2, 1), "date_format_inconsistency 4": (4, 1),
        "date_format_inconsistency 3": (3, 2), "duplicate_accounts": (1, 0), "duplicate_customers": (1, 0),
        "malformed_line_accounts": (1, 0), "malformed_line_customers": (1, 0), "malformed_line_transactions": (1, 0),
        "no_customer_ref_accounts": (1, 0), "null_account_id": (1, 0), "null_customer_id": (1, 0),
        "unknown_customer_accounts": (2, 0), "unknown_customer_transactions": (2, 0),
    }
    # Every delivered record with an issue once: all of them but T1 and C1, and the deliveries that stayed of A2.
    assert report["total_records"] == 6 + 8 + 14 and report["clean_records"] == 3
    counted = {(r["source"], r["reason"]): r["records"] for r in ledger.quarantined(tables["work/ledger"]).collect()}
    listed = Counter((r["source"], r["reason"]) for s in ("accounts", "customers", "transactions") for r in tables[f"quarantine/{s}"].collect())
    assert counted == dict(listed)


def test_report_and_reconciliation_read_no_layer_again(dirty):
    tables, at, _ = dirty
    for df in (batch.quality_report(tables, at, RuleSet.default(), "t", 1), batch.reconciled(tables)):
        text = plan(df)
        assert "/work/" in text
        for layer in ("bronze", "silver", "gold", "quarantine"):
            assert f"/{layer}/" not in text
    checked = plan(batch.gold_checks(tables))
    assert "/work/metrics" in checked and "dq_flag" not in checked and "risk_score" not in checked


def test_counts_taken_while_writing_are_the_tables_counts(dirty, spark):
    tables, _, folder = dirty
    counts = {(r["layer"], r["table"]): r["value"] for r in tables["work/metrics"].filter("metric = 'records'").collect()}
    assert counts == {tuple(name.split("/")): df.count() for name, df in tables.items() if name != "work/metrics"}
    nulls = {r["metric"]: r["value"] for r in tables["work/metrics"].filter("layer = 'gold' AND metric LIKE '% present'").collect()}
    again = {}
    for name, schema in (("fact_transactions", schemas.FACT_TRANSACTIONS), ("dim_accounts", schemas.DIM_ACCOUNTS), ("dim_customers", schemas.DIM_CUSTOMERS)):
        again |= {r["check"]: r["violations"] for r in checks.required_nulls(tables[f"gold/{name}"], schema, name).collect()}
    # Two customers without a readable birth date, one account without a readable opening date.
    assert nulls == again and sum(nulls.values()) == 3
    assert not exists(spark, str(folder / "run=1" / "work" / "lines-customers"))


def test_dates_that_exclude_exclude_in_all_sources(spark, dirty):
    _, _, folder = dirty
    rules = RuleSet.default().changed(DATE_FORMAT={"handling_action": "QUARANTINED"})
    tables, at = run(spark, folder, "run=dates", rules)
    assert {r["account_id"] for r in tables["gold/dim_accounts"].collect()} == set()
    assert {r["customer_id"] for r in tables["gold/dim_customers"].collect()} == {"C1"}
    assert {r["unexplained"] for r in batch.reconciled(tables).collect()} == {0}
    report = batch.quality_report(tables, at, rules, "t", 1).first()
    assert {i["records_in_output"] for i in report["dq_issues"] if i["issue_type"] == "date_format_inconsistency"} == {0}


# -- accounts that arrive late ---------------------------------------------------------------------

KEEP = RuleSet.default().changed(ORPHANED_ACCOUNT={"handling_action": "FLAGGED"})
LATE = ACCOUNTS.replace("A7,C1,savings\n", "A7,C1,savings,active,2021-06-14,basic,,app,,1,\nA9,C3,savings,active,2021-06-14,basic,,app,,1,\n")


@pytest.fixture(scope="module")
def kept(spark, dirty):
    _, _, folder = dirty
    return *run(spark, folder, "run=kept", KEEP), folder


def violations(tables):
    return {r["check"]: r["violations"] for r in batch.gold_checks(tables).collect() if r["violations"]}


def test_the_action_alone_moves_orphans(dirty, kept):
    before = {r["transaction_id"] for r in dirty[0]["gold/fact_transactions"].collect()}
    facts = {r["transaction_id"]: r for r in kept[0]["gold/fact_transactions"].collect()}
    assert before == {"T1", "T2", "T10"} and set(facts) == before | {"T3", "T8", "T9"}
    assert {r["reason"] for r in kept[0]["quarantine/transactions"].collect()}.isdisjoint({"ORPHANED_ACCOUNT"})
    assert facts["T8"]["dq_flag"] == "ORPHANED_ACCOUNT" and facts["T8"]["province"] == "UNKNOWN"
    members = {r["account_id"]: r for r in kept[0]["gold/dim_accounts"].collect()}
    assert set(members) == {"A1", "A2", "A6", "A7", "A9"} and members["A9"]["customer_id"] == "UNKNOWN"
    assert facts["T8"]["account_sk"] == members["A7"]["account_sk"]
    # Nothing but the unreadable dates of the files.
    assert violations(kept[0]) == {"dim_accounts.open_date present": 1, "dim_customers.age_band present": 2}
    assert schemas.differences(kept[0]["gold/dim_accounts"], schemas.DIM_ACCOUNTS) == []
    assert {r["unexplained"] for r in batch.reconciled(kept[0]).collect()} == {0}
    report = batch.quality_report(kept[0], kept[1], KEEP, "t", 1).first()
    assert {(i["handling_action"], i["records_affected"], i["records_in_output"]) for i in report["dq_issues"] if i["issue_type"] == "orphaned_transactions"} == {("FLAGGED", 5, 3)}


def test_a_disabled_rule_keeps_no_orphans():
    assert not RuleSet.default().changed(ORPHANED_ACCOUNT={"handling_action": "FLAGGED", "enabled": False}).keeps_orphans
    assert KEEP.keeps_orphans and not RuleSet.default().keeps_orphans


def test_facts_are_rekeyed_once_accounts_arrive(spark, kept):
    tables, at, folder = kept
    later, _ = run(spark, folder, "run=later", KEEP, LATE)
    settled = batch.settle(tables, later, batch.Run(str(folder / "run=settled"), at.as_of, at.ingestion_timestamp))
    people = {r["customer_id"]: r["customer_sk"] for r in settled["settled/dim_customers"].collect()}
    members = {r["account_id"]: r["customer_id"] for r in settled["settled/dim_accounts"].collect()}
    assert members == {"A1": "C1", "A2": "C2", "A7": "C1", "A9": "C3", "A6": "UNKNOWN"}
    facts = {r["transaction_id"]: r for r in settled["settled/fact_transactions"].collect()}
    old = {r["transaction_id"]: r for r in tables["gold/fact_transactions"].collect()}
    assert set(facts) == set(old) and all(facts[t]["account_sk"] == old[t]["account_sk"] for t in old)
    assert (facts["T8"]["customer_sk"], facts["T8"]["province"]) == (people["C1"], "Gauteng")
    assert (facts["T3"]["customer_sk"], facts["T3"]["province"]) == (people["C3"], "Limpopo")
    assert (facts["T9"]["customer_sk"], facts["T9"]["province"]) == (people["UNKNOWN"], "UNKNOWN")
    whole = {"gold/" + name.split("/")[1]: df for name, df in settled.items()} | {"work/metrics": later["work/metrics"]}
    assert not [c for c, n in violations(whole).items() if " to " in c or "unique" in c]


def test_only_waiting_facts_are_shuffled(spark, kept):
    tables, _, _ = kept
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(gold.rekeyed(tables["gold/fact_transactions"], tables["gold/dim_accounts"], tables["gold/dim_customers"]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scans = [line for line in text.splitlines() if "FileScan" in line and "fact_transactions" in line]
    assert len(scans) == 2 and all("customer_sk" in s for s in scans) and "EqualTo(customer_sk" in text


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_bucketed_run_joins_facts_where_they_lie(spark, dirty, kept):
    _, _, folder = dirty
    at = batch.Run(str(folder / "run=bucketed 'it's'"), date(2026, 1, 1), datetime(2026, 1, 1, 6), buckets=4)
    tables = batch.run_batch(spark, files(folder / "in [1]", ACCOUNTS), at, KEEP)
    for name in ("gold/fact_transactions", "gold/dim_accounts", "work/metrics"):
        assert Counter(map(tuple, tables[name].collect())) == Counter(map(tuple, kept[0][name].collect())), name
    assert violations(tables) == violations(kept[0])
    # Another session, and a later delivery of accounts.
    later = spark.newSession()
    facts, members = (read_bucketed(later, at.path("gold", t)) for t in ("fact_transactions", "dim_accounts"))
    later.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    later.conf.set("spark.sql.adaptive.enabled", "false")
    both = facts.join(members, "account_sk")
    assert "Exchange" not in _plan(both) and "SortMergeJoin" in _plan(both)
    assert both.count() == facts.count() == 6
    delivered = later.createDataFrame([(r["account_sk"], 1) for r in members.collect()], "sk long, x int")
    joined = facts.join(delivered, facts["account_sk"] == delivered["sk"])
    assert _plan(joined).count("Exchange hashpartitioning(sk") == 1 == _plan(joined).count("Exchange hash")
    with pytest.raises(ValueError):
        batch.run_batch(spark, files(folder / "in [1]", ACCOUNTS), batch.Run("x", at.as_of, at.ingestion_timestamp, partition_facts=True, buckets=4))


def test_a_hot_bucket_is_not_left_to_one_task(spark, tmp_path):
    even = spark.range(4000).selectExpr("id AS k", "id AS v")
    hot = spark.range(4000).selectExpr("if(id % 3 = 0, 7, id) AS k", "id AS v")
    found = {}
    for name, df in (("even", even), ("hot", hot), ("none", even.limit(0))):
        path = str(tmp_path / name)
        counts = overwrite_bucketed(df, path, "k", 64, [F.sum("v").alias("total")])
        found[name] = read_bucketed(spark, path)
        assert Counter(map(tuple, found[name].collect())) == Counter(map(tuple, df.collect()))
        assert counts == {"total": df.agg(F.sum("v")).first()[0] or 0}
    by_key = {name: _plan(df.groupBy("k").count()) for name, df in found.items()}
    assert "Exchange" not in by_key["even"] and "Exchange" in by_key["hot"]
    # Written anew, in another layout.
    overwrite_bucketed(hot.limit(10), str(tmp_path / "even"), "v", 2)
    assert read_bucketed(spark, str(tmp_path / "even")).count() == 10
