"""The live tables against the batch formulas, with restarts, repeats, late and broken events."""

import json
import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tierwell import schemas
from tierwell.sources.readers import empty, read_jsonl
from tierwell.streaming import events as ev
from tierwell.streaming.keyed_log import KeyedLog
from tierwell.streaming.latency import BatchTimes
from tierwell.streaming.live import LiveTables

WRITTEN = datetime(2026, 3, 21, tzinfo=timezone.utc)


def event(number, account, second, amount=1, kind="DEBIT", **changes):
    minute, second = divmod(second, 60)
    row = {
        "account_id": account, "transaction_id": number, "transaction_date": "2026-03-20",
        "transaction_time": f"10:{minute:02d}:{second:02d}", "transaction_type": kind, "amount": amount, "currency": "ZAR",
        "channel": "app",
    }
    row.update(changes)
    return row


def deliver(folder, number, rows):
    path = folder / f"stream_20260320_100000_{number:04d}.jsonl"
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


def accounts(spark):
    return spark.createDataFrame([("A", "100.00"), ("B", "3")], "account_id string, current_balance string")


def balances(df):
    return {r["account_id"]: (str(r["current_balance"]), r["last_transaction_timestamp"].strftime("%M:%S")) for r in df.collect()}


def test_live_tables(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    live = LiveTables(spark, str(tmp_path / "out"))
    assert live.current_balances(accounts(spark)).count() == 0
    deliver(folder, 1, [
        event("1", "A", 0, 5), event("2", "A", 1, "7.50", "credit"), event("2", "A", 9, "7.50", "credit"),
        event("9", "Z", 0), event("8", "A", 0, "n/a"), event("7", "", 0), event("6", "A", 0, transaction_time="x"),
        event("5", "A", 2, 50, "VIEW"),
    ])
    (folder / "other.jsonl").write_text(json.dumps(event("99", "A", 0, 1000)) + "\n")
    live.drain(str(folder), clock=lambda: WRITTEN)
    first = live.current_balances(accounts(spark))
    assert schemas.differences(first, schemas.CURRENT_BALANCES) == []
    assert balances(first) == {"A": ("102.50", "00:09"), "Z": ("-1.00", "00:00")}
    assert balances(live.current_balances(accounts(spark), keep_orphans=False)) == {"A": ("102.50", "00:09")}
    assert {r["updated_at"] for r in first.collect()} == {WRITTEN.replace(tzinfo=None)}

    # A restart with nothing new changes nothing.
    live.drain(str(folder), clock=lambda: WRITTEN)
    assert balances(live.current_balances(accounts(spark)))["A"] == ("102.50", "00:09")

    # Another process: a repeat, a late event, a new account; and a base under the log.
    again = LiveTables(spark, str(tmp_path / "out"))
    again.compact()
    deliver(folder, 2, [event("1", "A", 0, 5), event("3", "A", 0, 1, "FEE"), event("3", "B", 5, 1, "reversal")])
    again.drain(str(folder), clock=lambda: WRITTEN)
    want = {"A": ("101.50", "00:09"), "B": ("4.00", "00:05"), "Z": ("-1.00", "00:00")}
    assert balances(again.current_balances(accounts(spark))) == want
    again.compact()
    assert balances(again.current_balances(accounts(spark))) == want
    recent = again.recent_transactions()
    assert schemas.differences(recent, schemas.RECENT_TRANSACTIONS) == []
    assert sorted((r["account_id"], r["transaction_id"]) for r in recent.collect()) == [
        ("A", "1"), ("A", "2"), ("A", "3"), ("A", "5"), ("B", "3"), ("Z", "9")
    ]


def test_every_delivery_counts_when_asked(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    deliver(folder, 1, [event("1", "A", 0, 5), event("1", "A", 1, 5)])
    live = LiveTables(spark, str(tmp_path / "out"))
    live.drain(str(folder), count_repeats=True, clock=lambda: WRITTEN)
    assert balances(live.current_balances(accounts(spark))) == {"A": ("90.00", "00:01")}


def test_running_for_good(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    deliver(folder, 1, [event("1", "A", 0, 5)])
    live = LiveTables(spark, str(tmp_path / "out"))
    queries = live.start(str(folder), every="1 second", clock=lambda: WRITTEN, tables=["current_balances"])
    try:
        queries[0].processAllAvailable()
        deliver(folder, 2, [event("2", "A", 3, 5)])
        queries[0].processAllAvailable()
    finally:
        queries[0].stop()
    assert balances(live.current_balances(accounts(spark))) == {"A": ("90.00", "00:03")}


def test_a_crash_between_write_and_commit_counts_nothing_twice(spark, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    folder.mkdir()
    deliver(folder, 1, [event("1", "A", 0, 5)])
    live = LiveTables(spark, str(tmp_path / "out"))
    live.drain(str(folder), clock=lambda: WRITTEN)
    deliver(folder, 2, [event("1", "A", 7, 5), event("2", "A", 3, 10)])
    publish = KeyedLog._publish

    def crash(self, kind, number):
        publish(self, kind, number)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(KeyedLog, "_publish", crash)
    with pytest.raises(Exception, match="lost after the write"):
        live.drain(str(folder), clock=lambda: WRITTEN, tables=["current_balances"])
    with pytest.raises(Exception, match="lost after the write"):
        live.drain(str(folder), clock=lambda: WRITTEN, tables=["recent_transactions"])
    monkeypatch.setattr(KeyedLog, "_publish", publish)
    live.drain(str(folder), clock=lambda: WRITTEN)
    assert balances(live.current_balances(accounts(spark))) == {"A": ("85.00", "00:07")}
    assert live.recent_transactions().count() == 2


def test_a_repeated_batch_replaces_its_own_output(spark, tmp_path):
    live = LiveTables(spark, str(tmp_path / "out"))
    rows = spark.createDataFrame([("A", "1.00")], "account_id string, delta_sum string").select(
        "account_id",
        F.col("delta_sum").cast("decimal(18,2)").alias("delta_sum"),
        F.lit("2026-03-20 10:00:00").cast("timestamp").alias("last_transaction_timestamp"),
        F.lit("2026-03-20 10:00:00").cast("timestamp").alias("updated_at"),
    )
    rows = rows.withColumn("seed", F.lit(None).cast("decimal(18,2)"))
    live.balances.append(rows, 0)
    live.balances.append(rows, 0)
    live.balances.compact()
    live.balances.append(rows.withColumn("delta_sum", F.lit("2.00").cast("decimal(18,2)")), 1)
    live.balances.append(rows.withColumn("delta_sum", F.lit("2.00").cast("decimal(18,2)")), 1)
    # A folder that was written but never published does not count.
    rows.withColumn("batch", F.lit(7).cast("bigint")).write.parquet(str(tmp_path / "out/current_balances/log/id=7"))
    assert balances(live.current_balances(accounts(spark))) == {"A": ("103.00", "00:00")}


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    """Three hundred deliveries, a third of them of one account, some repeated."""
    rng = random.Random(7)
    rows = []
    for n in range(260):
        account = "hot" if n % 3 == 0 else f"A{n % 11}"
        rows.append(event(f"T{n}", account, rng.randrange(1800), rng.randrange(1, 500), rng.choice(["DEBIT", "CREDIT", "FEE", "X"])))
    rows += [dict(r, transaction_time="11:00:00") for r in rng.sample(rows, 40)]
    rng.shuffle(rows)
    return rows


def test_live_tables_equal_the_batch_formulas_for_any_split(spark, tmp_path, many):
    folder, whole = tmp_path / "in", tmp_path / "whole.jsonl"
    folder.mkdir()
    whole.write_text("".join(json.dumps(r) + "\n" for r in many))
    cuts = [0, 7, 90, 91, 200, len(many)]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:]), start=1):
        deliver(folder, n, many[a:b])
    live = LiveTables(spark, str(tmp_path / "out"))
    live.drain(str(folder), files_per_batch=2, clock=lambda: WRITTEN)

    events = ev.valid_events(read_jsonl(spark, str(whole)))
    at = F.lit("2026-03-21 00:00:00").cast("timestamp")
    want = ev.upsert_balances(empty(spark, schemas.CURRENT_BALANCES), events, accounts(spark), at)
    assert balances(live.current_balances(accounts(spark))) == balances(want)
    recent = ev.keep_recent(ev.as_recent(events, at))
    assert sorted(map(tuple, live.recent_transactions().collect())) == sorted(map(tuple, recent.collect()))

    # Brute force, without Spark.
    per_account: dict = {}
    for r in many:
        latest = per_account.setdefault(r["account_id"], {})
        if r["transaction_id"] not in latest or r["transaction_time"] > latest[r["transaction_id"]]:
            latest[r["transaction_id"]] = r["transaction_time"]
    for account, latest in per_account.items():
        top = sorted(latest.items(), key=lambda kv: kv[0])
        top = sorted(top, key=lambda kv: kv[1], reverse=True)[:50]
        got = recent.filter(F.col("account_id") == account).collect()
        assert {r["transaction_id"] for r in got} == {t for t, _ in top}


def test_upsert_in_two_steps_equals_one(spark, many):
    kinds = "account_id string, transaction_id string, transaction_date string, transaction_time string, transaction_type string, amount string, channel string"
    names = [k.split()[0] for k in kinds.split(", ")]
    def frame(rows):
        return ev.valid_events(spark.createDataFrame([tuple(str(r[n]) for n in names) for r in rows], kinds))

    at = F.lit("2026-03-21 00:00:00").cast("timestamp")
    start = empty(spark, schemas.CURRENT_BALANCES)
    one = ev.upsert_balances(start, frame(many), accounts(spark), at, count_repeats=True)
    half = ev.upsert_balances(start, frame(many[:100]), accounts(spark), at, count_repeats=True)
    two = ev.upsert_balances(half, frame(many[100:]), accounts(spark), at, count_repeats=True)
    assert balances(one) == balances(two)
    rows = ev.as_recent(frame(many), at)
    merged = ev.merge_recent(ev.keep_recent(ev.as_recent(frame(many[:100]), at), 5), ev.as_recent(frame(many[100:]), at), 5)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, ev.keep_recent(rows, 5).collect()))


def test_files_of_any_age_count(spark, tmp_path):
    import os

    folder = tmp_path / "in"
    folder.mkdir()
    live = LiveTables(spark, str(tmp_path / "out"))
    deliver(folder, 1, [event("1", "A", 0, 5)])
    live.drain(str(folder), clock=lambda: WRITTEN, tables=["current_balances"])
    deliver(folder, 2, [event("2", "A", 3, 10)])
    old = time.time() - 30 * 86400
    os.utime(folder / "stream_20260320_100000_0002.jsonl", (old, old))
    live.drain(str(folder), clock=lambda: WRITTEN, tables=["current_balances"])
    assert balances(live.current_balances(accounts(spark))) == {"A": ("85.00", "00:03")}


def test_recent_rows_do_not_depend_on_the_split(spark):
    kinds = "account_id string, transaction_id string, transaction_date string, transaction_time string, transaction_type string, amount string, channel string"
    events = ev.valid_events(spark.createDataFrame([("A", t, "2026-03-20", "10:00:00", "DEBIT", "1", "app") for t in ("a", "b")], kinds))
    at = [F.lit(f"2026-03-21 00:00:0{n}").cast("timestamp") for n in (0, 1)]
    first, second = (ev.as_recent(events.filter(F.col("transaction_id") == t), a) for t, a in zip(("a", "b"), at))
    split = ev.merge_recent(ev.keep_recent(first, 1), second, 1)
    assert [r["transaction_id"] for r in split.collect()] == ["a"] == [r["transaction_id"] for r in ev.keep_recent(ev.as_recent(events, at[0]), 1).collect()]


def test_repeats_of_seen_events_count_once(spark, many):
    kinds = "account_id string, transaction_id string, transaction_date string, transaction_time string, transaction_type string, amount string, channel string"
    names = [k.split()[0] for k in kinds.split(", ")]

    def frame(rows):
        return ev.valid_events(spark.createDataFrame([tuple(str(r[n]) for n in names) for r in rows], kinds))

    at = F.lit("2026-03-21 00:00:00").cast("timestamp")
    start = empty(spark, schemas.CURRENT_BALANCES)
    one = ev.upsert_balances(start, frame(many), accounts(spark), at)
    half = ev.upsert_balances(start, frame(many[:150]), accounts(spark), at)
    two = ev.upsert_balances(half, frame(many[100:]), accounts(spark), at, seen=frame(many[:150]))
    assert balances(one) == balances(two)


def test_seeds_stay_and_tables_are_published(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    deliver(folder, 1, [event("1", "A", 0, 5), event("2", "Z", 0, 1), event("3", "A", 0, "n/a"), event("", "A", 0)])
    (folder / "stream_broken.jsonl").write_text('{"account_id": "A", "tran\n')
    live = LiveTables(spark, str(tmp_path / "out"))
    live.drain(str(folder), clock=lambda: WRITTEN, accounts=accounts(spark))
    assert balances(live.current_balances()) == {"A": ("95.00", "00:00"), "Z": ("-1.00", "00:00")}
    assert sorted(r["reason"] for r in live.rejected_events().collect()) == ["MALFORMED_LINE", "MISSING_AMOUNT", "NULL_REQUIRED"]
    refreshed = spark.createDataFrame([("A", "95.00"), ("Z", "7.00")], "account_id string, current_balance string")
    for n in range(2, 6):
        deliver(folder, n, [event(str(n * 10), "A", n, 1)])
        live.drain(str(folder), clock=lambda: WRITTEN, accounts=refreshed)
        live.compact()
    assert balances(live.current_balances(refreshed)) == {"A": ("91.00", "00:05"), "Z": ("-1.00", "00:00")}
    paths = live.publish()
    table = spark.read.parquet(paths["current_balances"])
    assert schemas.differences(table, schemas.CURRENT_BALANCES) == [] and balances(table)["A"] == ("91.00", "00:05")
    assert schemas.differences(spark.read.parquet(paths["recent_transactions"]), schemas.RECENT_TRANSACTIONS) == []
    # Neither the folders of old batches nor their marks are kept for ever.
    assert len(list((tmp_path / "out/current_balances/log").glob("id=*"))) <= 2
    assert len(list((tmp_path / "out/current_balances/published-log").glob("id=*"))) <= 2


def _change_rows(spark, accounts_and_amounts):
    return spark.createDataFrame(accounts_and_amounts, "account_id string, delta_sum string").select(
        "account_id",
        F.col("delta_sum").cast("decimal(18,2)").alias("delta_sum"),
        F.lit("2026-03-20 10:00:00").cast("timestamp").alias("last_transaction_timestamp"),
        F.lit("2026-03-20 10:00:00").cast("timestamp").alias("updated_at"),
        F.lit(None).cast("decimal(18,2)").alias("seed"),
    )


def _base_files(root):
    return {str(p): p.stat().st_mtime_ns for p in root.glob("base/id=*/bucket=*/*.parquet")}


def test_a_compaction_rewrites_touched_buckets_only(spark, tmp_path):
    live = LiveTables(spark, str(tmp_path / "out"), buckets=8)
    root = tmp_path / "out/current_balances"
    live.balances.append(_change_rows(spark, [(f"A{n}", "1") for n in range(200)] + [(None, "1")]), 0)
    live.balances.compact()
    first = _base_files(root)
    assert len({p.split("bucket=")[1].split("/")[0] for p in first}) == 8
    live.balances.append(_change_rows(spark, [("A7", "10"), ("A7", "5")]), 1)
    live.balances.compact()
    second = _base_files(root)
    new = set(second) - set(first)
    assert len({p.split("bucket=")[1].split("/")[0] for p in new}) == 1 and len(new) == 1
    assert all(second[p] == stamp for p, stamp in first.items() if p in second)
    read = {r["account_id"]: r["delta_sum"] for r in live.balances.read().collect()}
    assert len(read) == 201 and read["A7"] == 16 and read["A8"] == 1 and read[None] == 1

    # One more: what neither of the last two bases refers to is gone, nothing is lost.
    live.balances.append(_change_rows(spark, [("A7", "1"), ("B", "3")]), 2)
    live.balances.compact()
    read = {r["account_id"]: r["delta_sum"] for r in live.balances.read().collect()}
    assert len(read) == 202 and read["A7"] == 17 and read["B"] == 3
    assert len(_base_files(root)) <= 8 + 2

    # An account is looked up in its bucket alone, and in the log.
    live.balances.append(_change_rows(spark, [("A7", "100"), ("A9", "1")]), 3)
    one = live.current_balances(only=["A7", "unknown"])
    assert balances(one) == {"A7": ("117.00", "00:00")}
    base_files = [p for p in live.balances.lookup(["A7"]).inputFiles() if "/base/" in p]
    assert len(base_files) == 1
    assert live.balances.lookup([]).count() == 0
    with pytest.raises(ValueError):
        live.rejects.lookup(["x"])


def test_a_compaction_lost_halfway_and_another_number_of_buckets(spark, tmp_path):
    live = LiveTables(spark, str(tmp_path / "out"), buckets=4)
    live.balances.append(_change_rows(spark, [(f"A{n}", "1") for n in range(20)]), 0)
    live.balances.compact()
    live.balances.append(_change_rows(spark, [("A1", "1")]), 1)
    # Written by a compaction that never published: older than the next one, and not to be read.
    lost = _change_rows(spark, [("A1", "999")]).withColumn("batch", F.lit(1).cast("bigint"))
    lost.write.parquet(str(tmp_path / "out/current_balances/base/id=1/bucket=0"))
    live.balances.append(_change_rows(spark, [("A2", "1")]), 2)
    live.balances.compact()
    want = {f"A{n}": 2 if n in (1, 2) else 1 for n in range(20)}
    assert {r["account_id"]: int(r["delta_sum"]) for r in live.balances.read().collect()} == want
    wider = LiveTables(spark, str(tmp_path / "out"), buckets=16)
    assert {r["account_id"]: int(r["delta_sum"]) for r in wider.balances.lookup(["A1", "A5"]).collect()} == {"A1": 2, "A5": 1}
    wider.balances.append(_change_rows(spark, [("A3", "1")]), 3)
    wider.balances.compact()
    assert {r["account_id"]: int(r["delta_sum"]) for r in wider.balances.read().collect()} == want | {"A3": 2}
    assert {r["account_id"]: int(r["delta_sum"]) for r in wider.balances.lookup(["A1", "A3"]).collect()} == {"A1": 2, "A3": 2}


def test_an_empty_table_is_compacted(spark, tmp_path):
    live = LiveTables(spark, str(tmp_path / "out"))
    live.balances.append(_change_rows(spark, [("A", "1")]).limit(0), 0)
    live.balances.compact()
    assert live.balances.read().count() == 0
    live.balances.append(_change_rows(spark, [("A", "1")]), 1)
    live.balances.compact()
    assert [r["account_id"] for r in live.balances.read().collect()] == ["A"]


def test_repeats_within_a_time_are_dropped_and_recorded(spark, tmp_path):
    """The same as by default as long as nothing is forgotten, and every dropped delivery is on record."""
    folder = tmp_path / "in"
    folder.mkdir()
    deliver(folder, 1, [event("1", "A", 0, 5), event("2", "A", 1, 7), event("2", "A", 9, 7), event("2", "A", 9, 7), event("8", "A", 0, "n/a")])
    live = LiveTables(spark, str(tmp_path / "out"))
    settings = {"clock": lambda: WRITTEN, "repeats_within": "30 days", "tables": ["current_balances"]}
    live.drain(str(folder), **settings)
    # Another process: a repeat that is newer, an event that is far too late, a new account.
    deliver(folder, 2, [event("1", "A", 20, 5), event("3", "A", 0, 1, transaction_date="2020-01-01"), event("3", "B", 5, 1)])
    LiveTables(spark, str(tmp_path / "out")).drain(str(folder), **settings)
    assert balances(live.current_balances(accounts(spark))) == {"A": ("87.00", "00:20"), "B": ("2.00", "00:05")}
    lost = [(r["record_key"], r["reason"], json.loads(r["record"])["transaction_time"]) for r in live.rejected_events().collect()]
    assert sorted(lost) == [("1", "REPEATED_DELIVERY", "10:00:20"), ("2", "REPEATED_DELIVERY", "10:00:01"), ("2", "REPEATED_DELIVERY", "10:00:09")]
    with pytest.raises(ValueError):
        live.start(str(folder), count_repeats=True, repeats_within="1 day")


def test_the_memory_of_repeats_stays_bounded(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    batches, each = 8, 20
    for n in range(batches):
        deliver(folder, n, [event(f"{n}-{k}", "A", n, 1) for k in range(each)])
    live, times = LiveTables(spark, str(tmp_path / "out")), BatchTimes()
    live.drain(
        str(folder), files_per_batch=1, clock=lambda: WRITTEN, repeats_within="1 millisecond", tables=["current_balances"], listener=times
    )
    assert balances(live.current_balances())["A"][0] == f"-{batches * each}.00"
    deadline = time.time() + 30
    while len(times.seen) < batches and time.time() < deadline:
        time.sleep(0.2)
    kept = [t.state_rows for t in times.seen]
    assert len(kept) >= batches and max(kept) <= 2 * each, kept


def test_latency_classes_equal_a_recount(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    live = LiveTables(spark, str(tmp_path / "out"))
    start = datetime(2026, 3, 20, 10, 0, 0, tzinfo=timezone.utc)
    want: dict = {}
    for n, late in enumerate((299, 600, 5000), start=1):
        seconds = [0, 1, 2, 40, 290]
        deliver(folder, n, [event(f"{n}-{k}", f"A{k}", s) for k, s in enumerate(seconds)])
        live.drain(str(folder), clock=lambda: start + timedelta(seconds=late), tables=["recent_transactions"])
        for s in seconds:
            delay = late - s
            sla = "full" if delay <= 300 else "partial" if delay <= 600 else "none"
            step = next(v for v in [0, *(1 << k for k in range(40))] if delay <= v)
            want[sla, step] = want.get((sla, step), 0) + 1
    def counted():
        return {(r["sla"], r["up_to_seconds"]): r["rows"] for r in live.latency().collect()}

    assert counted() == want
    live.compact()
    assert counted() == want
