from pyspark.sql import functions as F

from tierwell import fixed_values as fv
from tierwell.operators import checks
from tierwell.operators.dedupe import group_sizes, newest_per_key, one_per_key
from tierwell.operators.linking import keep_known, keep_unknown, mark_known
from tierwell.operators.report import issue_report, summary
from tierwell.operators.rules import RuleSet, load_rules, split_by_action


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_per_key(spark):
    rows = [("a", 1, "x"), ("a", 3, "y"), ("a", None, "z"), ("b", None, "p"), ("b", None, "q"), (None, 1, "n"), (None, 1, "n"), (" ", 2, "m")]
    df = spark.createDataFrame(rows, "k string, t int, v string")
    latest = one_per_key(df, "k", ["t"], count_as="n")
    assert sorted(latest.collect()) == [("a", 3, "y", 3), ("b", None, "q", 2)]
    earliest = one_per_key(df, "k", ["t"], keep="earliest")
    assert sorted(earliest.collect()) == [("a", 1, "x"), ("b", None, "p")]
    kept = one_per_key(df, "k", ["t"], count_as="n", keep_keyless=True)
    lone = [tuple(r) for r in kept.collect() if r["v"] in ("n", "m")]
    assert sorted(lone, key=str) == [(" ", 2, "m", 1), (None, 1, "n", 1), (None, 1, "n", 1)]
    assert sorted(one_per_key(latest, "k", ["t"]).collect()) == sorted(latest.collect())
    assert sorted(group_sizes(df, "k", "n").collect()) == [("a", 3), ("b", 2)]


def test_one_per_key_combines_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    assert "partial_max" in plan(one_per_key(df, "k", ["id"], count_as="n"))


def test_newest_per_key_cuts_before_the_shuffle(spark):
    df = spark.range(0, 400, 1, 4).select((F.col("id") % 1).alias("k"), "id", (F.col("id") % 7).alias("t"))
    for limit in (49, 50, 51, 500):
        got = newest_per_key(df, "k", ["t"], limit, ["id"])
        want = sorted(((i % 7, -i) for i in range(400)), reverse=True)[:limit]
        assert sorted((r["t"], -r["id"]) for r in got.collect()) == sorted(want)
    text = plan(newest_per_key(df, "k", ["t"], 50, ["id"]))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hot_keys_are_split_in_joins(spark):
    """A third of all rows under one key: adaptive execution splits that key's partition."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 60000, 1, 16).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        known = spark.range(0, 60000, 2).select(F.col("id").cast("string").alias("a")).unionAll(
            spark.range(1).select(F.lit("hot"))
        )
        joined = mark_known(facts, "k", known, "a", "m")
        rows = joined.groupBy(F.col("m").isNull().alias("orphan")).count().collect()
        assert {r["orphan"]: r["count"] for r in rows} == {False: 40000, True: 20000}
        joined.collect()  # now the plan is the one that was finally run
        assert "skew=true" in plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_linking(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    right = spark.createDataFrame([("a",)], "x string")
    assert sorted(mark_known(left, "k", right, "x", "m").collect(), key=str) == [("a", "a"), ("b", None), (None, None)]
    assert [r[0] for r in keep_known(left, "k", right, "x").collect()] == ["a"]
    assert {r[0] for r in keep_unknown(left, "k", right, "x").collect()} == {"b", None}


CLEAN = {
    "transaction_id": "1", "account_id": "A", "transaction_date_raw": "2025-01-01", "transaction_date": "2025-01-01",
    "transaction_time": "10:00:00", "transaction_timestamp": "2025-01-01 10:00:00", "transaction_type": "DEBIT",
    "amount_raw": "1", "amount": "1", "currency_raw": "ZAR", "channel": "POS", "_valid_account_id": "A",
    "amount_is_text": False, "_dup_count": 1,
}
KINDS = ", ".join(
    f"{c} {'boolean' if c == 'amount_is_text' else 'int' if c == '_dup_count' else 'string'}" for c in CLEAN
)
BREAK = {
    fv.NULL_REQUIRED: {"channel": None},
    fv.TYPE_MISMATCH: {"amount": None},
    fv.DATE_FORMAT: {"transaction_date": None},
    fv.CURRENCY_VARIANT: {"currency_raw": "R"},
    fv.ORPHANED_ACCOUNT: {"_valid_account_id": None},
    fv.DUPLICATE_DEDUPED: {"_dup_count": 2},
}


def judged(spark, rules, *changes):
    df = spark.createDataFrame([tuple({**CLEAN, **c}.values()) for c in changes], KINDS)
    return [tuple(r) for r in df.select(rules.flag(df.columns), rules.issues(df.columns), rules.exclusion(df.columns)).collect()]


def test_each_rule_alone_and_all_together(spark):
    rules = RuleSet.default()
    assert judged(spark, rules, {}) == [(None, [], None)]
    for code, change in BREAK.items():
        excluded = code if code in (fv.NULL_REQUIRED, fv.ORPHANED_ACCOUNT) else None
        assert judged(spark, rules, change) == [(code, [code], excluded)]
    everything = {k: v for c in BREAK.values() for k, v in c.items()}
    assert judged(spark, rules, everything) == [(fv.NULL_REQUIRED, fv.FLAG_PRIORITY, fv.NULL_REQUIRED)]


def test_type_mismatch_cases(spark):
    rules = RuleSet.default()
    for change in ({"transaction_timestamp": None}, {"transaction_type": "GIFT"}, {"channel": "FAX"}):
        assert judged(spark, rules, change)[0][0] == fv.TYPE_MISMATCH
    assert judged(spark, rules, {"transaction_timestamp": None, "transaction_date": None})[0][1] == [fv.DATE_FORMAT]
    open_domains = rules.changed(TYPE_MISMATCH={"allowed_channels": [], "allowed_transaction_types": []})
    assert judged(spark, open_domains, {"channel": "FAX", "transaction_type": "GIFT"})[0][0] is None


def test_loose_and_strict_rules(spark):
    loose = RuleSet.default()
    strict = loose.changed(
        TYPE_MISMATCH={"strict": True}, DATE_FORMAT={"strict": True}, CURRENCY_VARIANT={"strict": True}
    )
    for change, code in (
        ({"currency_raw": "zar"}, fv.CURRENCY_VARIANT),
        ({"transaction_date_raw": "01/01/2025"}, fv.DATE_FORMAT),
        ({"amount_is_text": True}, fv.TYPE_MISMATCH),
    ):
        assert judged(spark, loose, change)[0][0] is None
        assert judged(spark, strict, change)[0][0] == code


def test_rule_configuration(spark):
    base = fv.DEFAULT_RULES
    both = {**BREAK[fv.DATE_FORMAT], **BREAK[fv.CURRENCY_VARIANT]}
    reordered = RuleSet({**base, "dq_flag_priority": ["NO_SUCH_RULE", fv.CURRENCY_VARIANT]})
    assert judged(spark, reordered, both, BREAK[fv.DATE_FORMAT]) == [
        (fv.CURRENCY_VARIANT, [fv.CURRENCY_VARIANT], None),
        (None, [], None),
    ]
    off = RuleSet(base).changed(DATE_FORMAT={"enabled": False})
    assert judged(spark, off, both)[0][0] == fv.CURRENCY_VARIANT
    for broken in (None, {}, {"rules": "x", "dq_flag_priority": "y"}, {"dq_flag_priority": []}):
        assert RuleSet(broken).priority == fv.FLAG_PRIORITY
    # Without settings the built-in ones apply, and domains are open.
    assert judged(spark, RuleSet({}), {"channel": None}, {"channel": "FAX"})[0][0] == fv.NULL_REQUIRED
    assert judged(spark, RuleSet({}), {"channel": "FAX"})[0][0] is None


def test_rules_on_a_frame_without_the_columns(spark):
    df = spark.createDataFrame([("1",)], "other string")
    assert df.select(RuleSet.default().flag(df.columns)).first()[0] is None


def test_rules_from_a_file(tmp_path):
    import json

    path = tmp_path / "rules.json"
    path.write_text(json.dumps(fv.DEFAULT_RULES))
    assert RuleSet(load_rules(str(path))).priority == fv.FLAG_PRIORITY


def test_split_keeps_every_row_once(spark):
    rows = [(None, None), ("R", "2025-01-01"), ("ZAR", None), ("ZAR", "x")]
    df = spark.createDataFrame(rows, "currency_raw string, transaction_date_raw string").withColumn(
        "transaction_date", F.col("transaction_date_raw").try_cast("date")
    )
    rules = RuleSet.default().changed(NULL_REQUIRED={"enabled": False}, DATE_FORMAT={"handling_action": "QUARANTINED"})
    rules = RuleSet({**rules.config, "dq_flag_priority": [fv.DATE_FORMAT, fv.CURRENCY_VARIANT]})
    kept, out = split_by_action(df, rules)
    assert kept.count() == 3 and [r["reason"] for r in out.collect()] == [fv.DATE_FORMAT]


def test_issue_report(spark):
    counts = spark.createDataFrame(
        [(fv.ORPHANED_ACCOUNT, 5), (fv.TYPE_MISMATCH, 0), (fv.CURRENCY_VARIANT, 1), ("ZZZ", 2), ("NULL_REQUIRED_ACCOUNT", 4)],
        "issue_code string, records long",
    )
    sources = spark.createDataFrame(
        [("transactions_raw", 300), ("accounts_raw", 0), ("customers_raw", 9)], "name string, records long"
    )
    got = [tuple(r)[1:6] for r in issue_report(counts, sources, RuleSet.default()).collect()]
    assert got == [
        ("currency_variants", 1, 0.33, "NORMALISED_CURRENCY", 1),
        ("orphaned_transactions", 5, 1.67, "QUARANTINED", 0),
        ("null_account_id", 4, 0.0, "EXCLUDED_NULL_PK", 0),
        ("zzz", 2, 0.67, "FLAGGED", 2),
    ]
    assert tuple(summary(counts, sources).first()) == (309, 12, 297)
    few = spark.createDataFrame([("transactions_raw", 1)], "name string, records long")
    assert summary(counts, few).first()["clean_records"] == 0


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (2, "z")], "k int, f string")
    assert dict(checks.key_unique(df, "k", "t").collect()) == {"t.k unique": 1, "t.k present": 1}
    target = spark.createDataFrame([("a",), ("b",)], "f string")
    assert checks.references(df, "f", target, "f", "r").first()["violations"] == 2
    assert checks.not_empty(df, "t").first()["violations"] == 0
    assert checks.not_empty(df.filter("false"), "t").first()["violations"] == 1
    measured = spark.createDataFrame([("x", 102.0), ("y", 106.0), ("z", 1.0)], "k string, v double")
    expected = spark.createDataFrame([("x", 100.0), ("y", 100.0), ("w", 1.0)], "k string, v double")
    got = {r["k"]: r["within"] for r in checks.within_tolerance(measured, expected, "k", "v", 0.05).collect()}
    assert got == {"x": True, "y": False, "z": False, "w": False}


def test_numbers_stay_over_runs(spark, tmp_path):
    from tierwell.operators.key_map import KeyMap

    kept = KeyMap(spark, str(tmp_path / "keys"))
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "id string")
    assert kept.read().count() == 0
    assert kept.extend(frame(["m", "z", "m", None, ""]), "id") == 3
    first = {r["key"]: r["number"] for r in kept.read().collect()}
    assert first == {"": 1, "m": 2, "z": 3}
    # A run in between that was lost before its write was committed.
    spark.createDataFrame([("q", 99)], "key string, number long").write.parquet(str(tmp_path / "keys/id=1"))
    (tmp_path / "keys/id=1/_SUCCESS").unlink()
    again = KeyMap(spark, str(tmp_path / "keys"))
    assert again.extend(frame(["a", "m", "n"]), "id") == 2
    assert {r["key"]: r["number"] for r in again.read().collect()} == first | {"a": 4, "n": 5}
    assert again.extend(frame(["a", "z"]), "id") == 0 and again.extend(frame([]), "id") == 0
    rows = again.numbered(spark.createDataFrame([("n", 1), (None, 2), ("new", 3), ("n", 4)], "id string, x int"), "id", "sk").collect()
    assert sorted((r["x"], r["sk"]) for r in rows) == [(1, 5), (2, None), (3, None), (4, 5)]
    assert again.extend(spark.range(5, 7).withColumnRenamed("id", "n"), "n") == 2


def test_sketches_of_runs_unite(spark):
    from tierwell.operators import sketches

    def run(start, stop):
        rows = spark.range(start, stop).selectExpr("cast(id as string) AS id", "if(id % 3 = 0, 'hot', null) AS g")
        return sketches.distinct_sketches(rows, ["g"], "id")

    parts = [run(0, 60_000), run(30_000, 90_000), run(0, 60_000)]
    all_runs = parts[0].unionByName(parts[1]).unionByName(parts[2])
    found = {r["g"]: r["n"] for r in sketches.estimated(sketches.united(all_runs, ["g"]), ["g"], "n").collect()}
    assert set(found) == {"hot", None}
    assert abs(found["hot"] - 30_000) <= 0.05 * 30_000 and abs(found[None] - 60_000) <= 0.05 * 60_000
    # The order and number of unions change nothing.
    once = sketches.united(parts[1].unionByName(parts[0]), ["g"])
    assert {r["g"]: r["n"] for r in sketches.estimated(once, ["g"], "n").collect()} == found
