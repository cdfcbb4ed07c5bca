from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tierwell.functions import keys, money, temporal, text


def one(spark, value, build, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(build(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize(
    "raw, want",
    [
        ("2025-03-22", date(2025, 3, 22)),
        (" 22/03/2025 ", date(2025, 3, 22)),
        ("1711065600", date(2024, 3, 22)),
        ("1711065600000", date(2024, 3, 22)),
        ("1711151999", date(2024, 3, 22)),
        ("-86400", date(1969, 12, 31)),
        ("-1", date(1969, 12, 31)),
        ("0", date(1970, 1, 1)),
        ("31/02/2025", None),
        ("2025-02-30", None),
        ("1/3/2025", None),
        ("2025-3-2", None),
        ("1e9", None),
        ("99999999999999999999999999", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, raw, want):
    assert one(spark, raw, temporal.parse_date) == want


def test_parse_date_does_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert one(spark, "1711065600", temporal.parse_date) == date(2024, 3, 22)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "day, time, want",
    [
        (date(2025, 3, 22), "14:37:05", datetime(2025, 3, 22, 14, 37, 5)),
        (date(2025, 3, 22), "25:00:00", None),
        (date(2025, 3, 22), "1:2:3", None),
        (date(2025, 3, 22), None, None),
        (None, "14:37:05", None),
    ],
)
def test_compose_timestamp(spark, day, time, want):
    df = spark.createDataFrame([(day, time)], "d date, t string")
    shown = df.select(temporal.compose_timestamp("d", "t").cast("string")).first()[0]
    assert shown == (want and want.strftime("%Y-%m-%d %H:%M:%S"))


@pytest.mark.parametrize(
    "raw, want", [("349.5", "349.50"), ("2.675", "2.68"), ("-2.675", "-2.68"), ("n/a", None), ("", None), (None, None)]
)
def test_money(spark, raw, want):
    assert one(spark, raw, money.money) == (want and Decimal(want))


@pytest.mark.parametrize(
    "kind, want", [("DEBIT", "-5.00"), ("FEE", "-5.00"), ("CREDIT", "5.00"), ("REVERSAL", "5.00"), ("OTHER", "0.00")]
)
def test_signed(spark, kind, want):
    assert one(spark, kind, lambda c: money.signed(F.lit("5").cast("decimal(18,2)"), c)) == Decimal(want)


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (0, 5)], "n long, d long")
    assert [r[0] for r in df.select(money.percent_of("n", "d")).collect()] == [33.33, 0.0, 0.0]


@pytest.mark.parametrize(
    "line, want",
    [('{"amount":1.5}', False), ('{"amount":"1.5"}', True), ('{"amount":null}', False), ("{}", False), ("{bad", False), (None, False)],
)
def test_amount_is_text(spark, line, want):
    assert one(spark, line, money.amount_is_text) is want


def test_hashed_key(spark):
    assert one(spark, "abc", keys.hashed_key) == 839782156265856254
    assert one(spark, None, keys.hashed_key) == one(spark, "", keys.hashed_key)


def test_sequential_key_has_no_gaps(spark):
    ids = spark.range(0, 5000, 1, 7).select(F.sha2(F.col("id").cast("string"), 256).alias("id"))
    rows = keys.sequential_key(ids, "id", "sk").collect()
    assert [r["sk"] for r in sorted(rows, key=lambda r: r["id"])] == list(range(1, 5001))


@pytest.mark.parametrize(
    "age, want",
    [(17, None), (18, "18-25"), (25, "18-25"), (26, "26-35"), (36, "36-45"), (46, "46-55"), (56, "56-65"), (64, "56-65"), (65, "65+")],
)
def test_age_band(spark, age, want):
    as_of = date(2026, 1, 1)
    birth = date.fromordinal(as_of.toordinal() - int(age * 365.25) - 1)
    assert one(spark, birth, lambda c: temporal.age_band(c, as_of), "date") == want


def test_sla_classes(spark):
    rows = spark.createDataFrame([(s,) for s in (0, 300, 301, 600, 601)], "s int")
    at = F.lit("2026-01-01 00:00:00").cast("timestamp")
    later = F.timestamp_add("SECOND", F.col("s"), at)
    got = [r[0] for r in rows.select(temporal.sla_class(at, later)).collect()]
    assert got == ["full", "full", "partial", "partial", "none"]


def test_text_functions(spark):
    assert one(spark, " debit ", text.code) == "DEBIT"
    assert [one(spark, v, text.missing) for v in (None, "", "  ", "x")] == [True, True, True, False]
    assert one(spark, "x", lambda c: text.any_of([])) is False
    assert one(spark, "x", lambda c: text.outside(c, [])) is False
    assert [one(spark, v, lambda c: text.outside(c, ["a"])) for v in ("A", "B", None)] == [False, True, False]
    assert one(spark, "HL| CC", text.flags) == ["HL", "CC"]
    assert one(spark, None, text.flags) == []
    assert [one(spark, v, lambda c: text.currency(c, strict=True)) for v in ("rands", "710", "EUR")] == ["ZAR", "ZAR", None]
    assert one(spark, "-26.2,28", text.latitude_longitude) == (-26.2, 28.0)
    assert one(spark, "x", text.latitude_longitude) == (None, None)
