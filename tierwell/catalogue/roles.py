"""The given tables in the roles the operators expect.

customers are ``customer`` with nation and region, accounts are ``orders``, transactions are
``lineitem`` (whose order-and-line keys repeat by nature), stream events are ``events``.  The given
tables are clean, so CASE expressions write some of their values the way dirty sources do: mixed
date formats, text for numbers, currency spellings, unknown accounts, missing keys.  No row is
left out."""

from __future__ import annotations

from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierwell.functions.keys import hashed_key
from tierwell.operators.rules import RuleSet
from tierwell.plans import gold, silver
from tierwell.sources.readers import read_table
from tierwell.streaming.events import valid_events
from tierwell.tuning import tune

AS_OF = date(2026, 1, 1)
HALFWAY = "2024-01-16 00:00:00"
FIRST_WRITE = datetime(2024, 2, 1)
SECOND_WRITE = datetime(2024, 2, 2)


def mixed_date(day: Column, choice: Column) -> Column:
    """A date written in one of the formats sources use, or as something that is none.

    Milliseconds only from September 2001 on, when they have the 13 digits that tell them apart."""
    seconds = F.unix_date(day).cast("bigint") * 86400
    scale = F.when(day >= F.lit("2001-09-10").cast("date"), 1000).otherwise(1)
    return (
        F.when(choice % 25 == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(choice % 25 == 1, seconds.cast("string"))
        .when(choice % 25 == 2, (seconds * scale).cast("string"))
        .when(choice % 25 == 3, F.lit("not a date"))
        .otherwise(day.cast("string"))
    )


def _two(n: Column) -> Column:
    return F.lpad(n.cast("bigint").cast("string"), 2, "0")


def _money_text(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)").cast("string")


def _delivered(n: Column) -> Column:
    """Two ingestion runs, a day apart."""
    return F.when(n % 2 == 0, F.lit("2026-01-01 06:00:00")).otherwise(F.lit("2026-01-02 06:00:00")).cast("timestamp")


def _pick(n: Column, *values: str) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (n % len(values) + 1).cast("int"))


class Roles:
    as_of = AS_OF

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = tune(spark), folder

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.folder}/{name}.parquet")

    # -- bronze ------------------------------------------------------------------------------

    @cached_property
    def customers(self) -> DataFrame:
        k = F.col("c_custkey")
        places = self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        joined = self.table("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
        own = F.concat(F.lit("CUST-"), k.cast("string"))
        birth = F.date_add(F.lit("1940-01-01").cast("date"), (k * 37 % 25000).cast("int"))
        return joined.select(
            F.when(k % 10 == 4, F.concat(F.lit(" "), own, F.lit("  "))).otherwise(own).alias("customer_id"),
            F.concat(F.lit("**********"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("id_number"),
            F.col("c_name").alias("first_name"),
            F.col("n_name").alias("last_name"),
            mixed_date(birth, k).alias("dob"),
            _pick(k, "m", "F", "nb", "UNKNOWN").alias("gender"),
            F.col("r_name").alias("province"),
            _pick(k, "LOW", "lower_middle", "MIDDLE", "upper_middle", "HIGH").alias("income_band"),
            F.lower("c_mktsegment").alias("segment"),
            F.when(k % 29 == 8, "n/a").otherwise((k % 10 + 1).cast("string")).alias("risk_score"),
            _pick(k, "verified", "PENDING", "failed").alias("kyc_status"),
            _pick(k, "HL|CC", "SA | CA|INS", "PL", "").alias("product_flags"),
            _delivered(k).alias("ingestion_timestamp"),
        )

    @cached_property
    def accounts(self) -> DataFrame:
        k = F.col("o_orderkey")
        opened = F.col("o_orderdate").cast("date")
        return self.table("orders").select(
            F.when(k % 200 == 3, None)
            .when(k % 40 == 1, F.concat(F.lit("ACC-"), (k - 1).cast("string")))
            .otherwise(F.concat(F.lit("ACC-"), k.cast("string")))
            .alias("account_id"),
            F.when(k % 90 == 11, F.concat(F.lit("CUST-X"), k.cast("string")))
            .when(k % 300 == 17, None)
            .otherwise(F.concat(F.lit("CUST-"), F.col("o_custkey").cast("string")))
            .alias("customer_ref"),
            F.when(F.col("o_orderstatus") == "F", "savings")
            .when(F.col("o_orderstatus") == "O", "TRANSACTIONAL")
            .otherwise("credit")
            .alias("account_type"),
            _pick(k, "active", "DORMANT", "closed", "SUSPENDED").alias("account_status"),
            mixed_date(opened, k).alias("open_date"),
            F.lower("o_orderpriority").alias("product_tier"),
            F.when(k % 7 != 0, F.concat(F.lit("+27"), k.cast("string"))).alias("mobile_number"),
            _pick(k, "app", "USSD", "web").alias("digital_channel"),
            F.when(F.col("o_orderstatus") == "P", _money_text("o_totalprice")).alias("credit_limit"),
            _money_text("o_totalprice").alias("current_balance"),
            F.when(k % 19 != 0, mixed_date(F.date_add(opened, 30), k + 5)).alias("last_activity_date"),
            _delivered(k).alias("ingestion_timestamp"),
        )

    @cached_property
    def transactions(self) -> DataFrame:
        p, s, o = F.col("l_partkey"), F.col("l_suppkey"), F.col("l_orderkey").cast("string")
        day = F.date_add(F.col("l_shipdate").cast("date"), 9131)  # 25 years on
        return self.table("lineitem").select(
            F.when(p % 400 != 7, F.concat_ws("-", F.lit("TXN"), o, F.col("l_linenumber").cast("string"))).alias(
                "transaction_id"
            ),
            F.when(p % 97 == 5, F.concat(F.lit("ACC-X"), o))
            .when(p % 211 == 9, None)
            .otherwise(F.concat(F.lit(" ACC-"), o))
            .alias("account_id"),
            mixed_date(day, p + s).alias("transaction_date"),
            F.when(p % 83 == 11, "25:61:00")
            .when(p % 89 == 13, None)
            .otherwise(F.concat_ws(":", _two(p % 24), _two(s % 60), _two(F.col("l_quantity") % 60)))
            .alias("transaction_time"),
            F.when(p % 71 == 17, "transfer")
            .when(F.col("l_returnflag") == "R", "Reversal")
            .when(F.col("l_returnflag") == "N", "DEBIT")
            .when(F.col("l_linestatus") == "F", "fee")
            .otherwise("credit")
            .alias("transaction_type"),
            F.when(p % 11 != 0, F.concat(F.lit("cat_"), (p % 20).cast("string"))).alias("merchant_category"),
            F.when(p % 3 != 0, F.concat(F.lit(" sub "), (s % 7).cast("string"), F.lit(" "))).alias(
                "merchant_subcategory"
            ),
            F.when(p % 61 == 19, "n/a").when(p % 67 != 23, _money_text("l_extendedprice")).alias("amount"),
            ((p % 33 == 3) | (p % 61 == 19)).alias("amount_is_text"),
            F.when(p % 40 < 5, _pick(p % 40, "R", "rands", "710", "zar", " ")).otherwise("ZAR").alias("currency"),
            F.when(p % 53 == 29, "FAX")
            .when(p % 59 != 31, _pick(s, "POS", "app", "ATM", "eft", "USSD", "internal"))
            .alias("channel"),
            F.struct(
                F.when(p % 13 != 0, F.concat(F.lit("Region "), (s % 5).cast("string"))).alias("province"),
                F.concat(F.lit("City "), (s % 50).cast("string")).alias("city"),
                F.when(
                    p % 5 < 3,
                    F.concat_ws(",", (-s % 90).cast("string"), F.concat((p % 180).cast("string"), F.lit(".25"))),
                ).when(p % 5 == 3, "unknown").alias("coordinates"),
            ).alias("location"),
            F.struct(
                F.when(p % 2 == 0, F.concat(F.lit("dev-"), s.cast("string"))).alias("device_id"),
                F.lit(None).cast("string").alias("session_id"),
                (p % 50 == 0).alias("retry_flag"),
            ).alias("metadata"),
            _delivered(s).alias("ingestion_timestamp"),
        )

    # -- silver and gold ---------------------------------------------------------------------

    @cached_property
    def silver_accounts(self) -> DataFrame:
        return silver.silver_accounts(self.accounts)

    @cached_property
    def silver_customers(self) -> DataFrame:
        return silver.silver_customers(self.customers)

    @property
    def owned_accounts(self) -> DataFrame:
        """Silver accounts with no more than joins by account need."""
        return silver.silver_accounts(self.accounts, gold.OWNED_ACCOUNT)

    @property
    def owning_customers(self) -> DataFrame:
        """The customer dimension, likewise."""
        known = silver.silver_customers(self.customers, gold.OWNING_CUSTOMER)
        return known.select("customer_id", "province", hashed_key("customer_id").alias("customer_sk"))

    def judged(self, rules: RuleSet | None = None, keep: str | None = None) -> DataFrame:
        return silver.judged_transactions(self.transactions, self.owned_accounts, rules, keep)

    @cached_property
    def silver_transactions(self) -> DataFrame:
        return self.judged().select(*silver.SILVER_TRANSACTIONS)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self.silver_customers, AS_OF)

    @cached_property
    def dim_accounts(self) -> DataFrame:
        return gold.dim_accounts(self.silver_accounts, self.dim_customers)

    def owned(self, rules: RuleSet | None = None) -> DataFrame:
        return gold.owned_transactions(self.transactions, self.owned_accounts, self.owning_customers, rules)

    @cached_property
    def fact(self) -> DataFrame:
        return gold.fact_from_bronze(self.transactions, self.owned_accounts, self.owning_customers)

    # -- stream ------------------------------------------------------------------------------

    @cached_property
    def stream_raw(self) -> DataFrame:
        """Events in the shape of the stream files.  Every twentieth is delivered twice, the copy
        a second later."""
        n = F.col("event_id")
        copies = F.when(n % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        when = F.expr("timestampadd(SECOND, copy, ts)")
        k = F.get_json_object("props", "$.k").cast("int")
        return self.table("events").withColumn("copy", F.explode(copies)).select(
            F.concat(F.lit("EV-"), n.cast("string")).alias("transaction_id"),
            F.when(n % 41 == 6, "")
            .when(n % 43 != 7, F.concat(F.lit("USR-"), F.col("user_id").cast("string")))
            .alias("account_id"),
            mixed_date(when.cast("date"), n).alias("transaction_date"),
            F.date_format(when, "HH:mm:ss").alias("transaction_time"),
            F.when(F.col("event_type") == "purchase", "debit")
            .when(F.col("event_type") == "error", "FEE")
            .when(F.col("event_type") == "signup", "credit")
            .when(F.col("event_type") == "click", "Reversal")
            .otherwise(F.col("event_type"))
            .alias("transaction_type"),
            F.when(n % 37 == 5, "n/a").otherwise(_money_text("value")).alias("amount"),
            F.when(k % 7 != 6, _pick(k, "POS", "app", "ATM", "eft", "USSD", "internal")).alias("channel"),
        )

    @cached_property
    def stream_accounts(self) -> DataFrame:
        """Starting balances; every fiftieth customer has none under the account's name."""
        k = F.col("c_custkey")
        return self.table("customer").select(
            F.concat(F.when(k % 50 == 49, "CLOSED-").otherwise("USR-"), k.cast("string")).alias("account_id"),
            F.col("c_acctbal").cast("decimal(18,2)").alias("current_balance"),
        )

    @cached_property
    def events(self) -> DataFrame:
        return valid_events(self.stream_raw)

    @property
    def earlier_events(self) -> DataFrame:
        return self.events.filter(F.col("transaction_timestamp") < F.lit(HALFWAY).cast("timestamp"))

    @property
    def later_events(self) -> DataFrame:
        return self.events.filter(F.col("transaction_timestamp") >= F.lit(HALFWAY).cast("timestamp"))
