"""Explicit schemas for every layer.  Reading with them needs no inference pass, and a key that
is absent from a file simply reads as NULL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

_S, _D, _TS, _M = T.StringType(), T.DateType(), T.TimestampType(), T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


def _strings(*names: str) -> T.StructType:
    return _struct(*[(n, _S, True) for n in names])


RAW_CUSTOMERS = _strings(
    "customer_id", "id_number", "first_name", "last_name", "dob", "gender", "province",
    "income_band", "segment", "risk_score", "kyc_status", "product_flags",
)
RAW_ACCOUNTS = _strings(
    "account_id", "customer_ref", "account_type", "account_status", "open_date", "product_tier",
    "mobile_number", "digital_channel", "credit_limit", "current_balance", "last_activity_date",
)
LOCATION = _strings("province", "city", "coordinates")
METADATA = _struct(
    ("device_id", _S, True), ("session_id", _S, True), ("retry_flag", T.BooleanType(), True)
)
CORRUPT = "_corrupt_record"
RAW_TRANSACTIONS = _struct(
    ("transaction_id", _S, True),
    ("account_id", _S, True),
    ("transaction_date", _S, True),
    ("transaction_time", _S, True),
    ("transaction_type", _S, True),
    ("merchant_category", _S, True),
    ("merchant_subcategory", _S, True),
    ("amount", _S, True),
    ("currency", _S, True),
    ("channel", _S, True),
    ("location", LOCATION, True),
    ("metadata", METADATA, True),
    (CORRUPT, _S, True),
)

FACT_TRANSACTIONS = _struct(
    ("transaction_sk", T.LongType(), False),
    ("transaction_id", _S, False),
    ("account_sk", T.LongType(), False),
    ("customer_sk", T.LongType(), False),
    ("transaction_date", _D, False),
    ("transaction_timestamp", _TS, False),
    ("transaction_type", _S, False),
    ("merchant_category", _S, True),
    ("merchant_subcategory", _S, True),
    ("amount", _M, False),
    ("currency", _S, False),
    ("channel", _S, False),
    ("province", _S, True),
    ("dq_flag", _S, True),
    ("ingestion_timestamp", _TS, False),
)
DIM_ACCOUNTS = _struct(
    ("account_sk", T.LongType(), False),
    ("account_id", _S, False),
    ("customer_id", _S, False),
    ("account_type", _S, False),
    ("account_status", _S, False),
    ("open_date", _D, False),
    ("product_tier", _S, False),
    ("digital_channel", _S, False),
    ("credit_limit", _M, True),
    ("current_balance", _M, False),
    ("last_activity_date", _D, True),
)
DIM_CUSTOMERS = _struct(
    ("customer_sk", T.LongType(), False),
    ("customer_id", _S, False),
    ("gender", _S, False),
    ("province", _S, False),
    ("income_band", _S, False),
    ("segment", _S, False),
    ("risk_score", T.IntegerType(), False),
    ("kyc_status", _S, False),
    ("age_band", _S, False),
)
CURRENT_BALANCES = _struct(
    ("account_id", _S, False),
    ("current_balance", _M, False),
    ("last_transaction_timestamp", _TS, False),
    ("updated_at", _TS, False),
)
RECENT_TRANSACTIONS = _struct(
    ("account_id", _S, False),
    ("transaction_id", _S, False),
    ("transaction_timestamp", _TS, False),
    ("amount", _M, False),
    ("transaction_type", _S, False),
    ("channel", _S, True),
    ("updated_at", _TS, False),
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project ``df`` to the columns, order and types of ``schema``."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def differences(df: DataFrame, schema: T.StructType) -> list[str]:
    """What stops ``df`` from having ``schema``: names, order and types.  Metadata only, no job.

    NULLs in columns declared as required are data, not metadata; ``checks.required_nulls``
    counts them."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    found = []
    if len(have) != len(want):
        found.append(f"{len(have)} columns instead of {len(want)}")
    for pos, (h, w) in enumerate(zip(have, want), start=1):
        if h != w:
            found.append(f"column {pos}: {h[0]} {h[1]} instead of {w[0]} {w[1]}")
    return found
