"""Fixed values.

Everything in this file is data that has to be spelled exactly like this for results to be
right: codes, labels, formats and limits.  No logic lives here.
"""

# --- fixed values: data-quality codes, in priority order -----------------------------------
NULL_REQUIRED = "NULL_REQUIRED"
TYPE_MISMATCH = "TYPE_MISMATCH"
DATE_FORMAT = "DATE_FORMAT"
CURRENCY_VARIANT = "CURRENCY_VARIANT"
ORPHANED_ACCOUNT = "ORPHANED_ACCOUNT"
DUPLICATE_DEDUPED = "DUPLICATE_DEDUPED"
DATE_FORMAT_ACCOUNT = "DATE_FORMAT_ACCOUNT"
DATE_FORMAT_CUSTOMER = "DATE_FORMAT_CUSTOMER"
FLAG_PRIORITY = [
    NULL_REQUIRED,
    TYPE_MISMATCH,
    DATE_FORMAT,
    CURRENCY_VARIANT,
    ORPHANED_ACCOUNT,
    DUPLICATE_DEDUPED,
]

# --- fixed values: code domains -------------------------------------------------------------
TRANSACTION_TYPES = ["DEBIT", "CREDIT", "FEE", "REVERSAL"]
CHANNELS = ["POS", "APP", "ATM", "EFT", "USSD", "INTERNAL"]
OUTGOING_TYPES = ["DEBIT", "FEE"]
INCOMING_TYPES = ["CREDIT", "REVERSAL"]
CURRENCY = "ZAR"
CURRENCY_SPELLINGS = ["ZAR", "R", "RANDS", "710"]

# --- fixed values: date, time and number formats -------------------------------------------
ISO_DATE_REGEX = r"^\d{4}-\d{2}-\d{2}$"
DAY_FIRST_REGEX = r"^\d{2}/\d{2}/\d{4}$"
TIME_REGEX = r"^\d{2}:\d{2}:\d{2}$"
EPOCH_REGEX = r"^[+-]?\d+(\.\d*)?$"
EPOCH_MILLIS_MIN_LENGTH = 13
MONEY = "decimal(18,2)"

# --- fixed values: age bands as (lowest age, label), oldest first --------------------------
AGE_BANDS = [
    (65, "65+"),
    (56, "56-65"),
    (46, "46-55"),
    (36, "36-45"),
    (26, "26-35"),
    (18, "18-25"),
]
DAYS_PER_YEAR = 365.25

# --- fixed values: handling actions that keep a record out of the output -------------------
EXCLUDING_ACTIONS = ["QUARANTINED", "EXCLUDED_NULL_PK", "EXCLUDED_CAST_FAILED"]

# --- fixed values: duplicate handling that keeps the latest delivery; all other keeps the first
KEEP_LATEST_ACTIONS = ["DEDUPLICATED_KEEP_LAST", "DEDUPLICATED_KEEP_LATEST"]

# --- fixed values: columns a fact row must carry -------------------------------------------
FACT_REQUIRED = [
    "transaction_id",
    "transaction_date",
    "transaction_timestamp",
    "transaction_type",
    "amount",
    "channel",
]

# --- fixed values: rule settings used where the caller's rules leave a key out -------------
DEFAULT_NULL_FIELDS = [
    "transaction_id",
    "account_id",
    "transaction_date_raw",
    "transaction_time",
    "transaction_type",
    "amount_raw",
    "currency_raw",
    "channel",
]
DEFAULT_RULES = {
    "dq_flag_priority": FLAG_PRIORITY,
    "rules": {
        NULL_REQUIRED: {
            "enabled": True,
            "issue_type": "null_required",
            "handling_action": "EXCLUDED_NULL_PK",
            "denominator": "transactions_raw",
            "fields": DEFAULT_NULL_FIELDS,
        },
        TYPE_MISMATCH: {
            "enabled": True,
            "issue_type": "type_mismatch",
            "handling_action": "CAST_TO_DECIMAL",
            "denominator": "transactions_raw",
            "amount_raw_field": "amount_raw",
            "amount_cast_field": "amount",
            "timestamp_field": "transaction_timestamp",
            "timestamp_source_fields": ["transaction_date", "transaction_time"],
            "allowed_transaction_types": TRANSACTION_TYPES,
            "allowed_channels": CHANNELS,
        },
        DATE_FORMAT: {
            "enabled": True,
            "issue_type": "date_format_inconsistency",
            "handling_action": "NORMALISED_DATE",
            "denominator": "transactions_raw",
            "source_field": "transaction_date_raw",
            "parsed_field": "transaction_date",
        },
        CURRENCY_VARIANT: {
            "enabled": True,
            "issue_type": "currency_variants",
            "handling_action": "NORMALISED_CURRENCY",
            "denominator": "transactions_raw",
            "source_field": "currency_raw",
            "target_value": CURRENCY,
        },
        ORPHANED_ACCOUNT: {
            "enabled": True,
            "issue_type": "orphaned_transactions",
            "handling_action": "QUARANTINED",
            "denominator": "transactions_raw",
            "reference_present_field": "_valid_account_id",
        },
        DUPLICATE_DEDUPED: {
            "enabled": True,
            "issue_type": "duplicate_transactions",
            "handling_action": "DEDUPLICATED_KEEP_FIRST",
            "denominator": "transactions_raw",
            "duplicate_count_field": "_dup_count",
        },
    },
    "account_null_required": {
        "issue_code": "NULL_REQUIRED_ACCOUNT",
        "issue_type": "null_account_id",
        "handling_action": "EXCLUDED_NULL_PK",
        "denominator": "accounts_raw",
        "key_field": "account_id",
    },
}

# --- fixed values: where a delivered record ended up ----------------------------------------
GOLD = "gold"
QUARANTINE = "quarantine"
REMOVED_COPY = "removed copy"

# --- fixed values: codes of records that never became rows of their layer -------------------
MALFORMED_LINE = "MALFORMED_LINE"
UNKNOWN_CUSTOMER = "UNKNOWN_CUSTOMER"
NO_CUSTOMER_REF = "NO_CUSTOMER_REF"
NULL_REQUIRED_ACCOUNT = "NULL_REQUIRED_ACCOUNT"

# --- fixed values: what a dimension says of members nobody has described yet ----------------
UNKNOWN_MEMBER = "UNKNOWN"

# --- fixed values: streaming limits ---------------------------------------------------------
STREAM_FILE_GLOB = "stream_*.jsonl"
RECENT_LIMIT = 50
SLA_FULL_SECONDS = 300
SLA_PARTIAL_SECONDS = 600
