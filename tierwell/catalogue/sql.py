"""The same roles and layers in DuckDB SQL, written on their own as the yardstick for the Spark
results.  ``sql(select, *names)`` puts the named steps, and those they need, before a SELECT."""

from __future__ import annotations


def mixed_date(day: str, choice: str) -> str:
    seconds = f"CAST(({day} - DATE '1970-01-01') AS BIGINT) * 86400"
    return f"""CASE ({choice}) % 25
        WHEN 0 THEN strftime({day}, '%d/%m/%Y')
        WHEN 1 THEN CAST({seconds} AS VARCHAR)
        WHEN 2 THEN CAST({seconds} * CASE WHEN {day} >= DATE '2001-09-10' THEN 1000 ELSE 1 END AS VARCHAR)
        WHEN 3 THEN 'not a date'
        ELSE strftime({day}, '%Y-%m-%d') END"""


def parsed_date(raw: str) -> str:
    return f"""CASE
        WHEN regexp_full_match(trim({raw}), '\\d{{4}}-\\d{{2}}-\\d{{2}}')
            THEN CAST(try_strptime(trim({raw}), '%Y-%m-%d') AS DATE)
        WHEN regexp_full_match(trim({raw}), '\\d{{2}}/\\d{{2}}/\\d{{4}}')
            THEN CAST(try_strptime(trim({raw}), '%d/%m/%Y') AS DATE)
        WHEN regexp_full_match(trim({raw}), '[+-]?\\d+')
            THEN DATE '1970-01-01' + CAST(floor(trunc(CAST(trim({raw}) AS DOUBLE)
                / CASE WHEN length(trim({raw})) >= 13 THEN 1000 ELSE 1 END) / 86400) AS INTEGER)
        END"""


def stamp(day: str, time: str) -> str:
    return f"""CASE WHEN regexp_full_match({time}, '\\d{{2}}:\\d{{2}}:\\d{{2}}')
        THEN try_strptime(strftime({day}, '%Y-%m-%d') || ' ' || {time}, '%Y-%m-%d %H:%M:%S') END"""


def surrogate(key: str) -> str:
    return f"CAST(concat('0x', substr(sha256(coalesce({key}, '')), 1, 15)) AS BIGINT)"


def delivered(n: str) -> str:
    return f"CASE WHEN {n} % 2 = 0 THEN TIMESTAMP '2026-01-01 06:00:00' ELSE TIMESTAMP '2026-01-02 06:00:00' END"


def pick(n: str, *values: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"([{listed}])[CAST(({n}) % {len(values)} + 1 AS INTEGER)]"


def shown(*columns: str) -> str:
    """SELECT items; a ``:d``, ``:t`` or ``:n`` ending renders a date, a timestamp or a number."""
    forms = {
        "d": "strftime({0}, '%Y-%m-%d') AS {0}",
        "t": "strftime({0}, '%Y-%m-%d %H:%M:%S') AS {0}",
        "n": "CAST({0} AS DOUBLE) AS {0}",
    }
    out = []
    for c in columns:
        name, _, form = c.partition(":")
        out.append(forms[form].format(name) if form else name)
    return ", ".join(out)


def money(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(18,2)) AS VARCHAR)"


STEPS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw_customers": ((), f"""
        SELECT CASE WHEN c_custkey % 10 = 4 THEN ' CUST-' || c_custkey || '  ' ELSE 'CUST-' || c_custkey END AS customer_id,
            '**********' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS id_number,
            c_name AS first_name, n_name AS last_name,
            {mixed_date("(DATE '1940-01-01' + CAST(c_custkey * 37 % 25000 AS INTEGER))", "c_custkey")} AS dob,
            {pick("c_custkey", "m", "F", "nb", "UNKNOWN")} AS gender,
            r_name AS province,
            {pick("c_custkey", "LOW", "lower_middle", "MIDDLE", "upper_middle", "HIGH")} AS income_band,
            lower(c_mktsegment) AS segment,
            CASE WHEN c_custkey % 29 = 8 THEN 'n/a' ELSE CAST(c_custkey % 10 + 1 AS VARCHAR) END AS risk_score,
            {pick("c_custkey", "verified", "PENDING", "failed")} AS kyc_status,
            {pick("c_custkey", "HL|CC", "SA | CA|INS", "PL", "")} AS product_flags,
            {delivered("c_custkey")} AS ingestion_timestamp
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""),
    "raw_accounts": ((), f"""
        SELECT CASE WHEN o_orderkey % 200 = 3 THEN NULL
                WHEN o_orderkey % 40 = 1 THEN 'ACC-' || (o_orderkey - 1) ELSE 'ACC-' || o_orderkey END AS account_id,
            CASE WHEN o_orderkey % 90 = 11 THEN 'CUST-X' || o_orderkey
                WHEN o_orderkey % 300 = 17 THEN NULL ELSE 'CUST-' || o_custkey END AS customer_ref,
            CASE o_orderstatus WHEN 'F' THEN 'savings' WHEN 'O' THEN 'TRANSACTIONAL' ELSE 'credit' END AS account_type,
            {pick("o_orderkey", "active", "DORMANT", "closed", "SUSPENDED")} AS account_status,
            {mixed_date("CAST(o_orderdate AS DATE)", "o_orderkey")} AS open_date,
            lower(o_orderpriority) AS product_tier,
            CASE WHEN o_orderkey % 7 <> 0 THEN '+27' || o_orderkey END AS mobile_number,
            {pick("o_orderkey", "app", "USSD", "web")} AS digital_channel,
            CASE WHEN o_orderstatus = 'P' THEN {money("o_totalprice")} END AS credit_limit,
            {money("o_totalprice")} AS current_balance,
            CASE WHEN o_orderkey % 19 <> 0 THEN
                {mixed_date("(CAST(o_orderdate AS DATE) + 30)", "o_orderkey + 5")} END AS last_activity_date,
            {delivered("o_orderkey")} AS ingestion_timestamp
        FROM orders"""),
    "raw_transactions": ((), f"""
        SELECT CASE WHEN l_partkey % 400 <> 7 THEN 'TXN-' || l_orderkey || '-' || l_linenumber END AS transaction_id,
            CASE WHEN l_partkey % 97 = 5 THEN 'ACC-X' || l_orderkey
                WHEN l_partkey % 211 = 9 THEN NULL ELSE ' ACC-' || l_orderkey END AS account_id,
            {mixed_date("(CAST(l_shipdate AS DATE) + 9131)", "l_partkey + l_suppkey")} AS transaction_date,
            CASE WHEN l_partkey % 83 = 11 THEN '25:61:00' WHEN l_partkey % 89 = 13 THEN NULL
                ELSE lpad(CAST(l_partkey % 24 AS VARCHAR), 2, '0') || ':' || lpad(CAST(l_suppkey % 60 AS VARCHAR), 2, '0')
                    || ':' || lpad(CAST(CAST(l_quantity AS BIGINT) % 60 AS VARCHAR), 2, '0') END AS transaction_time,
            CASE WHEN l_partkey % 71 = 17 THEN 'transfer' WHEN l_returnflag = 'R' THEN 'Reversal'
                WHEN l_returnflag = 'N' THEN 'DEBIT' WHEN l_linestatus = 'F' THEN 'fee' ELSE 'credit' END AS transaction_type,
            CASE WHEN l_partkey % 11 <> 0 THEN 'cat_' || (l_partkey % 20) END AS merchant_category,
            CASE WHEN l_partkey % 3 <> 0 THEN ' sub ' || (l_suppkey % 7) || ' ' END AS merchant_subcategory,
            CASE WHEN l_partkey % 61 = 19 THEN 'n/a'
                WHEN l_partkey % 67 <> 23 THEN {money("l_extendedprice")} END AS amount,
            (l_partkey % 33 = 3 OR l_partkey % 61 = 19) AS amount_is_text,
            CASE l_partkey % 40 WHEN 0 THEN 'R' WHEN 1 THEN 'rands' WHEN 2 THEN '710' WHEN 3 THEN 'zar'
                WHEN 4 THEN ' ' ELSE 'ZAR' END AS currency,
            CASE WHEN l_partkey % 53 = 29 THEN 'FAX'
                WHEN l_partkey % 59 <> 31 THEN {pick("l_suppkey", "POS", "app", "ATM", "eft", "USSD", "internal")} END AS channel,
            CASE WHEN l_partkey % 13 <> 0 THEN 'Region ' || (l_suppkey % 5) END AS location_province,
            CASE WHEN l_partkey % 5 < 3 THEN CAST(-l_suppkey % 90 AS VARCHAR) || ',' || (l_partkey % 180) || '.25'
                WHEN l_partkey % 5 = 3 THEN 'unknown' END AS coordinates,
            'City ' || (l_suppkey % 50) AS city, CASE WHEN l_partkey % 2 = 0 THEN 'dev-' || l_suppkey END AS device_id,
            l_partkey % 50 = 0 AS retry_flag,
            {delivered("l_suppkey")} AS ingestion_timestamp
        FROM lineitem"""),
    "typed_accounts": (("raw_accounts",), f"""
        SELECT trim(account_id) AS account_id, trim(customer_ref) AS customer_ref,
            upper(trim(account_type)) AS account_type, upper(trim(account_status)) AS account_status,
            {parsed_date("open_date")} AS open_date, upper(trim(product_tier)) AS product_tier,
            trim(mobile_number) AS mobile_number, upper(trim(digital_channel)) AS digital_channel,
            TRY_CAST(credit_limit AS DECIMAL(18,2)) AS credit_limit,
            TRY_CAST(current_balance AS DECIMAL(18,2)) AS current_balance,
            {parsed_date("last_activity_date")} AS last_activity_date, ingestion_timestamp
        FROM raw_accounts"""),
    "newest_accounts": (("typed_accounts",), """
        SELECT * FROM typed_accounts WHERE account_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY ingestion_timestamp DESC,
            customer_ref DESC NULLS LAST, account_type DESC NULLS LAST, account_status DESC NULLS LAST,
            open_date DESC NULLS LAST, product_tier DESC NULLS LAST, mobile_number DESC NULLS LAST,
            digital_channel DESC NULLS LAST, credit_limit DESC NULLS LAST, current_balance DESC NULLS LAST,
            last_activity_date DESC NULLS LAST) = 1"""),
    "silver_accounts": (("newest_accounts",), "SELECT * FROM newest_accounts WHERE customer_ref IS NOT NULL"),
    "silver_customers": (("raw_customers",), f"""
        SELECT trim(customer_id) AS customer_id, trim(id_number) AS id_number, trim(first_name) AS first_name,
            trim(last_name) AS last_name, {parsed_date("dob")} AS dob, upper(trim(gender)) AS gender,
            trim(province) AS province, upper(trim(income_band)) AS income_band, upper(trim(segment)) AS segment,
            TRY_CAST(risk_score AS INTEGER) AS risk_score, upper(trim(kyc_status)) AS kyc_status,
            trim(product_flags) AS product_flags, ingestion_timestamp
        FROM raw_customers"""),
    "typed_transactions": (("raw_transactions",), f"""
        SELECT *, {stamp("transaction_date", "transaction_time")} AS transaction_timestamp FROM (
            SELECT trim(transaction_id) AS transaction_id, trim(account_id) AS account_id,
                trim(transaction_date) AS transaction_date_raw,
                {parsed_date("transaction_date")} AS transaction_date, trim(transaction_time) AS transaction_time,
                upper(trim(transaction_type)) AS transaction_type, upper(trim(merchant_category)) AS merchant_category,
                trim(merchant_subcategory) AS merchant_subcategory, amount AS amount_raw,
                TRY_CAST(amount AS DECIMAL(18,2)) AS amount, trim(currency) AS currency_raw, 'ZAR' AS currency,
                upper(trim(channel)) AS channel, trim(location_province) AS province, amount_is_text,
                ingestion_timestamp
            FROM raw_transactions)"""),
    "decided": (("typed_transactions",), """
        SELECT *, CAST(null_required AS INTEGER) + 2 * CAST(type_mismatch AS INTEGER)
            + 4 * CAST(date_format AS INTEGER) + 8 * CAST(currency_variant AS INTEGER) AS bits
        FROM (SELECT *,
            (coalesce(transaction_id, '') = '' OR coalesce(account_id, '') = '' OR coalesce(transaction_date_raw, '') = ''
                OR coalesce(transaction_time, '') = '' OR coalesce(transaction_type, '') = ''
                OR coalesce(trim(amount_raw), '') = '' OR coalesce(currency_raw, '') = ''
                OR coalesce(channel, '') = '') AS null_required,
            ((amount_raw IS NOT NULL AND amount IS NULL)
                OR (transaction_date IS NOT NULL AND transaction_time IS NOT NULL AND transaction_timestamp IS NULL)
                OR coalesce(transaction_type NOT IN ('DEBIT', 'CREDIT', 'FEE', 'REVERSAL'), false)
                OR coalesce(channel NOT IN ('POS', 'APP', 'ATM', 'EFT', 'USSD', 'INTERNAL'), false)) AS type_mismatch,
            (transaction_date_raw IS NOT NULL AND transaction_date IS NULL) AS date_format,
            coalesce(upper(currency_raw) <> 'ZAR', false) AS currency_variant
            FROM typed_transactions)"""),
    "single": (("decided",), """
        SELECT *, count(*) OVER (PARTITION BY transaction_id) AS dup_count FROM decided WHERE transaction_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_timestamp DESC,
            transaction_timestamp DESC NULLS LAST, account_id DESC NULLS LAST, transaction_date DESC NULLS LAST,
            transaction_time DESC NULLS LAST, transaction_type DESC NULLS LAST, merchant_category DESC NULLS LAST,
            merchant_subcategory DESC NULLS LAST, amount DESC NULLS LAST, channel DESC NULLS LAST,
            province DESC NULLS LAST, bits DESC) = 1
        UNION ALL SELECT *, 1 FROM decided WHERE transaction_id IS NULL"""),
    "single_earliest": (("decided",), """
        SELECT *, count(*) OVER (PARTITION BY transaction_id) AS dup_count FROM decided WHERE transaction_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY ingestion_timestamp ASC,
            transaction_timestamp ASC NULLS LAST, account_id ASC NULLS FIRST, transaction_date ASC NULLS FIRST,
            transaction_time ASC NULLS FIRST, transaction_type ASC NULLS FIRST, merchant_category ASC NULLS FIRST,
            merchant_subcategory ASC NULLS FIRST, amount ASC NULLS FIRST, channel ASC NULLS FIRST,
            province ASC NULLS FIRST, bits ASC) = 1
        UNION ALL SELECT *, 1 FROM decided WHERE transaction_id IS NULL"""),
    "judged": (("single_earliest", "silver_accounts"), """
        SELECT *, CASE WHEN null_required THEN 'NULL_REQUIRED' WHEN orphaned THEN 'ORPHANED_ACCOUNT' END AS dq_exclusion,
            CASE WHEN null_required THEN 'NULL_REQUIRED' WHEN type_mismatch THEN 'TYPE_MISMATCH'
            WHEN date_format THEN 'DATE_FORMAT' WHEN currency_variant THEN 'CURRENCY_VARIANT'
            WHEN orphaned THEN 'ORPHANED_ACCOUNT' WHEN dup_count > 1 THEN 'DUPLICATE_DEDUPED' END AS dq_flag
        FROM (SELECT t.*, a.account_id IS NULL AS orphaned
              FROM single_earliest t LEFT JOIN silver_accounts a ON t.account_id = a.account_id)"""),
    "dim_customers": (("silver_customers",), f"""
        SELECT {surrogate("customer_id")} AS customer_sk, customer_id, gender, province, income_band, segment,
            risk_score, kyc_status,
            CASE WHEN age >= 65 THEN '65+' WHEN age >= 56 THEN '56-65' WHEN age >= 46 THEN '46-55'
                WHEN age >= 36 THEN '36-45' WHEN age >= 26 THEN '26-35' WHEN age >= 18 THEN '18-25' END AS age_band
        FROM (SELECT *, floor((DATE '2026-01-01' - dob) / 365.25) AS age FROM silver_customers)"""),
    "dim_accounts": (("silver_accounts", "dim_customers"), f"""
        SELECT {surrogate("account_id")} AS account_sk, account_id, customer_ref AS customer_id, account_type,
            account_status, open_date, product_tier, digital_channel, credit_limit, current_balance, last_activity_date
        FROM silver_accounts WHERE customer_ref IN (SELECT customer_id FROM dim_customers)"""),
    "fact": (("judged", "dim_accounts", "dim_customers"), f"""
        SELECT {surrogate("transaction_id")} AS transaction_sk, transaction_id, account_sk, customer_sk,
            transaction_date, transaction_timestamp, transaction_type, merchant_category, merchant_subcategory,
            amount, 'ZAR' AS currency, channel, c.province AS province, dq_flag, ingestion_timestamp
        FROM judged t JOIN dim_accounts a ON t.account_id = a.account_id
            JOIN dim_customers c ON a.customer_id = c.customer_id
        WHERE dq_exclusion IS NULL AND transaction_id IS NOT NULL AND transaction_date IS NOT NULL AND transaction_timestamp IS NOT NULL
            AND transaction_type IS NOT NULL AND amount IS NOT NULL AND channel IS NOT NULL"""),
    "stream_raw": ((), f"""
        SELECT 'EV-' || event_id AS transaction_id,
            CASE WHEN event_id % 41 = 6 THEN '' WHEN event_id % 43 <> 7 THEN 'USR-' || user_id END AS account_id,
            {mixed_date("CAST(happened AS DATE)", "event_id")} AS transaction_date, strftime(happened, '%H:%M:%S') AS transaction_time,
            CASE event_type WHEN 'purchase' THEN 'debit' WHEN 'error' THEN 'FEE' WHEN 'signup' THEN 'credit'
                WHEN 'click' THEN 'Reversal' ELSE event_type END AS transaction_type,
            CASE WHEN event_id % 37 = 5 THEN 'n/a' ELSE {money("value")} END AS amount,
            CASE WHEN k % 7 <> 6 THEN {pick("k", "POS", "app", "ATM", "eft", "USSD", "internal")} END AS channel
        FROM (SELECT *, ts + to_seconds(copy) AS happened, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
              FROM (SELECT *, unnest(CASE WHEN event_id % 20 = 0 THEN [0, 1] ELSE [0] END) AS copy FROM events))"""),
    "stream_accounts": ((), """
        SELECT CASE WHEN c_custkey % 50 = 49 THEN 'CLOSED-' ELSE 'USR-' END || c_custkey AS account_id,
            CAST(c_acctbal AS DECIMAL(18,2)) AS current_balance FROM customer"""),
    "stream_events": (("stream_raw",), f"""
        SELECT *, CAST(CASE WHEN transaction_type IN ('DEBIT', 'FEE') THEN -amount
                WHEN transaction_type IN ('CREDIT', 'REVERSAL') THEN amount ELSE 0 END AS DECIMAL(18,2)) AS signed_amount
        FROM (SELECT *, {stamp("day", "transaction_time")} AS transaction_timestamp FROM (
            SELECT trim(account_id) AS account_id, trim(transaction_id) AS transaction_id,
                {parsed_date("transaction_date")} AS day, trim(transaction_time) AS transaction_time,
                TRY_CAST(amount AS DECIMAL(18,2)) AS amount, upper(trim(transaction_type)) AS transaction_type,
                upper(trim(channel)) AS channel FROM stream_raw))
        WHERE coalesce(account_id, '') <> '' AND coalesce(transaction_id, '') <> ''
            AND transaction_timestamp IS NOT NULL AND amount IS NOT NULL AND transaction_type IS NOT NULL"""),
}


def sql(select: str, *needs: str) -> str:
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in ordered:
            before, body = STEPS[name]
            for other in before:
                add(other)
            ordered[name] = body

    for name in needs:
        add(name)
    if not ordered:
        return select
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in ordered.items()) + "\n" + select
