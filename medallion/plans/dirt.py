"""Key-rule dirt for the driver tables.

The driver tables are clean, so the dirty text columns that the cleaning
operators exist for are derived from each row's key by fixed rules.  Every rule
is a SQL snippet that Spark (``F.expr``) and the DuckDB oracle evaluate the
same way; the operators under test are written separately on each side.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dirt rules over ``events`` (event_id, ts, user_id, event_type, value).
EVENT_DIRT = {
    "tx_id": "CASE WHEN event_id % 3 = 0 THEN 'TX-2024-4' ELSE 'TX-2024-0' END "
             "|| printf('%07d', event_id)",
    "raw_id": "CASE event_id % 31 WHEN 0 THEN NULL "
              "WHEN 1 THEN CAST(event_id AS STRING) || '.5' ELSE CAST(event_id AS STRING) END",
    "raw_value": "CASE event_id % 17 WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN 'NAN' "
                 "WHEN 4 THEN 'nan' WHEN 5 THEN '12f' "
                 "WHEN 6 THEN ' ' || CAST(value AS STRING) || ' ' WHEN 7 THEN NULL "
                 "WHEN 8 THEN 'inf' WHEN 9 THEN CAST(value * 40 AS STRING) "
                 "ELSE CAST(value AS STRING) END",
    "raw_hour": "CASE event_id % 23 WHEN 0 THEN NULL WHEN 1 THEN '24' WHEN 2 THEN '578.74' "
                "WHEN 3 THEN '-1' WHEN 4 THEN '100.66' WHEN 5 THEN '7.0' "
                "ELSE CAST(hour(ts) AS STRING) END",
    "raw_flag": "CASE event_id % 11 WHEN 0 THEN '0' WHEN 1 THEN '1' WHEN 2 THEN '2' WHEN 3 THEN '' "
                "WHEN 4 THEN 'true' WHEN 5 THEN '1.0' WHEN 6 THEN '0.0' WHEN 7 THEN 'yes' "
                "WHEN 8 THEN ' No ' WHEN 9 THEN 'false' ELSE NULL END",
    "raw_cat": "CASE event_id % 13 WHEN 0 THEN upper(event_type) WHEN 1 THEN 'NAN' "
               "WHEN 2 THEN NULL WHEN 3 THEN '  ' || event_type WHEN 4 THEN 'nan' "
               "WHEN 5 THEN '' ELSE event_type END",
    "raw_ts": "CASE event_id % 19 WHEN 0 THEN 'not a time' WHEN 1 THEN '2024-13-45 00:00:00' "
              "WHEN 2 THEN '' ELSE CAST(ts AS STRING) END",
    "raw_sparse": "CASE WHEN event_id % 50 = 0 THEN '1' END",
}

# The bronze transaction CSV rendered from ``events`` (all text).
EVENT_CSV = {
    "transaction_id": "CASE event_id % 31 WHEN 0 THEN NULL "
                      "WHEN 1 THEN CAST(event_id AS STRING) || '.5' ELSE CAST(event_id AS STRING) END",
    "amount": "CASE event_id % 17 WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN 'NAN' "
              "WHEN 7 THEN NULL WHEN 9 THEN CAST(value * 40 AS STRING) "
              "ELSE CAST(value AS STRING) END",
    "transaction_hour": "CASE event_id % 23 WHEN 0 THEN NULL WHEN 1 THEN '24' WHEN 2 THEN '578.74' "
                        "WHEN 4 THEN '100.66' ELSE CAST(hour(ts) AS STRING) END",
    "merchant_category": "CASE event_id % 13 WHEN 0 THEN upper(event_type) WHEN 1 THEN 'NAN' "
                         "WHEN 2 THEN NULL ELSE event_type END",
    "foreign_transaction": "CASE event_id % 11 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN NULL "
                           "WHEN 3 THEN '1' ELSE '0' END",
    "location_mismatch": "CASE event_id % 7 WHEN 0 THEN '1' WHEN 1 THEN NULL WHEN 2 THEN '5' ELSE '0' END",
    "device_trust_score": "CASE WHEN event_id % 29 = 0 THEN NULL "
                          "ELSE CAST(user_id % 101 AS STRING) END",
    "velocity_last_24h": "CASE WHEN event_id % 37 = 0 THEN NULL WHEN event_id % 41 = 0 THEN '250' "
                         "ELSE CAST(event_id % 12 AS STRING) || '.' || CAST(event_id % 10 AS STRING) END",
    "cardholder_age": "CASE WHEN event_id % 97 = 0 THEN '2168.55' WHEN event_id % 43 = 0 THEN NULL "
                      "ELSE CAST(18 + user_id % 60 AS STRING) END",
    "is_fraud": "CASE WHEN event_id % 53 = 0 THEN '2' WHEN event_id % 59 = 0 THEN NULL "
                "WHEN event_type = 'error' AND event_id % 4 = 0 THEN '1' ELSE '0' END",
}

# Events rendered as raw transaction log lines.  Both hour
# spellings, decimal commas, the ``Statuss`` typo and missing IPs occur.
EVENT_LOG_LINE = (
    "concat_ws(' ', "
    "CASE WHEN event_id % 2 = 0 THEN 'transaction_hour=' ELSE 'TransactionHour=' END || CAST(hour(ts) AS STRING), "
    "CASE WHEN event_id % 3 = 0 THEN 'TX-2024-4' ELSE 'TX-2024-0' END || printf('%07d', event_id), "
    "'User=' || CAST(user_id AS STRING), "
    "'Amount=' || CASE WHEN event_id % 4 = 1 THEN replace(CAST(value AS STRING), '.', ',') "
    "ELSE CAST(value AS STRING) END || ' ARS', "
    "'MerchantCategory=' || event_type, "
    "'Method=' || CASE WHEN user_id % 2 = 0 THEN 'Card' ELSE 'Transfer' END, "
    "CASE WHEN event_id % 7 = 3 THEN 'Statuss=' ELSE 'Status=' END || "
    "CASE event_id % 3 WHEN 0 THEN 'APPROVED' WHEN 1 THEN 'DECLINED' ELSE 'FLAGGED' END, "
    "'ForeignTransaction=' || CASE WHEN event_id % 4 = 0 THEN '1' ELSE '0' END, "
    "'LocationMismatch=' || CASE WHEN event_id % 5 = 0 THEN '1' ELSE '0' END, "
    "'DeviceTrustScore=' || CAST(user_id % 101 AS STRING), "
    "'VelocityLast24h=' || CAST(event_id % 12 AS STRING) || '.' || CAST(event_id % 10 AS STRING), "
    "'CardholderAge=' || CAST(18 + user_id % 60 AS STRING), "
    "'IsFraud=' || CASE WHEN event_type = 'error' THEN 'true' ELSE 'false' END, "
    "CASE WHEN event_id % 3 <> 0 THEN 'IP=10.' || CAST(user_id % 256 AS STRING) || '.' "
    "|| CAST(event_id % 256 AS STRING) || '.1' END, "
    "CASE WHEN event_id % 5 = 2 THEN 'FailedAttempts=' || CAST(event_id % 4 AS STRING) END)"
)
# Fixed value: log lines without an id or an amount (unparsable) by key rule.
EVENT_LOG_BROKEN = "event_id % 101 = 7"

# The id prefixes that count as fraud, quoted in one line of a note.
FRAUD_PREFIXES = ("TX-2024-4", "TX-2024-00000")
SUPERVISOR_NOTE = 'ids starting with "TX-2024-4..." or "TX-2024-00000..." are fraud'


def with_dirt(df: DataFrame, rules: dict[str, str], keep=("event_id",)) -> DataFrame:
    return df.select(*keep, *[F.expr(sql).alias(name) for name, sql in rules.items()])


def sql_select(rules: dict[str, str], keep=("event_id",)) -> str:
    return ", ".join([*keep, *[f"{sql} AS {name}" for name, sql in rules.items()]])


# Fixed value: document lines cut short (unreadable JSON) by key rule.
EVENT_JSON_TRUNCATED = "event_id % 997 = 0"

# Leaves of the nested transaction JSON rendered from ``events``
# (all text except the fraud label and schema_version).  ``cardholder`` is a
# null struct when ``event_id % 31 = 0``; the timestamp is rendered per dialect.
EVENT_JSON_NULL_CARDHOLDER = "event_id % 31 = 0"
EVENT_JSON = {
    "transaction_id": "CASE WHEN event_id % 29 = 0 THEN NULL ELSE "
                      "CASE WHEN event_id % 10 = 7 THEN 'TX-2023-0' WHEN event_id % 3 = 0 THEN 'TX-2024-4' ELSE 'TX-2024-0' END "
                      "|| printf('%07d', event_id) END",
    "transaction_hour": "CASE event_id % 23 WHEN 1 THEN '24' WHEN 2 THEN '-1' "
                        "ELSE CAST(hour(ts) AS STRING) END",
    "amount": "CASE event_id % 17 WHEN 1 THEN 'abc' WHEN 2 THEN NULL WHEN 3 THEN '' "
              "ELSE CAST(value AS STRING) END",
    "merchant_category": "CASE WHEN event_id % 13 = 0 THEN NULL ELSE event_type END",
    "age": "CASE WHEN event_id % 41 = 0 THEN '2168.55' ELSE CAST(18 + user_id % 60 AS STRING) END",
    "country": "CASE WHEN event_id % 4 = 0 THEN 'US' ELSE 'AR' END",
    "device_type": "CASE WHEN user_id % 3 = 0 THEN 'mobile' ELSE 'desktop' END",
    "operating_system": "CASE WHEN user_id % 2 = 0 THEN 'android' ELSE 'ios' END",
    "device_trust_score": "CASE WHEN event_id % 37 = 0 THEN 'n/a' ELSE CAST(user_id % 101 AS STRING) END",
    "velocity_last_24h": "CAST(event_id % 12 AS STRING) || '.5'",
    "ip_risk_score": "'0.' || lpad(CAST(event_id % 100 AS STRING), 2, '0')",
    "city": "'C' || CAST(user_id % 10 AS STRING)",
    "is_foreign_transaction": "CASE event_id % 5 WHEN 0 THEN 'true' WHEN 1 THEN '1.0' WHEN 2 THEN 'no' "
                              "ELSE 'false' END",
    "location_mismatch": "CASE event_id % 7 WHEN 0 THEN '1' WHEN 1 THEN NULL WHEN 2 THEN 'yes' ELSE '0' END",
    "method": "CASE event_id % 3 WHEN 0 THEN 'pin' WHEN 1 THEN 'biometric' ELSE '2fa' END",
    "failed_attempts": "CAST(event_id % 4 AS STRING)",
    "is_fraud": "event_type = 'error'",
    "schema_version": "CASE WHEN event_id % 50 = 0 THEN 2.0 END",
}
