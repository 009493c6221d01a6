"""Field grammar of the raw transaction log line."""
from __future__ import annotations

# Log-line fields as (output column, Java regex with one group, type).
# ``transaction_hour`` accepts both spellings seen in the data
# (``TransactionHour=`` and ``transaction_hour=``); ``Status`` tolerates the
# ``Statuss`` typo; amounts may use a decimal comma.
LOG_FIELDS = (
    ("transaction_id", r"(TX-\d{4}-\d+)", "string"),
    ("transaction_hour", r"(?i)transaction_?hour=(\d+)", "int"),
    ("user_id", r"User=(\d+)", "string"),
    ("amount", r"Amount=([\d,\.]+)", "decimal_comma"),
    ("currency", r"Amount=[\d,\.]+\s+([A-Z]{3})", "string"),
    ("merchant_category", r"MerchantCategory=(\w+)", "string"),
    ("method", r"Method=(\w+)", "string"),
    ("status", r"Status[s]?=(\w+)", "string"),
    ("is_foreign_transaction", r"ForeignTransaction=(\d)", "flag"),
    ("location_mismatch", r"LocationMismatch=(\d)", "flag"),
    ("device_trust_score", r"DeviceTrustScore=(\d+)", "int"),
    ("velocity_last_24h", r"VelocityLast24h=([\d\.]+)", "double"),
    ("cardholder_age", r"CardholderAge=(\d+)", "int"),
    ("is_fraud", r"IsFraud=(true|false)", "truefalse"),
    ("ip", r"IP=([\d\.]+)", "string"),
    ("failed_attempts", r"FailedAttempts=(\d+)", "int"),
)

# Values of fields that a line may leave out.
LOG_DEFAULTS = {"failed_attempts": 0}

# Fields without which a line counts as unparsed.
MANDATORY_FIELDS = ("transaction_id", "amount")
