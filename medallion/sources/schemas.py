"""Declared schemas of the bronze sources and the gold table (no inference)."""
from pyspark.sql import types as T

S, D, I, L, B = T.StringType(), T.DoubleType(), T.IntegerType(), T.LongType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# The 10 raw CSV columns, all read as text, plus the corrupt-row column.
CSV_COLUMNS = ("transaction_id", "amount", "transaction_hour", "merchant_category",
               "foreign_transaction", "location_mismatch", "device_trust_score",
               "velocity_last_24h", "cardholder_age", "is_fraud")
CSV_SCHEMA = _struct(*[(c, S) for c in CSV_COLUMNS], ("_corrupt_record", S))

# Nested transaction JSON; mixed number/text leaves are text.
JSON_SCHEMA = _struct(
    ("transaction_id", S), ("timestamp", S), ("transaction_hour", S), ("amount", S),
    ("merchant_category", S),
    ("cardholder", _struct(("age", S), ("country", S))),
    ("device", _struct(("device_type", S), ("operating_system", S), ("device_trust_score", S))),
    ("network_features", _struct(("velocity_last_24h", S), ("ip_risk_score", S))),
    ("location", _struct(("city", S), ("country", S), ("is_foreign_transaction", S),
                         ("location_mismatch", S))),
    ("authentication", _struct(("method", S), ("failed_attempts", S))),
    ("labels", _struct(("is_fraud", B))),
    ("schema_version", D),
    ("_corrupt_record", S),
)

# Flattening of the JSON transaction: output -> (path, coercion).
JSON_FLATTEN = {
    "transaction_id": ("transaction_id", "string"),
    "timestamp": ("timestamp", "string"),
    "amount": ("amount", "double"),
    "transaction_hour": ("transaction_hour", "int"),
    "merchant_category": ("merchant_category", "string"),
    "cardholder_age": ("cardholder.age", "int"),
    "cardholder_country": ("cardholder.country", "string"),
    "device_type": ("device.device_type", "string"),
    "device_os": ("device.operating_system", "string"),
    "device_trust_score": ("device.device_trust_score", "double"),
    "velocity_last_24h": ("network_features.velocity_last_24h", "double"),
    "ip_risk_score": ("network_features.ip_risk_score", "double"),
    "city": ("location.city", "string"),
    "country": ("location.country", "string"),
    "is_foreign_transaction": ("location.is_foreign_transaction", "bool"),
    "location_mismatch": ("location.location_mismatch", "bool"),
    "auth_method": ("authentication.method", "string"),
    "failed_attempts": ("authentication.failed_attempts", "int"),
    "is_fraud": ("labels.is_fraud", None),
    "schema_version": ("schema_version", None),
}

# The 11 gold columns shared by all sources.
GOLD_SCHEMA = _struct(
    ("transaction_id", S), ("amount", D), ("transaction_hour", I), ("merchant_category", S),
    ("foreign_transaction", I), ("location_mismatch", I), ("device_trust_score", D),
    ("velocity_last_24h", D), ("cardholder_age", I), ("is_fraud", I), ("id_flag", I),
)
