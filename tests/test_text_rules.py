from medallion.functions.rules import risk_score_expr
from medallion.operators import rules, text
from pyspark.sql import functions as F

LINES = [
    "transaction_hour=5 TX-2024-41234567 User=42 Amount=1200,50 ARS MerchantCategory=groceries "
    "Method=Card Statuss=APPROVED ForeignTransaction=1 LocationMismatch=0 DeviceTrustScore=35 "
    "VelocityLast24h=10.0 CardholderAge=44 IsFraud=false IP=10.0.0.1",
    "TransactionHour=23 TX-2024-01234567 User=7 Amount=15.25 ARS MerchantCategory=travel Method=Transfer "
    "Status=DECLINED ForeignTransaction=0 LocationMismatch=1 DeviceTrustScore=80 VelocityLast24h=2.5 "
    "CardholderAge=30 IsFraud=true",
    "garbage line without fields",
]


def test_parse_logs_dirt(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    parsed = text.parse_logs(df).collect()
    a, b, c = parsed
    assert (a.transaction_id, a.transaction_hour, a.amount, a.status, a.ip) == ("TX-2024-41234567", 5, 1200.5, "APPROVED", "10.0.0.1")
    assert (b.transaction_hour, b.amount, b.currency, b.ip, b.is_fraud) == (23, 15.25, "ARS", None, True)
    assert a.is_foreign_transaction is True and b.location_mismatch is True
    assert c.transaction_id is None and c.is_fraud is None
    ok, bad = text.split_unparsed(text.parse_logs(df))
    assert ok.count() == 2 and bad.count() == 1


def test_risk_score_edges(spark):
    rows = [
        (False, False, 499.99, 9.9, 41.0),   # nothing: 0.05
        (False, False, 500.0, 10.0, 40.0),   # thresholds hit: 0.40
        (True, True, 500.0, 10.0, 40.0),     # everything: 0.90
        (None, None, None, None, None),      # nulls add nothing
    ]
    df = spark.createDataFrame(rows, "is_foreign_transaction boolean, location_mismatch boolean, amount double, "
                                     "velocity_last_24h double, device_trust_score double")
    out = rules.risk_band(rules.risk_score(df)).collect()
    assert [r.risk_score for r in out] == [0.05, 0.4, 0.9, 0.05]
    assert [r.risk_band for r in out] == ["low", "medium", "high", "low"]


def test_relabel_list_and_table(spark):
    df = spark.createDataFrame([("TX-2024-4001", False), ("TX-2024-0400", False), (None, True)], "id string, f boolean")
    note = spark.createDataFrame([('Todos ... "TX-2024-4..." fraude',)], "value string")
    assert [r.prefix for r in rules.rules_from_text(note).collect()] == ["TX-2024-4"]
    a = [r.f for r in rules.relabel_by_prefix(df, "id", ["TX-2024-4"], "f").collect()]
    b = [r.f for r in rules.relabel_by_prefix(df, "id", rules.rules_from_text(note), "f").collect()]
    assert a == [True, False, True] and sorted(b) == sorted(a)
    two = spark.createDataFrame([('both "TX-2024-4..." and "TX-2024-04", not TX-9 ""',)], "value string")
    assert sorted(r.prefix for r in rules.rules_from_text(two).collect()) == ["TX-2024-04", "TX-2024-4"]
    assert all(r.f for r in rules.relabel_by_prefix(df, "id", rules.rules_from_text(two), "f").collect())


def test_prefix_flag_int_and_null_ids(spark):
    df = spark.createDataFrame([(4123,), (None,)], "id long")
    assert [r.id_flag for r in rules.prefix_flag(df, "id", "TX-2024-4").collect()] == [0, 0]


def test_categories(spark):
    df = spark.createDataFrame([(" FOOD ",), ("NAN",), ("",), ("grocery",), (None,)], "c string")
    assert [r.c for r in text.normalize_category(df, "c").collect()] == ["Food", None, None, "Grocery", None]
    m = text.map_category(df, "c", {"grocery": "groceries"}).collect()
    assert [r.c for r in m] == ["food", "nan", "", "groceries", None]
    t = spark.createDataFrame([("grocery", "groceries")], "src string, dst string")
    assert [r.c for r in text.map_category_table(df, "c", t).orderBy("c").collect()] == sorted(
        [r.c for r in m], key=lambda x: (x is not None, x))


def test_score_columns_override(spark):
    df = spark.createDataFrame([(1,)], "x int")
    expr = risk_score_expr(columns={"is_foreign_transaction": F.lit(True), "location_mismatch": F.lit(False),
                                    "amount": F.lit(1.0), "velocity_last_24h": F.lit(1.0),
                                    "device_trust_score": F.lit(99.0)})
    assert df.select(expr).first()[0] == 0.3
