import json
import os


from medallion.plans import flows
from medallion.sources import readers, sinks
from medallion.sources.schemas import CSV_COLUMNS


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_csv_corrupt_rows(spark, tmp_dir):
    header = ",".join(CSV_COLUMNS)
    good = "1,10.5,3,food,0,0,80,1.0,30,0"
    _write(os.path.join(tmp_dir, "a.csv"), "\n".join([header, good, "2,11", good + ",extra,extra"]) + "\n")
    df = readers.read_csv(spark, tmp_dir).cache()
    good_df, bad_df = readers.split_corrupt(df)
    assert good_df.count() == 1 and bad_df.count() == 2
    rep = readers.corrupt_report(df).first()
    assert rep.rows == 3 and rep.corrupt_rows == 2


def _doc(i, tx, mismatch="0", amount="245.50", age="34", hour="14"):
    return {"transaction_id": tx, "timestamp": f"2024-05-0{i}T10:00:00Z", "transaction_hour": hour,
            "amount": amount, "merchant_category": "electronics",
            "cardholder": {"age": age, "country": "AR"},
            "device": {"device_type": "mobile", "operating_system": "android", "device_trust_score": "72"},
            "network_features": {"velocity_last_24h": "7.0", "ip_risk_score": "0.18"},
            "location": {"city": "X", "country": "AR", "is_foreign_transaction": "false",
                         "location_mismatch": mismatch},
            "authentication": {"method": "biometric", "failed_attempts": "0"},
            "labels": {"is_fraud": False}}


def test_json_flow_fixtures(spark, tmp_dir):
    j1 = _doc(1, "TX-2024-00098321")
    docs = [
        [j1], [j1],                                            # exact duplicate file
        [_doc(2, "TX-2024-40011123", mismatch="1.0")],          # relabel prefix, 1.0 accepted
        [_doc(3, "TX-2024-00045877", age="2168.55")],           # out of range age
        [_doc(4, None, amount="999999999999.99")],               # null id
        [_doc(5, "TX-2024-00077201", amount="abc")],            # amount -> mean
    ]
    for i, d in enumerate(docs):
        _write(os.path.join(tmp_dir, f"t{i}.json"), json.dumps(d, indent=2))
    _write(os.path.join(tmp_dir, "broken.json"), "[{\"transaction_id\": ")
    raw = readers.read_json(spark, os.path.join(tmp_dir, "*.json")).cache()
    good, bad = readers.split_corrupt(raw)
    assert bad.count() == 1
    out = {r.transaction_id: r for r in flows.clean_json(good).collect()}
    assert set(out) == {"TX-2024-00098321", "TX-2024-40011123", "TX-2024-00077201"}
    assert out["TX-2024-40011123"].is_fraud is True and out["TX-2024-40011123"].id_flag == 1
    assert out["TX-2024-00077201"].amount == 245.5   # mean of the other non-null amounts after id filter
    assert len(out["TX-2024-00098321"]) == 20


def test_manifest_and_audit(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "x.txt"), "hello\n")
    m = readers.file_manifest(spark, tmp_dir).collect()
    assert len(m) == 1 and m[0].length == 6
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    a = {r.k: (r.n_rows, r.present) for r in readers.audit_loaded(df, ["a", "c"], "k").collect()}
    assert a == {"a": (2, True), "c": (0, False)}


def test_logs_flow_and_gold(spark):
    lines = spark.createDataFrame([
        ("transaction_hour=5 TX-2024-41234567 User=42 Amount=1200,50 ARS MerchantCategory=groceries Method=Card "
         "Status=APPROVED ForeignTransaction=1 LocationMismatch=0 DeviceTrustScore=35 VelocityLast24h=10.0 "
         "CardholderAge=44 IsFraud=false",),
        ("nonsense",)], "value string")
    note = spark.createDataFrame([('ids "TX-2024-4..." are fraud',)], "value string")
    logs = flows.clean_logs(lines, note)
    r = logs.first()
    assert logs.count() == 1 and r.is_fraud is True and r.id_flag == 1 and r.ip_risk_score == 0.65
    gold = flows.build_gold(logs=logs, latest=True).first()
    assert gold.foreign_transaction == 1 and gold.source == "logs" and gold.priority == 3


def test_csv_flow_small(spark):
    rows = [(str(i), str(10.0 + i), str(i % 24), "food" if i % 2 else "NAN", "0", "1", "50", "1.0", "30",
             "1" if i % 10 == 0 else "0") for i in range(1, 60)]
    rows.append(("60.5", "1", "1", "x", "0", "0", "1", "1", "1", "0"))       # fractional id
    rows.append(("61", "99999", "3", "food", "0", "0", "50", "1.0", "30", "0"))  # amount outlier
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in CSV_COLUMNS))
    out = flows.clean_csv(df)
    got = out.collect()
    assert len(got) == 59
    assert sorted(r.transaction_id for r in got) == list(range(1, 60))
    assert {r.merchant_category for r in got} == {"Food"}


def test_load_typed_sorted(spark, tmp_dir):
    from pyspark.sql import types as T
    df = spark.createDataFrame([("3", "x"), ("1", "y"), ("300", "z")], "id string, s string")
    schema = T.StructType([T.StructField("id", T.ByteType()), T.StructField("s", T.StringType())])
    bad = sinks.load_typed(df, tmp_dir + "/t", schema, ["id"], partitions=2, quarantine_path=tmp_dir + "/q")
    assert bad.count() == 1
    assert [r.id for r in spark.read.parquet(tmp_dir + "/t").orderBy("id").collect()] == [1, 3]
    assert sinks.Layers("/x").path("gold", "t") == "/x/gold/t"


def test_json_fixtures_without_mismatch_are_all_dropped(spark, tmp_dir):
    """The shipped fixture documents carry no location_mismatch: the 6-column null rule drops them."""
    docs = [_doc(i, f"TX-2024-0000000{i}") for i in range(1, 5)]
    for d in docs:
        del d["location"]["location_mismatch"]
    _write(os.path.join(tmp_dir, "fx.json"), json.dumps(docs, indent=2))
    raw = readers.read_json(spark, os.path.join(tmp_dir, "fx.json"))
    assert raw.count() == 4
    assert flows.clean_json(raw).count() == 0
    assert flows.clean_json(raw, required=("amount",)).count() == 4


def test_load_typed_splits_a_hot_key(spark, tmp_dir):
    from pyspark.sql import types as T
    df = spark.range(3000).selectExpr("CAST(CASE WHEN id < 1000 THEN 7 ELSE id END AS STRING) AS k",
                                     "CAST(id AS STRING) AS v")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    sinks.load_typed(df, tmp_dir + "/hot", schema, ["k"], partitions=6)
    from pyspark.sql import functions as F
    per_file = spark.read.parquet(tmp_dir + "/hot").groupBy(F.input_file_name()).count().collect()
    assert len(per_file) >= 4 and max(r["count"] for r in per_file) < 1000
    assert spark.read.parquet(tmp_dir + "/hot").count() == 3000
