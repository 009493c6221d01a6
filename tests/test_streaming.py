import os

from medallion.streaming.logs import start_log_ingest

LINE = ("transaction_hour=5 TX-2024-4{n:07d} User=42 Amount=1200,50 ARS MerchantCategory=groceries Method=Card "
        "Status=APPROVED ForeignTransaction=1 LocationMismatch=0 DeviceTrustScore=35 VelocityLast24h=10.0 "
        "CardholderAge=44 IsFraud=false")


def test_stream_ingest_dedupes_and_resumes(spark, tmp_dir):
    src, dst, ck = (os.path.join(tmp_dir, x) for x in ("src", "dst", "ck"))
    os.makedirs(src)
    with open(os.path.join(src, "a.log"), "w") as f:
        f.write("\n".join([LINE.format(n=1), LINE.format(n=1), LINE.format(n=2), "junk"]) + "\n")
    q = start_log_ingest(spark, src, dst, ck, trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(dst)
    assert out.count() == 2 and out.where("is_fraud").count() == 2
    with open(os.path.join(src, "b.log"), "w") as f:
        f.write(LINE.format(n=3) + "\n")
    q = start_log_ingest(spark, src, dst, ck, trigger_once=True)
    q.awaitTermination(120)
    assert spark.read.parquet(dst).count() == 3


def test_stream_dedupe_by_key(spark, tmp_dir):
    src, dst, ck = (os.path.join(tmp_dir, x) for x in ("src", "dst", "ck"))
    os.makedirs(src)
    other = LINE.format(n=1).replace("User=42", "User=43")   # same id, different row
    with open(os.path.join(src, "a.log"), "w") as f:
        f.write("\n".join([LINE.format(n=1), other, LINE.format(n=2)]) + "\n")
    q = start_log_ingest(spark, src, dst, ck, trigger_once=True, dedupe_on=["transaction_id"])
    q.awaitTermination(120)
    assert spark.read.parquet(dst).count() == 2
