from pyspark.sql import functions as F

from medallion.operators import profile


def test_null_counts_and_long_form(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "b"), (3, 2.0, None)], "a int, b double, c string")
    assert profile.null_counts(df).first().asDict() == {"a": 1, "b": 2, "c": 1}
    assert [tuple(r) for r in profile.null_counts_long(df).collect()] == [("b", 2), ("a", 1), ("c", 1)]


def test_value_counts_keeps_null_group(spark):
    df = spark.createDataFrame([("x",), ("x",), (None,), ("y",)], "k string")
    rows = profile.value_counts(df, "k", normalize=True).collect()
    assert [(r.k, r["count"], r.share) for r in rows] == [("x", 2, 0.5), (None, 1, 0.25), ("y", 1, 0.25)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "a"), (2, "b"), (3, "b")], "i int, s string")
    assert profile.duplicate_rows(df).first()[0] == 2
    assert [tuple(r) for r in profile.duplicate_keys(df, ["s"]).collect()] == [("a", 3), ("b", 2)]


def test_summary_and_ranges(spark):
    df = spark.createDataFrame([(float(x), x % 3) for x in range(1, 11)], "v double, w long")
    s = {r.column_name: r for r in profile.summary(df, ["v", "w"]).collect()}
    assert s["v"]["count"] == 10 and s["v"]["unique"] == 10 and s["v"]["mean"] == 5.5
    assert s["w"]["top"] == 1.0 and s["w"]["freq"] == 4   # 1,4,7,10
    r = {x.column_name: (x.min_value, x.max_value) for x in profile.numeric_ranges(df).collect()}
    assert r == {"v": (1.0, 10.0), "w": (0.0, 2.0)}


def test_corr_matches_numpy(spark):
    import numpy as np
    xs = list(range(20))
    ys = [x * 2 + (x % 3) for x in xs]
    df = spark.createDataFrame(list(zip([float(x) for x in xs], [float(y) for y in ys])), "x double, y double")
    r = profile.corr_matrix(df, ["x", "y"]).first()
    assert (r.a, r.b) == ("x", "y") and abs(r.r - round(float(np.corrcoef(xs, ys)[0, 1]), 6)) < 1e-9
    lab = df.withColumn("label", (F.col("y") > 20).cast("int"))
    assert profile.label_correlations(lab, "label").first().feature in ("x", "y")


def test_stage_audit_counts_without_extra_scan(spark):
    a = profile.StageAudit()
    df = a.mark(spark.range(100), "read")
    df = a.mark(df.where("id % 2 = 0"), "even")
    df.write.format("noop").mode("overwrite").save()
    assert a.report() == [("read", 100, 0), ("even", 50, 50)]


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "i int, s string")
    assert [tuple(r) for r in profile.schema_report(df).collect()] == [(0, "i", "int", True), (1, "s", "string", True)]


def test_preview_sample_and_examples(spark):
    from medallion.operators import outliers
    df = spark.createDataFrame([(i, float(i), "b" if i % 2 else "a") for i in range(10)], "i int, v double, s string")
    assert profile.preview(df, 3, ["i"]).columns == ["i"] and profile.preview(df, 3).count() == 3
    assert [r.s for r in profile.distinct_sample(df, "s", 5).collect()] == ["a", "b"]
    assert [r.v for r in outliers.outlier_examples(df, "v", 1.0, 7.0, 2).collect()] == [9.0, 8.0]
    assert [tuple(r) for r in profile.class_balance(df, "s").collect()] == [("a", 5, 0.5), ("b", 5, 0.5)]


def test_read_table_and_count_prefix(spark):
    from medallion.operators import cleaning
    from medallion.sources import readers
    df = spark.createDataFrame([("TX-2024-41",), ("TX-2024-01",), (None,)], "id string")
    df.createOrReplaceTempView("tx_view")
    assert readers.read_table(spark, "tx_view").count() == 3
    ints = spark.createDataFrame([(4,)], "id long")
    got = {r.source: r.n_rows for r in cleaning.count_prefix({"a": df, "b": ints}, "id", "TX-2024-4").collect()}
    assert got == {"a": 1, "b": 0}
