from pyspark.sql import functions as F

from medallion.operators import impute, outliers


def _df(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0, None]
    return spark.createDataFrame([(i, v, float(i % 4)) for i, v in enumerate(vals)], "i int, v double, w double")


def test_fences_contain_quartiles(spark):
    f = outliers.fences(_df(spark), ["v", "w"]).collect()
    for r in f:
        assert r.lo <= r.q1 <= r.q3 <= r.hi


def test_outlier_report_and_box_stats(spark):
    r = outliers.outlier_report(_df(spark), ["v"]).first()
    assert r.n_outliers == 1 and r.max_value == 100.0 and r.median == 5.0
    b = outliers.box_stats(_df(spark), ["v"]).first()
    assert b.whisker_hi == 8.0 and b.whisker_lo == 1.0 and b.n_outliers == 1


def test_iqr_sequential_differs_from_simultaneous(spark):
    rows = [(float(a), float(b)) for a, b in [(1, 1), (2, 2), (3, 3), (4, 4), (50, 5), (5, 60), (6, 6), (7, 7)]]
    df = spark.createDataFrame(rows, "a double, b double")
    seq = outliers.iqr_filter(df, ["a", "b"], 1.5, sequential=True)
    sim = outliers.iqr_filter(df, ["a", "b"], 1.5, sequential=False)
    assert seq.count() == 6 and sim.count() == 6
    assert outliers.iqr_filter(df, ["a"], {"a": 100.0}).count() == 8


def test_iqr_nulls_fail_unless_kept(spark):
    df = _df(spark)
    assert outliers.iqr_filter(df, ["v"]).where(F.col("v").isNull()).count() == 0
    assert outliers.iqr_filter(df, ["v"], keep_nulls=True).where(F.col("v").isNull()).count() == 1


def test_fills(spark):
    df = _df(spark)
    assert impute.fill_median(df, ["v"]).where("i = 9").first().v == 5.0
    assert abs(impute.fill_mean(df, ["v"]).where("i = 9").first().v - 136 / 9) < 1e-12
    assert impute.fill_const(df, {"v": 0.0}).where("i = 9").first().v == 0.0


def test_fill_mode_ties_smallest_and_null_excluded(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "c string")
    assert sorted(r.c for r in impute.fill_mode(df, "c").collect()) == ["a"] * 5 + ["b"] * 2


def test_null_if_sentinels(spark):
    df = spark.createDataFrame([("NAN",), (" nan ",), ("Food",), (None,)], "c string")
    assert [r.c for r in impute.null_if(df, "c").collect()] == [None, None, "Food", None]
