"""Edge values of FIXTURES §7 through the coercion and filter operators."""
from pyspark.sql import functions as F

from medallion.functions import coerce as fx
from medallion.operators import cleaning

NUM_TEXT = ["", " 12 ", "abc", "nan", "NAN", "inf", "12f", "1e3", "34.0", None, "-3.5", ".5"]
NUM_WANT = [None, 12.0, None, None, None, None, None, 1000.0, 34.0, None, -3.5, 0.5]


def test_as_double_strict(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(NUM_TEXT)], "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(fx.as_double("v")).collect()]
    assert got == NUM_WANT


def test_as_int_truncates_through_double(spark):
    df = spark.createDataFrame([("34.0",), ("578.74",), ("-1",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(fx.as_int("v")).collect()] == [34, 578, -1, None, None]


def test_bool_set_and_cast_differ_on_one_point_zero(spark):
    flags = ["0", "1", "2", "", "true", "1.0", "0.0", "yes", " No ", None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(flags)], "i int, v string")
    rows = df.orderBy("i").select(fx.as_bool_set("v").alias("s"), fx.as_bool_cast("v").alias("c")).collect()
    assert [r.s for r in rows] == [False, True, None, None, True, True, False, True, False, None]
    assert [r.c for r in rows] == [False, True, None, None, True, None, None, True, False, None]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,), (11.0,), (None,)], "v double")
    assert [r[0] for r in df.select(fx.clamp("v", 0.0, 10.0)).collect()] == [0.0, 5.0, 10.0, None]


def test_timestamp_bad_text_is_null(spark):
    df = spark.createDataFrame([("2024-01-01 10:00:00",), ("2024-13-45 00:00:00",), ("nope",)], "v string")
    got = [r[0] for r in cleaning.coerce_timestamp(df, "v").collect()]
    assert got[0] is not None and got[1] is None and got[2] is None


def test_clean_flag_and_ranges(spark):
    df = spark.createDataFrame([("0",), ("1",), ("2",), ("",), (None,), ("1.0",), ("99",)], "f string")
    assert sorted(r[0] for r in cleaning.clean_flag(df, "f").collect()) == [0, 0, 0, 1, 1]
    h = spark.createDataFrame([(-1.0,), (0.0,), (23.0,), (24.0,), (578.74,), (None,)], "h double")
    assert sorted(r[0] for r in cleaning.keep_between(h, {"h": (0, 23)}).collect()) == [0.0, 23.0]
    assert sorted(r[0] for r in cleaning.keep_at_most(h, "h", 24).collect()) == [-1.0, 0.0, 23.0, 24.0]


def test_keep_integral(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (None,), (-2.0,)], "v double")
    assert sorted(r[0] for r in cleaning.keep_integral(df, "v").collect()) == [-2.0, 1.0]


def test_conform_reports_violations(spark):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("a", T.ByteType()), T.StructField("b", T.DoubleType()),
                           T.StructField("c", T.StringType(), False)])
    df = spark.createDataFrame([("300", "1.5", "x"), ("12", "abc", None)], "a string, b string, c string")
    rows = cleaning.conform(df, schema).collect()
    assert rows[0].a is None and rows[0]._violations == ["a"]
    assert rows[1].a == 12 and rows[1].b is None and rows[1]._violations == ["b", "c"]
    good, bad = cleaning.split_conformed(cleaning.conform(df, schema))
    assert good.count() == 0 and bad.count() == 2


def test_validate_rules(spark):
    df = spark.createDataFrame([(5.0, 1), (None, 1), (50.0, 0)], "v double, f int")
    out = cleaning.validate(df, {"v_small": F.col("v") < 10, "f_set": F.col("f") == 1}).collect()
    assert [(r._valid, r._violations) for r in out] == [
        (True, []), (False, ["v_small"]), (False, ["v_small", "f_set"])]


def test_drop_sparse_and_empty_rows(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, "x"), (None, None, None)], "a int, b int, c string")
    assert cleaning.drop_sparse(df, 0.9).columns == ["a", "c"]
    assert cleaning.drop_empty_rows(df).count() == 2


def test_flatten_null_struct(spark):
    df = spark.createDataFrame([({"age": "34", "country": "AR"},), (None,)],
                               "cardholder struct<age:string,country:string>")
    out = cleaning.flatten(df, {"age": ("cardholder.age", "int"), "country": ("cardholder.country", None)})
    assert [tuple(r) for r in out.collect()] == [(34, "AR"), (None, None)]


def test_long_ids_keep_their_digits(spark):
    from pyspark.sql import types as T

    from medallion.functions import coerce as fx
    from medallion.operators import cleaning
    ids = ["9007199254740993", " 9223372036854775807 ", "9007199254740993.0", "12.5", "1e3", "abc", None, "-7", "99999999999999999999"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, x string")
    got = [r.v for r in df.select("i", fx.as_long("x").alias("v")).orderBy("i").collect()]
    assert got == [9007199254740993, 9223372036854775807, 9007199254740993, None, 1000, None, None, -7, None]
    schema = T.StructType([T.StructField("i", T.ByteType()), T.StructField("x", T.LongType())])
    out = {r.i: (r.x, r._violations) for r in cleaning.conform(df, schema).collect()}
    assert out[0] == (9007199254740993, []) and out[3] == (12, []) and out[5] == (None, ["x"]) and out[8] == (None, ["x"])
    big = spark.createDataFrame([(9007199254740993,)], "x long")
    assert cleaning.conform(big, T.StructType([T.StructField("x", T.LongType())])).first().x == 9007199254740993
