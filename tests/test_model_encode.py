from pyspark.sql import functions as F

from medallion.operators import encode, model


def test_stratified_split_exact_share(spark):
    df = spark.createDataFrame([(i, 1 if i % 7 == 0 else 0) for i in range(700)], "id long, y int")
    s = model.stratified_split(df, "y", "id", 0.2, 42)
    rep = {(r.split, r.y): r["count"] for r in s.groupBy("split", "y").count().collect()}
    assert rep[("test", 1)] == 20 and rep[("test", 0)] == 120


def test_index_and_one_hot(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), ("a",), (None,)], "c string")
    idx = {r.c: r.c_idx for r in encode.index_category(df, "c").collect()}
    assert idx == {"a": 0.0, "b": 1.0, "c": 2.0, None: 3.0}   # a,b tie -> alphabetical; null -> number of labels
    oh = encode.one_hot(df, "c").columns
    assert oh == ["c_a", "c_b", "c_c"]
    m = encode.fit_index([df, spark.createDataFrame([("z",)], "c string")], "c")
    assert "z" in {r.label for r in m.collect()}
    z = spark.createDataFrame([("z",), ("new",)], "c string")
    assert {r.c: r.i for r in encode.index_category(z, "c", "i", m).collect()} == {"z": 3.0, "new": 4.0}


def test_confusion_and_report(spark):
    rows = [(1, 1)] * 3 + [(1, 0)] + [(0, 0)] * 5 + [(0, 1)]
    df = spark.createDataFrame(rows, "y int, p int")
    cm = {(r.actual, r.predicted): r.n for r in model.confusion_matrix(df, "y", "p").collect()}
    assert cm == {(0, 0): 5, (0, 1): 1, (1, 0): 1, (1, 1): 3}
    rep = {r["class"]: r for r in model.classification_report(df, "y", "p").collect()}
    assert rep["1"].precision == 0.75 and rep["1"].recall == 0.75 and rep["accuracy"].f1 == 0.8
    assert rep["weighted avg"].support == 10
    pc = [tuple(r) for r in model.prediction_counts(df, "y", "p").collect()]
    assert pc == [(0.0, 6, 6), (1.0, 4, 4)]


def test_report_keeps_every_row_and_any_class(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "a"), ("c", None)], "y string, p string")
    cm = {(r.actual, r.predicted): r.n for r in model.confusion_matrix(df, "y", "p", ["a", "b"]).collect()}
    assert len(cm) == 16 and sum(cm.values()) == 4 and cm[("a", "a")] == 1 and cm[(None, "a")] == 1 and cm[("c", None)] == 1
    rep = {r["class"]: r for r in model.classification_report(df, "y", "p", ["a", "b"]).collect()}
    assert rep["accuracy"].f1 == 0.25 and rep["accuracy"].support == 4 and rep["c"].support == 1 and rep["null"].support == 1
    mixed = spark.createDataFrame([(1, 1.0), (0, 1.0), (2, 0.0)], "y int, p double")
    cm = {(r.actual, r.predicted): r.n for r in model.confusion_matrix(mixed, "y", "p").collect()}
    assert len(cm) == 9 and cm[(1, 1)] == 1 and cm[(0, 1)] == 1 and cm[(2, 0)] == 1


def test_folds_are_stratified(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    n = {(r.y, r.fold): r["count"] for r in model.fold_column(df, "id", 5, label="y").groupBy("y", "fold").count().collect()}
    assert {k for _, k in n} == set(range(5))
    assert all(n[(1, f)] == 60 and n[(0, f)] == 540 for f in range(5))


def test_tree_fit_small_grid(spark):
    df = spark.range(400).select(F.col("id").cast("string").alias("rid"), (F.col("id") % 10).cast("double").alias("x"),
                                 ((F.col("id") * 7) % 13).cast("double").alias("z"))
    df = df.withColumn("y", (F.col("x") >= 5).cast("int"))
    cvm, grid = model.fit_tree(df, ["x", "z"], "y", "rid", impurities=["gini"], depths=[1, 2], folds=2)
    res = model.cv_results(spark, cvm, grid).collect()
    assert len(res) == 2 and max(r.cv_accuracy for r in res) > 0.99
    assert max(r.train_accuracy for r in res) > 0.99 and [r.is_best for r in res] == [True, False]
    imp = model.feature_importances(spark, cvm, ["x", "z"]).first()
    assert imp.feature == "x"
    assert model.predict(cvm, df, ["x", "z"]).where("prediction = y").count() == 400
    assert model.tree_rules(spark, cvm).count() > 1


def test_rebalance_rate(spark):
    df = spark.createDataFrame([(i, 1 if i % 20 == 0 else 0) for i in range(4000)], "id long, y int")
    out = model.rebalance(df, "y", "id", 0.15)
    c = dict(out.groupBy("y").count().collect())
    assert c[1] == 200 and abs(c[1] / (c[0] + c[1]) - 0.15) < 0.03


def test_model_frame_and_numeric_index(spark):
    df = spark.createDataFrame([("1.5", True, 3, "x"), ("abc", False, 4, "y"), ("2", None, 5, "z")],
                               "a string, b boolean, h int, id string")
    mf = encode.model_frame(df, drop=["id"]).collect()
    assert [tuple(r) for r in mf] == [(1.5, 1.0, 3.0)]
    hours = spark.createDataFrame([(23,), (7,), (7,), (None,)], "h int")
    assert sorted((str(r.h), r.h_idx) for r in encode.index_category(hours, "h").collect()) == [
        ("23", 1.0), ("7", 0.0), ("7", 0.0), ("None", 2.0)]
    v = encode.assemble(spark.createDataFrame([(1.0, 2.0)], "x double, y double"), ["x", "y"]).first()
    assert list(v.features) == [1.0, 2.0]


def test_model_frame_takes_numbers_as_they_are(spark):
    df = spark.createDataFrame([("a", 1.5, 7, True, " 2 ", "u"), ("b", float("nan"), 7, True, "2", "u"), ("c", float("inf"), 7, True, "2", "u"),
                                ("d", -0.25, None, True, "2", "u"), ("e", 1e300, -9, False, "3e1", None), ("f", 1.0, 1, True, "x", "u")],
                               "id string, d double, i int, b boolean, t string, c string")
    numbers = encode.model_frame(encode.one_hot(df.drop("t"), "c", ["u"]), keep=["id"])
    plan = numbers._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.upper()  # no column goes through text
    assert "= u)" not in "".join(x for x in plan.splitlines() if "Filter" in x)  # one-hot columns cannot be null
    got = encode.model_frame(encode.one_hot(df, "c", ["u"]), keep=["id"]).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("a", 1.5, 7.0, 1.0, 2.0, 1.0), ("e", 1e300, -9.0, 0.0, 30.0, 0.0)]


def test_trees_are_trained_with_the_number_of_classes_noted(spark, monkeypatch):
    seen, fit = [], model.DecisionTreeClassifier.fit
    monkeypatch.setattr(model.DecisionTreeClassifier, "fit", lambda self, d, *a: (seen.append(d.schema["__label"].metadata), fit(self, d, *a))[1])
    df = spark.range(90).selectExpr("id", "double(id % 9) AS x", "int(id % 9 > 2) + int(id % 9 > 5) AS y")
    cvm, _ = model.fit_tree(df, ["x"], "y", "id", impurities=["gini"], depths=[2], folds=2)
    assert len(seen) == 3 and all(m["ml_attr"]["num_vals"] == 3 for m in seen)
    assert cvm.bestModel.numClasses == 3 and cvm.avgMetrics == [1.0]
    for top in (None, 0.0, 100.0, 1.5, float("nan"), float("inf")):
        assert not model._with_classes(df, "y", top).schema["y"].metadata
