import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.operators import snapshots as snap

SCHEMA = "id long, name string, bal double"


def _t(spark):
    return spark.createDataFrame([(1, "a", 10.0), (2, "b", -5.0), (3, "c", None)], SCHEMA)


def test_update_delete_null_condition(spark):
    df = _t(spark)
    up = {r.id: r.bal for r in snap.update(df, F.col("bal") < 0, {"bal": 0.0}).collect()}
    assert up == {1: 10.0, 2: 0.0, 3: None}
    assert sorted(r.id for r in snap.delete(df, F.col("bal") > 0).collect()) == [2, 3]


def test_upsert_semantics_and_duplicates(spark):
    src = spark.createDataFrame([(2, "B", None), (4, "d", 1.0)], SCHEMA)
    out = {r.id: (r.name, r.bal) for r in snap.upsert(_t(spark), src, ["id"]).collect()}
    assert out == {1: ("a", 10.0), 2: ("B", None), 3: ("c", None), 4: ("d", 1.0)}
    dup = spark.createDataFrame([(4, "d", 1.0), (4, "e", 2.0)], SCHEMA)
    with pytest.raises(ValueError):
        snap.upsert(_t(spark), dup, ["id"])


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(0, 8), unique=True, max_size=8))
def test_upsert_idempotent(spark, keys):
    src = spark.createDataFrame([(k, f"s{k}", float(k)) for k in keys], SCHEMA)
    once = snap.upsert(_t(spark), src, ["id"])
    twice = snap.upsert(once, src, ["id"])
    assert sorted(map(tuple, once.collect()), key=str) == sorted(map(tuple, twice.collect()), key=str)


def test_diff_versions(spark):
    new = spark.createDataFrame([(1, "a", 10.0), (2, "b", 0.0), (4, "d", None)], SCHEMA)
    d = {r.id: r.change for r in snap.diff_versions(_t(spark), new, ["id"]).collect()}
    assert d == {2: "changed", 3: "removed", 4: "added"}


def test_append_enforces_the_schema(spark):
    t = _t(spark)
    assert snap.append(t, spark.createDataFrame([(5, "e", 1.0)], SCHEMA)).count() == 4
    with pytest.raises(snap.SchemaMismatch) as e:
        snap.append(t, spark.createDataFrame([("6", "f", "x")], "id string, name string, bal string"))
    assert {c for c, _, _ in e.value.report} == {"id", "bal"}


def test_diff_sees_a_value_that_moves_between_columns(spark):
    schema = "id long, a string, b string"
    old = spark.createDataFrame([(1, None, "x"), (2, None, None), (3, "p", "q")], schema)
    new = spark.createDataFrame([(1, "x", None), (2, None, None), (3, "p", "q")], schema)
    assert {r.id: r.change for r in snap.diff_versions(old, new, ["id"]).collect()} == {1: "changed"}
    twice = spark.createDataFrame([(3, "p", "q"), (3, "q", "p")], schema)
    assert {r.id: r.change for r in snap.diff_versions(twice, twice.limit(2), ["id"]).collect()} == {}


def test_null_keys_are_inserted_and_never_match(spark):
    src = spark.createDataFrame([(None, "n1", 1.0), (None, "n2", 2.0), (1, "A", 0.0)], SCHEMA)
    target = _t(spark).unionByName(spark.createDataFrame([(None, "t", 9.0)], SCHEMA))
    out = sorted((str(r.id), r.name) for r in snap.upsert(target, src, ["id"]).collect())
    assert out == [("1", "A"), ("2", "b"), ("3", "c"), ("None", "n1"), ("None", "n2"), ("None", "t")]
    same = snap.upsert(target, target.where("id is not null"), ["id"])  # both sides of one table
    assert same.count() == 4


def test_hot_key_upsert_and_diff(spark):
    """One key holds a third of the target: joins stay splittable, results stay whole."""
    rows = [(7, f"n{i}", float(i)) for i in range(30)] + [(i, f"n{i}", float(i)) for i in range(100, 160)]
    target = spark.createDataFrame(rows, SCHEMA)
    src = spark.createDataFrame([(7, "hot", 1.0), (1000, "new", 2.0)], SCHEMA)
    out = snap.upsert(target, src, ["id"])
    got = out.groupBy("id", "name").count().collect()
    assert {(r.id, r.name): r["count"] for r in got if r.id in (7, 1000)} == {(7, "hot"): 30, (1000, "new"): 1}
    assert out.count() == 91
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan
    d = {r.id: r.change for r in snap.diff_versions(target, out, ["id"]).collect()}
    assert d == {7: "changed", 1000: "added"}
