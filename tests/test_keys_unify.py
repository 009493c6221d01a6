from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.operators import keys, unify


def test_dedupe_variants(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 5), (3, "b", 1), (3, "b", 1)], "id int, k string, v int")
    assert keys.dedupe(df).count() == 3
    assert keys.dedupe(df, ignore=["id"]).count() == 2
    first = keys.dedupe(df, ["k"], order=["id"]).orderBy("k").collect()
    assert [(r.id, r.k) for r in first] == [(1, "a"), (3, "b")]
    last = keys.dedupe(df, ["k"], order=["id"], keep="last").orderBy("k").collect()
    assert [r.id for r in last] == [2, 3]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(0, 20)), min_size=1, max_size=50))
def test_resequence_dense(spark, xs):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "tie int, k int")
    out = keys.resequence(df, ["k", "tie"], "seq", partitions=3).collect()
    assert sorted(r.seq for r in out) == list(range(1, len(xs) + 1))
    ordered = sorted(out, key=lambda r: r.seq)
    keyed = [((r.k is not None), r.k if r.k is not None else 0, r.tie) for r in ordered]
    assert keyed == sorted(keyed)


def test_resequence_plan_has_no_single_partition(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    out = keys.resequence(df, ["k", "id"], "seq")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def _sources(spark):
    a = spark.createDataFrame([("1", 10.0, "x"), ("2", 20.0, "y")], "id string, amount double, s string")
    b = spark.createDataFrame([("2", 21.0, None), ("3", 30.0, "z")], "id string, amount double, s string")
    return {"csv": (a, 1), "json": (b, 2)}


def test_unify_and_latest(spark):
    u = unify.unify(_sources(spark))
    assert u.count() == 4
    latest = {r.id: r for r in unify.unify_latest(u, "id").collect()}
    assert latest["2"].amount == 21.0 and latest["2"].s is None and latest["2"].source == "json"
    col = {r.id: r for r in unify.unify_latest(u, "id", mode="column").collect()}
    assert col["2"].amount == 21.0 and col["2"].s == "y"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(1, 3)), min_size=1, max_size=30))
def test_unify_latest_unique(spark, rows):
    df = spark.createDataFrame([(str(k), p, i) for i, (k, p) in enumerate(rows)], "id string, priority int, t int")
    out = unify.unify_latest(df, "id", "priority", tiebreak=["t"]).collect()
    assert len(out) == len({k for k, _ in rows})
    for r in out:
        best = max((p, i) for i, (k, p) in enumerate(rows) if str(k) == r.id)
        assert (r.priority, r.t) == best


def test_dedupe_null_order_never_wins(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 3, 3), ("b", None, 4)], "k string, o int, v int")
    first = {r.k: r.v for r in keys.dedupe(df, ["k"], order=["o"]).collect()}
    last = {r.k: r.v for r in keys.dedupe(df, ["k"], order=["o"], keep="last").collect()}
    assert first == {"a": 3, "b": 4} and last == {"a": 2, "b": 4}


def test_resequence_hot_key_spreads_and_is_repeatable(spark):
    df = spark.range(3000).select(F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("v"))
    a = keys.resequence(df, ["k"], "seq", partitions=6)
    b = keys.resequence(df, ["k"], "seq", partitions=6)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert sorted(r.seq for r in a.collect()) == list(range(1, 3001))


def test_winners_plans_its_joins_from_the_written_size_of_the_repeated_keys(spark, tmp_dir):
    path = f"{tmp_dir}/wide"
    spark.range(6000).selectExpr("IF(id < 4, 1, id) AS k", "id AS o", "sha2(string(id), 256) AS text").write.parquet(path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")  # less than the table, more than its repeated keys
    try:
        out = keys.winners(spark.read.parquet(path), ["k"], ["o"])
        plan = out._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
        got = out.agg({"k": "count", "o": "sum"}).first()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert sorted(got) == [5997, sum(range(6000)) - 6]
