"""Sketch summaries, distributed ranks, Gram matrices, late winners, nested histograms, rule tables, loads and gates."""
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from medallion.operators import encode, keys, model, profile, snapshots, unify
from medallion.sources import readers, sinks
from medallion.sources.schemas import JSON_SCHEMA


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    """Lines of the plan that move rows."""
    return [x for x in plan(df).splitlines() if re.search(r"\bExchange (hash|range|Single)", x)]


# ---- sketch summary ----

def _mixed(spark, n=40_000):
    rng = random.Random(3)
    rows = [(i, rng.choice([1.0, 2.5, 2.5, -0.0, 0.0, float("nan"), None]), f"name {i % 300}", f"text {i * 7919 % n} " * 20,
             rng.choice(["x", "x", "y", None]), None) for i in range(n)]
    return spark.createDataFrame(rows, "id long, few double, names string, many string, flag string, none string")


def test_sketch_summary_is_exact_where_it_says_so(spark):
    df = _mixed(spark)
    sketched = {r.column_name: r for r in profile.summary_sketch(df, quartiles="cont").collect()}
    exact = {r.column_name: r for r in profile.summary(df).collect()}
    assert {c for c, r in sketched.items() if r.exact} == {"few", "names", "flag", "none"}
    for c, r in sketched.items():
        e = exact[c]
        assert r["count"] == e["count"]
        for m in ("mean", "std", "min", "q25", "q50", "q75", "max"):
            assert r[m] == e[m] or abs(r[m] - e[m]) < 1e-6
        if r.exact:
            assert (r.unique, r.top, r.top_text, r.freq) == (e.unique, e.top, e.top_text, e.freq)
            assert r.unique_low == r.unique == r.unique_high and r.freq_low == r.freq


def test_sketch_summary_bounds_hold(spark):
    rng = random.Random(4)
    values = [min(int(rng.paretovariate(0.4)), 10 ** 6) for _ in range(60_000)]
    df = spark.createDataFrame([(v, f"v{v}") for v in values], "v long, t string")
    truth = pd.Series(values).value_counts()
    for r in profile.summary_sketch(df, tracked=256).collect():
        assert not r.exact
        assert r.unique_low <= len(truth) <= r.unique_high
        top = int(r.top) if r.top is not None else int(r.top_text[1:])
        assert top == truth.index[0] and r.freq_low <= truth[top] <= r.freq


def test_sketch_summary_of_empty_and_null_columns(spark):
    empty = spark.createDataFrame([], "a long, b string")
    assert [(r["count"], r.unique, r.top, r.top_text, r.exact) for r in profile.summary_sketch(empty).collect()] == [
        (0, 0, None, None, True)] * 2


def test_sketches_move_no_values(spark):
    df = _mixed(spark, 100)
    aggregate = df.agg(F.call_function("approx_top_k", F.md5("many"), F.lit(9), F.lit(9)))
    assert "ObjectHashAggregate" in plan(aggregate)  # partial sketches, one buffer a task
    moved = exchanges(aggregate)
    assert len(moved) == 1 and "Single" in moved[0]
    assert "partial_approx_top_k" in plan(aggregate)


def test_share_needs_no_window(spark):
    counts = profile.value_counts(spark.range(100).withColumn("k", F.col("id") % 3), "k", normalize=True)
    assert "Window" not in plan(counts)
    assert abs(sum(r.share for r in counts.collect()) - 1) < 1e-12


# ---- rank of labels ----

def test_index_of_a_million_labels(spark):
    n = 1_000_000
    df = spark.range(n + n // 2).select(F.when(F.col("id") < n, F.col("id")).otherwise(F.col("id") % 1000).cast("string").alias("c"))
    index = encode.fit_index(df, "c")
    assert "SinglePartition" not in plan(index) and "Window" not in plan(index)
    row = index.agg(F.count("*"), F.count_distinct("idx"), F.min("idx"), F.max("idx")).first()
    assert tuple(row) == (n, n, 0.0, float(n - 1))
    first = sorted((str(i) for i in range(1000)))
    got = [r.label for r in index.where("idx < 1000").orderBy("idx").collect()]
    assert got == first  # the repeated ones, equal counts by name
    rest = [r.label for r in index.where("idx between 1000 and 1010").orderBy("idx").collect()]
    assert rest == sorted(str(i) for i in range(1000, n))[:11]


def test_one_hot_beyond_a_table_is_refused_and_has_a_vector(spark):
    df = spark.createDataFrame([(i, f"c{i % 7}" if i % 10 else None) for i in range(100)], "id long, c string")
    with pytest.raises(ValueError, match="more than 5 values"):
        encode.one_hot(df, "c", max_columns=5)
    vec = encode.one_hot_vector(df, "c")
    rank = {r.label: int(r.idx) for r in encode.fit_index(df, "c").collect()}
    for r in vec.collect():
        want = np.zeros(7)
        if r.c is not None:
            want[rank[r.c]] = 1
        assert (r.c_vec.toArray() == want).all()


# ---- Gram matrix ----

def test_gram_correlation_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 6)) + 1e6  # a large mean must not cost digits
    x[:, 3] = x[:, 0] * 2 + rng.normal(size=500) * 0.1
    x[:, 5] = 7.0
    frame = pd.DataFrame(x, columns=list("abcdef"))
    frame.loc[::50, "b"] = np.nan
    df = spark.createDataFrame(frame)
    clean = frame.dropna()
    got = {(r.a, r.b): r.r for r in profile.corr_gram(df).collect()}
    assert len(got) == 15
    for (a, b), r in got.items():
        if "f" in (a, b):
            assert r is None
        else:
            assert abs(r - np.corrcoef(clean[a], clean[b])[0, 1]) < 2e-6
    ranked = profile.label_gram(df, "a").collect()
    assert ranked[0].feature == "d" and ranked[-1].feature == "f" and ranked[-1].r is None
    assert [abs(r.r) for r in ranked[:-1]] == sorted((abs(r.r) for r in ranked[:-1]), reverse=True)
    assert all(r.r is None for r in profile.corr_gram(df.where("a < 0")).collect())


# ---- winners ----

def test_winners_move_no_text_and_sort_no_aggregate(spark):
    df = spark.createDataFrame([(i, "long text " * 50 + str(i % 90), "en") for i in range(100)], "id long, text string, lang string")
    for out in (keys.dedupe(df.drop("id")), keys.dedupe(df, ["text"], order=["id"]),
                unify.unify_latest(df.withColumn("priority", F.col("id").cast("int")), "text")):
        assert "SortAggregate" not in plan(out)
        assert exchanges(out) and all("text" not in re.search(r"Exchange \w+\(([^)]*)\)", x).group(1) for x in exchanges(out)
                                      if "hashpartitioning" in x)
    assert keys.dedupe(df, ["text"], order=["id"]).agg(F.max("id")).first()[0] == 89


def test_winners_against_plain_choice(spark):
    rng = random.Random(9)
    rows = [(rng.choice(["a", "b", "c", None, "hot", "hot"]), rng.choice([None, -0.0, 0.0, 1.5]), rng.choice([None, 1, 2, 3]),
             rng.choice([None, "p", "q"]), rng.randrange(10 ** 6)) for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, x double, o int, s string, v int").repartition(7)

    def key(r):
        return (r[0], None if r[1] is None else r[1] + 0.0)
    for order, keep in ((["o"], "first"), (["o"], "last"), (["s", "o"], "first"), (["s", "o"], "last"), ([], "first")):
        got = [tuple(r) for r in keys.winners(df, ["k", "x"], order, keep).collect()]
        assert len(got) == len({key(r) for r in rows}) == len({key(r) for r in got})
        at = [{"o": 2, "s": 3}[c] for c in order]
        for r in got:
            group = [q for q in rows if key(q) == key(r)]
            assert r in group
            best = [tuple(q[i] for i in at) for q in group]
            # nulls last, column by column
            for pos, i in enumerate(at):
                left = [b[pos] for b in best if b[pos] is not None and b[:pos] == tuple(r[j] for j in at[:pos])]
                want = (min(left) if keep == "first" else max(left)) if left else None
                assert r[i] == want


def test_winners_hot_key(spark):
    df = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
                                    (F.col("id") % 100).alias("o"), F.lit("pad " * 50).alias("pad"))
    out = keys.winners(df, ["k"], ["o"])
    assert out.count() == 20_001 and out.where("k = 'hot'").first().o == 0


# ---- folds ----

def test_folds_from_one_histogram(spark):
    df = spark.range(3000).select(F.col("id"), F.when(F.col("id") % 10 == 0, 1).when(F.col("id") % 501 == 7, None).otherwise(0).alias("y"))
    folded = model.fold_column(df, "id", 5, label="y")
    rows = folded.withColumn("h", model.hash_unit("id", 43)).collect()
    for y in (0, 1, None):
        own = sorted(r.h for r in rows if r.y == y)
        cuts = [own[max(0, math.ceil(j / 5 * len(own)) - 1)] for j in range(1, 5)]
        for r in rows:
            if r.y == y:
                assert r.fold == sum(r.h > c for c in cuts)
    one = plan(model.hash_thresholds(df.withColumn("h", model.hash_unit("id", 1)), "y", "h", [0.2]))
    four = plan(model.hash_thresholds(df.withColumn("h", model.hash_unit("id", 1)), "y", "h", [0.2, 0.4, 0.6, 0.8]))
    assert one.count("Exchange") == four.count("Exchange")


# ---- rule table ----

def test_tree_expression_equals_the_model(spark):
    rng = np.random.default_rng(5)
    frame = pd.DataFrame(rng.normal(size=(600, 3)).round(2), columns=["a", "b b", "c"])
    frame["y"] = ((frame["a"] > 0.3) ^ (frame["b b"] > -0.2)).astype(int) + (frame["c"] > 1).astype(int)
    frame["id"] = range(600)
    df = spark.createDataFrame(frame)
    cvm, _ = model.fit_tree(df, ["a", "b b", "c"], "y", "id", impurities=["gini"], depths=[5], folds=2)
    nodes = model.tree_table(spark, cvm, ["a", "b b", "c"]).collect()
    assert len(nodes) == cvm.bestModel.numNodes and {n.depth for n in nodes} <= set(range(6))
    assert sum(n.prediction is not None for n in nodes) == (len(nodes) + 1) // 2
    on_threshold = [(n.threshold, n.threshold, n.threshold, 0, 1000 + n.node) for n in nodes if n.threshold is not None]
    edge = df.unionByName(spark.createDataFrame([(0.0, float("inf"), 0.0, 0, 901), *on_threshold], df.schema))
    scored = model.predict(cvm, edge, ["a", "b b", "c"]).withColumn("r", F.expr(model.tree_expression(nodes)))
    assert scored.where("NOT (prediction <=> r)").count() == 0
    assert spark.sql(f"SELECT {model.tree_expression(nodes)} AS r FROM VALUES (null, 1.0, 1.0) t(a, `b b`, c)").first().r is None or \
        nodes[0].feature != "a"


def test_tree_expression_of_a_leaf(spark):
    assert model.tree_expression([(0, None, 0, None, None, None, None, 1.0)]) == "1.0D"


# ---- files ----

def test_json_files_are_parsed_or_set_aside_whole(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, body in {"a": '[\n{"transaction_id": "1",\n "amount": "2"},\n{"transaction_id": "2"}\n]', "b": '[{"transaction_id": "3"}, {',
                       "c": '{"transaction_id": "4"}', "d": "[]", "e": "[{}]"}.items():
        (tmp_path / "in" / f"{name}.json").write_text(body)
    rows, report = readers.read_json_files(spark, str(tmp_path / "in"), JSON_SCHEMA)
    assert sorted(str(r.transaction_id) for r in rows.collect()) == ["1", "2", "4", "None"]
    got = {r.source_file[-6]: (r["rows"], r.rejected, r.reject_text) for r in report.collect()}
    assert got["a"] == (2, False, None) and got["c"] == (1, False, None) and got["e"] == (1, False, None)
    assert got["b"][:2] == (0, True) and got["b"][2].startswith('[{"transaction_id": "3"}')


def test_typed_load_keeps_a_range_in_few_files(spark, tmp_path):
    from pyspark.sql import types as T
    df = spark.range(8000).select(F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") * 7919 % 1000).cast("string").alias("k"),
                                  F.col("id").cast("string").alias("v"))
    df = df.unionByName(spark.createDataFrame([("x", "1"), ("5", "y")], "k string, v string"))
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.LongType())])
    path, aside = str(tmp_path / "t"), str(tmp_path / "bad")
    sinks.load_typed(df, path, schema, ["k"], partitions=16, quarantine_path=aside)
    back = spark.read.parquet(path)
    assert back.count() == 8000 and spark.read.parquet(aside).count() == 2
    files = back.select("_metadata.file_path").distinct().count()
    assert files == 16  # the hot value is spread over several files
    for lo, hi in ((0, 50), (900, 950), (501, 520)):
        found = sinks.files_holding(back, F.col("k").between(lo, hi)).first()
        assert found.n_files <= 3 and found.n_rows == back.where(F.col("k").between(lo, hi)).count()
    assert sinks.files_holding(back, F.col("k") == 500).first().n_files >= 5
    assert "GreaterThanOrEqual(k,900)" in plan(back.where("k >= 900"))


def test_bucketed_tables_join_without_exchange(spark, tmp_path):
    a = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias("v"))
    b = spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    ta = sinks.save_bucketed(a, "bucket_test_a", ["k"], 4, str(tmp_path / "a"))
    tb = sinks.save_bucketed(b, "bucket_test_b", ["k"], 4, str(tmp_path / "b"))
    try:
        joined = ta.join(tb.hint("merge"), "k")
        assert "SortMergeJoin" in plan(joined) and not exchanges(joined)
        grouped = joined.groupBy("k").agg(F.sum("v").alias("v"))
        assert not exchanges(grouped) and grouped.count() == 100
        assert spark.table("bucket_test_a").count() == 1000
    finally:
        spark.sql("DROP TABLE bucket_test_a")
        spark.sql("DROP TABLE bucket_test_b")


def test_append_gate(spark):
    t = spark.createDataFrame([(1, "a")], "id long, s string")
    batches = {"ok": spark.createDataFrame([("b", 2)], "s string, id long"),
               "bad": spark.createDataFrame([("3", 1)], "id string, extra int")}
    grown, report = snapshots.append_batches(t, batches)
    assert sorted(map(tuple, grown.collect())) == [(1, "a"), (2, "b")]
    assert sorted(map(tuple, report.collect()), key=str) == sorted([
        ("ok", True, None, None, None), ("bad", False, "id", "bigint", "string"), ("bad", False, "s", "string", None),
        ("bad", False, "extra", None, "int")], key=str)


# ---- rolling activity ----

def test_velocity_against_plain_windows_with_a_hot_key(spark):
    from datetime import datetime, timedelta

    from medallion.operators.velocity import velocity
    rng = random.Random(6)
    start = datetime(2024, 1, 1)
    rows = [(i, rng.choice(["hot", "hot", "a", "b", None]), start + timedelta(minutes=rng.randrange(0, 5000, 30)),
             rng.choice([None, 1.25, -2.5, 10.0])) for i in range(900)] + [(900, "a", None, 1.0)]
    df = spark.createDataFrame(rows, "id long, k string, ts timestamp, x double")
    got = {r.id: r for r in velocity(df, "k", "ts", "x", 24).collect()}
    assert len(got) == len(rows) and got[900].velocity is None
    for i, k, ts, _ in rows[:900]:
        own = [r for r in rows[:900] if r[1] == k and ts - timedelta(hours=24) <= r[2] <= ts]
        assert got[i].velocity == len(own) and float(got[i].amount_in_range) == sum(r[3] or 0 for r in own)
    assert velocity(df.limit(0), "k", "ts").count() == 0
    text = plan(velocity(df, "k", "ts", "x", 24))
    assert "SinglePartition" not in text and re.search(r"Window .*\[k#\d+, b#\d+L\]", text)


def test_scratch_is_cleared(spark):
    import os

    from medallion.session import clear_scratch, ensure_checkpoint_dir, materialized
    kept = materialized(spark.range(5), "to-clear")
    path = spark.sparkContext._medallion_scratch[-1]
    assert kept.count() == 5 and os.path.isdir(path) and path.startswith(ensure_checkpoint_dir(spark))
    # only this test's folder: other tests may still read theirs
    others, spark.sparkContext._medallion_scratch = spark.sparkContext._medallion_scratch[:-1], [path]
    assert clear_scratch(spark) == 1 and not os.path.exists(path)
    spark.sparkContext._medallion_scratch = others


# ---- tree grid ----

def _noisy(spark, n: int):
    rng = np.random.default_rng(11)
    frame = pd.DataFrame(rng.normal(size=(n, 3)).round(1), columns=["a", "b", "c"])
    frame["y"] = ((frame["a"] + rng.normal(size=n) > 0.3) ^ (frame["b"] > 0.5)).astype(int) + (frame["c"] > 1.2).astype(int)
    frame["id"] = [f"r{i}" for i in range(n)]
    return spark.createDataFrame(frame)


def test_grid_scores_equal_those_of_every_tree_trained_by_itself(spark):
    from pyspark.ml.classification import DecisionTreeClassifier
    df, names = _noisy(spark, 700), ["a", "b", "c"]
    cvm, grid = model.fit_tree(df, names, "y", "id", depths=[1, 2, 4, 6], folds=3)
    rows = model.cv_results(spark, cvm, grid).collect()
    data = encode.assemble(model.fold_column(df, "id", 3, label="y"), names).withColumn("l", F.col("y").cast("double")).persist()
    best = None
    for r in rows:
        dt = DecisionTreeClassifier(featuresCol="features", labelCol="l", seed=42, maxBins=32, impurity=r.impurity, maxDepth=r.max_depth)
        got = []
        for f in range(3):
            scored = dt.fit(data.where(F.col("fold") != f)).transform(data)
            hit = F.avg((F.col("prediction") == F.col("l")).cast("double"))
            got.append({x.held_out: x.a for x in scored.groupBy((F.col("fold") == f).alias("held_out")).agg(hit.alias("a")).collect()})
        assert abs(r.cv_accuracy - sum(x[True] for x in got) / 3) < 1e-9
        assert abs(r.train_accuracy - sum(x[False] for x in got) / 3) < 1e-9
        best = max(best or (0,), (r.cv_accuracy,))
    data.unpersist()
    assert [r.cv_accuracy for r in rows if r.is_best] == [best[0]] and len({round(r.cv_accuracy, 6) for r in rows}) > 3


def test_rows_are_not_dealt_out_by_label(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 2).alias("y"))
    for out in (model.fold_column(df, "id", 5, label="y"), model.stratified_split(df, "y", "id")):
        text = plan(out)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text and "hashpartitioning(y" not in text


def test_trees_do_not_depend_on_how_the_rows_lay(spark):
    df, names = _noisy(spark, 30_000), ["a", "b", "c"]  # more rows than the trainer samples for its thresholds
    fit = [model.fit_tree(d, names, "y", "id", impurities=["gini"], depths=[5], folds=2)[0].bestModel.toDebugString.split("\n", 1)[1]
           for d in (df.repartition(3, "a"), df.orderBy(F.desc("id")).coalesce(1))]
    assert fit[0] == fit[1]


# ---- flows over compressed input ----

def _events(spark, n: int, path):
    spark.range(n).selectExpr("id AS event_id", "timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(0, 0, CAST(id AS INT)) AS ts", "id % 50 AS user_id",
                              "element_at(array('view', 'click', 'error'), CAST(id % 3 + 1 AS INT)) AS event_type",
                              "CAST(id % 90 AS DOUBLE) AS value").coalesce(1).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_events_of_one_block_are_rendered_by_many_tasks(spark, tmp_path):
    from medallion.plans import bindings
    sf = _events(spark, 500, tmp_path)
    assert bindings.table(spark, sf, "events").rdd.getNumPartitions() == 1
    for df in (bindings.event_json_docs(spark, sf), bindings.event_log_lines(spark, sf)):
        assert df.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism and df.count() == 500


def test_csv_rows_are_parsed_once_before_the_dedupe(spark, tmp_path, monkeypatch):
    from medallion.plans import bindings, flows
    seen, dedupe = [], keys.dedupe
    monkeypatch.setattr(flows.keys, "dedupe", lambda df, *a, **kw: (seen.append(plan(df)), dedupe(df, *a, **kw))[1])
    assert bindings.clean_csv_flow(spark, _events(spark, 400, tmp_path)).count() > 0
    assert "csv-parsed" in seen[0] and "RLIKE" not in seen[0]


def test_wide_projections_stay_compiled_unless_the_session_says_otherwise(spark):
    from medallion.session import ensure_compiled
    key = "spark.sql.codegen.hugeMethodLimit"
    old = spark.conf.get(key)
    try:
        for given, kept in (("65535", "8000"), ("9000", "9000")):
            spark.conf.set(key, given)
            ensure_compiled(spark)
            assert spark.conf.get(key) == kept
    finally:
        spark.conf.set(key, old)


# ---- cells of the quantiles ----

def test_cells_of_values_around_edges(spark):
    from medallion.operators import stats
    points = [-2.0, 0.0, 0.5, 3.0, 3.5]
    values = [-9.0, -2.0, -1.0, -0.0, 0.2, 0.5, 1.0, 3.0, 3.2, 3.5, 99.0, float("-inf"), float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for n in range(len(points) + 1):
        cell = stats._cell(F.col("v"), points[:n])
        for r in df.select("v", cell.alias("cell")).collect():
            assert r.cell == 2 * sum(p < r.v for p in points[:n]) + (r.v in points[:n])
    assert "lambda" not in plan(df.select(stats._cell(F.col("v"), points)))
