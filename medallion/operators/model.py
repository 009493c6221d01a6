"""Decision-tree modelling with Spark ML (MOD-*)."""
from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medallion.operators.encode import assemble
from medallion.session import materialized


def hash_unit(id_col: str, seed: int) -> Column:
    """Deterministic 32-bit hash of ``id:seed`` as a bigint (md5 prefix).

    The same number is computed by SQL engines with md5 + hex parsing, so a
    split can be reproduced outside Spark.
    """
    txt = F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(txt), 1, 8), 16, 10).cast("long")


def hash_thresholds(df: DataFrame, label: str, hash_col: str, fractions: Sequence[float]) -> DataFrame:
    """(label, thresholds): the hashes at the ranks ``ceil(f * n)`` of each label's 32-bit hashes, one for each fraction.

    One nested histogram for all labels and fractions: counts by the upper 16 bits of
    the hash, then by the whole hash inside the buckets that hold a rank.  At most
    65,536 counts for each label stand in the windows, however many rows it has.  The
    buckets (one for each label and fraction at most) and the thresholds are written, so
    Spark knows their size when it plans their joins with the rows: it sends them to the
    rows' tasks and does not deal the rows out by label, which few tasks would get.
    """
    fractions = [float(f) for f in fractions]
    h = df.select(F.col(label).alias("__l"), F.col(hash_col).alias("__h"),
                  F.shiftright(F.col(hash_col), 16).alias("__b"))
    run = Window.partitionBy("__l").orderBy("__b")
    asked = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in enumerate(fractions)]))
    top = (h.groupBy("__l", "__b").agg(F.count("*").alias("n"))
           .withColumns({"upto": F.sum("n").over(run), "total": F.sum("n").over(Window.partitionBy("__l"))})
           .withColumn("q", asked)
           .withColumn("rank", F.greatest(F.ceil(F.col("q.f") * F.col("total")) - 1, F.lit(0)))
           .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank")))
           .groupBy(F.col("__l").alias("tl"), F.col("__b").alias("tb")).agg(F.collect_list(F.struct(
               F.col("q.i").alias("i"), (F.col("rank") - F.col("upto") + F.col("n")).alias("left"))).alias("asked")))
    top = materialized(top, "hash-buckets")
    inside = h.join(top.select("tl", "tb"), F.col("__l").eqNullSafe(F.col("tl")) & (F.col("__b") == F.col("tb")), "left_semi")
    run = Window.partitionBy("__l", "__b").orderBy("__h")
    found = (inside.groupBy("__l", "__b", "__h").agg(F.count("*").alias("n")).withColumn("upto", F.sum("n").over(run))
             .join(top, F.col("__l").eqNullSafe(F.col("tl")) & (F.col("__b") == F.col("tb")))
             .withColumn("a", F.explode("asked"))
             .where(F.col("upto") > F.col("a.left"))
             .groupBy("__l", F.col("a.i").alias("i")).agg(F.min("__h").alias("t")))
    return (found.groupBy("__l").agg(F.array_sort(F.collect_list(F.struct("i", "t"))).alias("q"))
            .select(F.col("__l").alias("label"), F.col("q.t").alias("thresholds")))


def _with_thresholds(h: DataFrame, label: str, fractions: Sequence[float]) -> DataFrame:
    """Every row (hash in ``__h``) with the ``thresholds`` of its label; rows stay in their tasks (:func:`hash_thresholds`)."""
    t = hash_thresholds(h, label, "__h", fractions).withColumnRenamed("label", "__label")
    return h.join(materialized(t, "hash-thresholds"), F.col(label).eqNullSafe(F.col("__label")), "left").drop("__label")


def stratified_split(df: DataFrame, label: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, out: str = "split") -> DataFrame:
    """MOD-1: per label, exactly the rows whose hash is at or below the label's
    ``percentile_disc(test_fraction)`` of hashes go to ``test``.

    The thresholds of all labels come from two grouped counts; no label,
    however large, is gathered into one task.
    """
    j = _with_thresholds(df.withColumn("__h", hash_unit(id_col, seed)), label, [test_fraction])
    return (j.withColumn(out, F.when(F.col("__h") <= F.col("thresholds")[0], F.lit("test")).otherwise(F.lit("train")))
            .drop("__h", "thresholds"))


def fold_column(df: DataFrame, id_col: str, k: int, seed: int = 42, out: str = "fold",
                label: str | None = None) -> DataFrame:
    """Deterministic fold id 0..k-1 from the id hash; with ``label`` stratified.

    Stratified: the hash quantiles j/k of each label bound its folds, so every
    fold has the same share of each label (up to one row and hash ties).  All
    quantiles come from one histogram, and the rows meet them in one join.
    """
    if label is None:
        return df.withColumn(out, (hash_unit(id_col, seed + 1) % k).cast("int"))
    j = _with_thresholds(df.withColumn("__h", hash_unit(id_col, seed + 1)), label, [j / k for j in range(1, k)])
    passed = F.size(F.filter("thresholds", lambda x: F.col("__h") > x))
    return j.withColumn(out, F.greatest(passed, F.lit(0)).cast("int")).drop("__h", "thresholds")


def split_report(df: DataFrame, label: str, split: str = "split", digits: int = 6) -> DataFrame:
    """MOD-2 / AGG-10: rows and positive-label rate per split."""
    return (df.groupBy(split).agg(F.count("*").alias("rows"),
                                  F.round(F.avg(F.col(label).cast("double")), digits).alias("label_rate"))
            .orderBy(split))


#: Rows of a training task, and the rows that trees trained side by side hold together.
TASK_ROWS, SIDE_BY_SIDE = 250_000, 4_000_000


def fit_tree(df: DataFrame, features: Sequence[str], label: str, id_col: str,
             impurities: Sequence[str] = ("gini", "entropy"), depths: Sequence[int] = range(1, 7),
             folds: int = 5, seed: int = 42, max_bins: int = 32, parallelism: int = 4):
    """MOD-3/4: decision tree with a grid over impurity x depth, stratified k-fold CV on accuracy.

    ``df`` is the training part only.  A tree grows level by level and its depth limit
    only says where it stops: the tree of a smaller depth is the top of the deeper one.
    So one tree of the greatest depth is trained for each fold and impurity, and every
    grid point is scored, on the rows it was trained on and on those left out, from the
    counts of the leaves by fold and class (:func:`_scores`, one pass for all trees).
    The best point is then fitted to all rows.

    The rows are dealt out by their hash in tasks of ``TASK_ROWS`` and put in its order,
    so the trees do not depend on how the input lay.  ``parallelism`` trees are trained
    at a time while they hold ``SIDE_BY_SIDE`` rows together at most.
    """
    rows = df.count()
    data = fold_column(df.select(*dict.fromkeys([*features, label, id_col])), id_col, folds, seed, label=label)
    by = F.xxhash64(F.col(id_col), *[F.col(f"`{c}`") for c in features])
    data = (data.withColumn("__by", by).repartition(max(8, -(-rows // TASK_ROWS)), "__by").sortWithinPartitions("__by"))
    data = assemble(data, features).select("features", F.col(label).cast("double").alias("__label"), "fold")
    dt = DecisionTreeClassifier(featuresCol="features", labelCol="__label", seed=seed, maxBins=max_bins)
    grid = (ParamGridBuilder().addGrid(dt.impurity, list(impurities))
            .addGrid(dt.maxDepth, list(depths)).build())
    data = kept = data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        held = {r["fold"]: r["top"] for r in data.groupBy("fold").agg(F.max("__label").alias("top")).collect()}
        for f in range(folds):
            if f not in held or len(held) < 2:
                raise ValueError(f"The {'validation' if f not in held else 'training'} data at fold {f} is empty.")
        data = _with_classes(data, "__label", max((t for t in held.values() if t is not None), default=None))
        trees = [(f, i) for f in range(folds) for i in impurities]

        def deepest(tree):
            return dt.fit(data.where(F.col("fold") != tree[0]), {dt.impurity: tree[1], dt.maxDepth: max(depths)})

        with ThreadPool(max(1, min(parallelism, SIDE_BY_SIDE // max(rows, 1)))) as pool:
            models = pool.map(inheritable_thread_target(df.sparkSession)(deepest), trees, chunksize=1)
        scores = _scores(data, models, [f for f, _ in trees], list(depths))
        of = {(f, i, d): s for (f, i), by_depth in zip(trees, scores) for d, s in zip(depths, by_depth)}
        points = [[of[f, p[dt.impurity], p[dt.maxDepth]] for p in grid] for f in range(folds)]
        held_out = np.array([[s[1] for s in fold] for fold in points])
        metrics = np.mean(held_out, axis=0)
        best = dt.fit(data, grid[int(np.argmax(metrics))])
        model = CrossValidatorModel(best, metrics.tolist(), None, np.std(held_out, axis=0).tolist())
        model._train_metrics = [sum(fold[g][0] for fold in points) / folds for g in range(len(grid))]
    finally:
        kept.unpersist()
    return model, grid


def _with_classes(df: DataFrame, label: str, top: float | None) -> DataFrame:
    """The frame with the number of classes noted at the label (greatest label ``top`` plus one), as a string indexer does.

    Without the note every fit scans the labels for it.  Labels that Spark does not take for classes stay without.
    """
    if top is None or not (1 <= top < 100 and top == int(top)):
        return df
    note = {"ml_attr": {"type": "nominal", "name": label, "num_vals": int(top) + 1}}
    return df.withColumn(label, F.col(label).alias(label, metadata=note))


def _leaf_paths(model) -> list[str]:
    """The way from the root to each leaf, as L and R, in the order of the leaf numbers (left before right)."""
    paths, path = [], ""
    for line in model.toDebugString.splitlines()[1:]:
        text, level = line.lstrip(), len(line) - len(line.lstrip()) - 2  # the root is indented by two
        if text.startswith("Predict"):
            paths.append(path[:level])
        else:
            path = path[:level] + ("L" if text.startswith("If") else "R")
    return paths


def _scores(data: DataFrame, models: Sequence, left_out: Sequence[int], depths: Sequence[int]) -> list[list[tuple[float, float]]]:
    """(train, validation) accuracy of every tree cut to every depth; ``left_out``: the fold that a tree was not trained on.

    One pass counts the rows of each leaf by fold and class.  A node that a cut makes a
    leaf predicts, like any leaf, the class with most training rows (ties: the smallest).
    """
    scored = data
    for i, m in enumerate(models):
        m = m.copy().setLeafCol(f"leaf{i}").setPredictionCol("").setRawPredictionCol("").setProbabilityCol("")
        scored = m.transform(scored)
    leaves = F.array(*[F.struct(F.lit(i).alias("tree"), F.col(f"leaf{i}").cast("int").alias("leaf")) for i in range(len(models))])
    counts = (scored.select("fold", "__label", F.inline(leaves)).groupBy("tree", "leaf", "fold", "__label")
              .agg(F.count("*").alias("n")).collect())
    out = []
    for i, m in enumerate(models):
        paths, by_depth = _leaf_paths(m), []
        own = [(paths[r["leaf"]], r["fold"] != left_out[i], r["__label"], r["n"]) for r in counts if r["tree"] == i]
        for d in depths:
            node: dict = defaultdict(lambda: {True: defaultdict(int), False: defaultdict(int)})
            for path, train, y, n in own:
                node[path[:d]][train][y] += n
            right = {True: 0, False: 0}
            for c in node.values():
                best = max(sorted(c[True]), key=c[True].get)
                for train in right:
                    right[train] += c[train].get(best, 0)
            total = {t: sum(n for _, train, _, n in own if train == t) for t in right}
            by_depth.append((right[True] / total[True], right[False] / total[False]))
        out.append(by_depth)
    return out


def cv_results(spark, cv_model, grid) -> DataFrame:
    """MOD-4: (impurity, max_depth, train_accuracy, cv_accuracy, is_best) for every grid point (model metadata)."""
    best = max(range(len(grid)), key=lambda i: (cv_model.avgMetrics[i], -i))
    rows = []
    for i, (params, metric) in enumerate(zip(grid, cv_model.avgMetrics)):
        p = {k.name: v for k, v in params.items()}
        rows.append((p["impurity"], int(p["maxDepth"]), float(cv_model._train_metrics[i]), float(metric), i == best))
    return spark.createDataFrame(
        rows, "impurity string, max_depth int, train_accuracy double, cv_accuracy double, is_best boolean")


def predict(model, df: DataFrame, features: Sequence[str], out: str = "prediction") -> DataFrame:
    """MOD-5: add the predicted class."""
    m = getattr(model, "bestModel", model)
    res = m.transform(assemble(df, features))
    return res.withColumnRenamed("prediction", out).drop("features", "rawPrediction", "probability")


def prediction_counts(df: DataFrame, label: str, pred: str = "prediction") -> DataFrame:
    """MOD-6: rows per class, actual vs predicted, in one grouped pass.

    Each row is emitted twice by a generator (once tagged as its actual class,
    once as its predicted class) and one grouped count gives both columns.
    """
    tagged = df.select(F.inline(F.array(
        F.struct(F.col(label).cast("double").alias("class"), F.lit(1).alias("a"), F.lit(0).alias("p")),
        F.struct(F.col(pred).cast("double").alias("class"), F.lit(0).alias("a"), F.lit(1).alias("p")))))
    return (tagged.groupBy("class").agg(F.sum("a").cast("long").alias("actual"),
                                       F.sum("p").cast("long").alias("predicted"))
            .orderBy("class"))


def _cells(df: DataFrame, label: str, pred: str) -> dict[tuple, int]:
    """Rows per (actual, predicted) class: one grouped count, a row for each pair of classes that occurs."""
    got = df.groupBy(F.col(label).alias("a"), F.col(pred).alias("p")).agg(F.count("*").alias("n")).collect()
    return {(_class(r["a"]), _class(r["p"])): r["n"] for r in got}


def _class(v):
    """A class value as it is compared and shown: whole numbers of any type alike."""
    return int(v) if isinstance(v, (bool, float)) and v == int(v) else v


def _classes(cells: dict[tuple, int], given: Sequence | None) -> list:
    """The given classes, then all others that occur, null last: no row is left out."""
    first = list(dict.fromkeys(_class(c) for c in given or []))
    rest = {c for pair in cells for c in pair} - set(first)
    return first + sorted(rest, key=lambda c: (c is None, isinstance(c, str), c if c is not None else 0))


def confusion_matrix(df: DataFrame, label: str, pred: str = "prediction",
                     classes: Sequence | None = None) -> DataFrame:
    """MOD-7: (actual, predicted, n) over the full class grid (missing cells are 0).

    Classes may be of any type.  A class that is not in ``classes``, and null,
    gets a row and a column of its own.
    """
    cells = _cells(df, label, pred)
    names = _classes(cells, classes)
    kind = "string" if any(isinstance(c, str) for c in names) else "int"
    shown = [None if c is None else (str(c) if kind == "string" else c) for c in names]
    rows = [(x, y, cells.get((a, p), 0)) for a, x in zip(names, shown) for p, y in zip(names, shown)]
    return df.sparkSession.createDataFrame(rows, f"actual {kind}, predicted {kind}, n long")


def classification_report(df: DataFrame, label: str, pred: str = "prediction",
                          classes: Sequence | None = None, digits: int = 6) -> DataFrame:
    """MOD-8: precision, recall, f1, support per class, then accuracy, macro and weighted avg.

    Arithmetic on one grouped count (0 when a divisor is 0).  Every row counts:
    classes that are not in ``classes``, and null (shown as ``null``), have their own line.
    """
    cells = _cells(df, label, pred)
    names = _classes(cells, classes)
    n = sum(cells.values())
    out, tp_all = [], 0
    for c in names:
        tp = cells.get((c, c), 0)
        sup = sum(v for (a, _), v in cells.items() if a == c)
        said = sum(v for (_, p), v in cells.items() if p == c)
        prec, rec = (tp / said if said else 0.0), (tp / sup if sup else 0.0)
        out.append((("null" if c is None else str(c)), prec, rec, 2 * prec * rec / (prec + rec) if prec + rec else 0.0, sup))
        tp_all += tp
    k = max(len(out), 1)
    mean = [sum(r[i] for r in out) / k for i in (1, 2, 3)]
    weighted = [sum(r[i] * r[4] for r in out) / n if n else 0.0 for i in (1, 2, 3)]
    out += [("accuracy", None, None, tp_all / n if n else 0.0, n), ("macro avg", *mean, n), ("weighted avg", *weighted, n)]
    rows = [(c, *[None if x is None else round(x, digits) for x in v], s) for c, *v, s in out]
    return df.sparkSession.createDataFrame(rows, "class string, precision double, recall double, f1 double, support long")


def feature_importances(spark, model, names: Sequence[str], k: int = 10) -> DataFrame:
    """MOD-9: top-k feature importances of a fitted tree (model metadata, k rows)."""
    m = getattr(model, "bestModel", model)
    imp = m.featureImportances.toArray().tolist()
    rows = sorted(zip(names, [float(x) for x in imp]), key=lambda r: (-r[1], r[0]))[:k]
    return spark.createDataFrame(rows, "feature string, importance double")


def tree_rules(spark, model) -> DataFrame:
    """MOD-10: the fitted tree as text lines."""
    m = getattr(model, "bestModel", model)
    lines = m.toDebugString.splitlines()
    return spark.createDataFrame(list(enumerate(lines)), "line_no int, rule string")


_LINE = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>|in|not in) (.+)\)$")
_LEAF = re.compile(r"^( *)Predict: (\S+)$")


def tree_nodes(model, names: Sequence[str]) -> list[tuple]:
    """(node, parent, depth, feature, threshold, left, right, prediction) of a fitted tree of continuous features.

    Read from the tree's printed form, whose numbers keep all digits.  Rows with
    ``feature`` at most ``threshold`` go left; leaves have a prediction instead.
    """
    m = getattr(model, "bestModel", model)
    nodes: list[list] = []
    open_: list[int] = []  # nodes whose right side is still to come, innermost last
    parent, side = None, None

    def add(depth: int) -> list:
        node = [len(nodes), parent, depth, None, None, None, None, None]
        nodes.append(node)
        if parent is not None:
            nodes[parent][5 if side == "left" else 6] = node[0]
        return node

    for line in m.toDebugString.splitlines()[1:]:
        leaf, test = _LEAF.match(line), _LINE.match(line)
        if leaf:
            add(0 if parent is None else nodes[parent][2] + 1)[7] = float(leaf.group(2))
        elif test and test.group(2) == "If":
            if test.group(4) != "<=":
                raise ValueError("only continuous features have thresholds")
            node = add(0 if parent is None else nodes[parent][2] + 1)
            node[3], node[4] = names[int(test.group(3))], float(test.group(5))
            open_.append(node[0])
            parent, side = node[0], "left"
        elif test:
            parent, side = open_.pop(), "right"
    return [tuple(n) for n in nodes]


TREE_SCHEMA = ("node int, parent int, depth int, feature string, threshold double, left_node int, right_node int, "
               "prediction double")


def tree_table(spark, model, names: Sequence[str]) -> DataFrame:
    """MOD-10: the fitted tree as a table, one row for each node (model metadata)."""
    return spark.createDataFrame(tree_nodes(model, names), TREE_SCHEMA)


def tree_expression(nodes: Sequence[tuple]) -> str:
    """MOD-10: SQL expression of the tree's prediction, for any engine; nodes as in :func:`tree_nodes` or the table's rows.

    NaN is greater than every threshold, as in the tree; a null feature gives null.
    """
    by_id = {n[0]: n for n in nodes}

    def term(i: int) -> str:
        _, _, _, feature, threshold, left, right, prediction = by_id[i]
        if feature is None:
            return f"{prediction!r}D"
        return (f"CASE WHEN `{feature}` IS NULL THEN NULL WHEN CAST(`{feature}` AS DOUBLE) <= {threshold!r}D "
                f"THEN {term(left)} ELSE {term(right)} END")
    return term(0)


def rebalance(df: DataFrame, label: str, id_col: str, target_rate: float,
              positive=1, seed: int = 42) -> DataFrame:
    """MOD-11: down-sample the majority class so positives make ``target_rate`` of the rows.

    Keep fractions come from one grouped count; rows are kept by an id hash,
    so the sample is deterministic and needs no shuffle.
    """
    c = dict(df.groupBy(F.col(label).eqNullSafe(F.lit(positive)).alias("pos")).count().collect())
    pos, neg = c.get(True, 0), c.get(False, 0)
    if pos == 0 or neg == 0:
        return df
    want_neg = pos * (1 - target_rate) / target_rate
    want_pos = neg * target_rate / (1 - target_rate)
    keep_neg = min(1.0, want_neg / neg)
    keep_pos = min(1.0, want_pos / pos) if keep_neg >= 1.0 else 1.0
    u = hash_unit(id_col, seed) / F.lit(float(1 << 32))
    is_pos = F.col(label).eqNullSafe(F.lit(positive))
    return df.where(F.when(is_pos, u < F.lit(keep_pos)).otherwise(u < F.lit(keep_neg)))
