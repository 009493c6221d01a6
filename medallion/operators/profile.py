"""Profiling operators (null counts, frequencies, ranges, summaries, correlations).

Every profile is one or two aggregates over the input: partial aggregation runs
map-side, so a hot value or column never reaches a single task whole.  Results
are small DataFrames (one row per column or per group).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators import stats
from medallion.operators.keys import digest

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def schema_report(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """PRF-1: one row per column: position, column, type, nullable (schema metadata only)."""
    spark = spark or df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRF-2: one row, one null count per column."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def null_counts_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRF-3: (column_name, null_count) ordered by count desc, then name."""
    cols = list(cols or df.columns)
    wide = null_counts(df, cols)
    return (wide.unpivot([], cols, "column_name", "null_count")
            .orderBy(F.desc("null_count"), "column_name"))


def value_counts(df: DataFrame, col: str, order: str = "count", normalize: bool = False,
                 out: str = "count") -> DataFrame:
    """PRF-4: frequency of each value; null is kept as its own group.

    ``normalize`` adds ``share`` = count / total rows; the total is a scalar
    subquery (a count without columns, answered from file footers where the
    source has them), so groups are never gathered in one task.
    """
    g = df.groupBy(col).agg(F.count("*").alias(out))
    if normalize:  # one row, evaluated once
        g = g.withColumn("share", F.col(out) / df.agg(F.count("*")).scalar())
    if order == "count":
        return g.orderBy(F.desc(out), F.asc_nulls_first(col))
    return g.orderBy(F.asc_nulls_first(col))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """PRF-17: label counts and shares."""
    return value_counts(df, label, order="value", normalize=True)


def distinct_sample(df: DataFrame, col: str, n: int = 20) -> DataFrame:
    """PRF-5: the first ``n`` distinct values in order (a top-k report)."""
    return df.select(col).distinct().orderBy(F.asc_nulls_first(col)).limit(n)


def preview(df: DataFrame, n: int = 20, cols: Sequence[str] | None = None) -> DataFrame:
    """PRF-13: a bounded peek."""
    return (df.select(*cols) if cols else df).limit(n)


def numeric_ranges(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """PRF-7: (column_name, min_value, max_value) in one aggregate."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        # "+ 0.0" folds -0.0 into 0.0 so equal extremes print alike
        aggs += [(F.min(F.col(c).cast("double")) + F.lit(0.0)).alias(f"{c}__min"),
                 (F.max(F.col(c).cast("double")) + F.lit(0.0)).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(f"{c}__min").alias("min_value"),
                      F.col(f"{c}__max").alias("max_value")) for c in cols]
    return wide.select(F.inline(F.array(*pairs)))


def summary(df: DataFrame, cols: Sequence[str] | None = None, method: str = "cont",
            digits: int = 6) -> DataFrame:
    """PRF-6: one line per column: count, unique, top, freq; for numbers mean, std, min, quartiles, max too.

    All columns are described: a number's most frequent value is in ``top``, that
    of any other column, as text, in ``top_text`` (ties: the smallest).  Figures
    that do not apply are null; std and quartiles are rounded to ``digits``, the mean to one digit more.

    Counts and moments of all columns are one wide aggregate.  The values are
    unpivoted once and counted by (column, value) for unique, top and freq.
    Quartiles come from :func:`stats.quantiles` as literals.
    """
    cols = list(cols or df.columns)
    numbers = [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC)]
    v = {c: F.col(c).cast("double") for c in numbers}
    v = {c: F.when(~F.isnan(x), x) for c, x in v.items()}
    narrow = df.select(*[(v[c] if c in v else F.col(c).cast("string")).alias(c) for c in cols])
    q = stats.quantiles(narrow, numbers, [0.25, 0.5, 0.75], method=method) if numbers else {}
    aggs = []
    for i, c in enumerate(cols):
        aggs.append(F.count(F.col(c)).alias(f"n{i}"))
        if c in v:
            aggs += [F.round(F.avg(c), digits + 1).alias(f"mean{i}"), F.round(F.stddev_samp(c), digits).alias(f"std{i}"),
                     (F.min(c) + F.lit(0.0)).alias(f"min{i}"), (F.max(c) + F.lit(0.0)).alias(f"max{i}")]
    none = F.lit(None).cast("double")

    def quart(c: str, k: int) -> Column:
        x = q[c][k] if c in q else None
        return F.lit(None if x is None else round(float(x), digits)).cast("double")
    lines = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("count"),
                      *[(F.col(f"{m}{i}") if c in v else none).alias(m) for m in ("mean", "std", "min", "max")],
                      *[quart(c, k).alias(f"q{p}") for k, p in enumerate((25, 50, 75))]) for i, c in enumerate(cols)]
    moments = narrow.agg(*aggs).select(F.inline(F.array(*lines)))
    cells = [F.struct(F.lit(c).alias("column_name"), (F.col(c) if c in v else none).alias("v"),
                      (F.lit(None).cast("string") if c in v else F.col(c)).alias("t")) for c in cols]
    freq = (narrow.select(F.inline(F.array(*cells))).where("v is not null or t is not null")
            .groupBy("column_name", "v", "t").agg(F.count("*").alias("n")))
    best = F.min(F.struct(-F.col("n"), F.col("v"), F.col("t")))
    tops = (freq.groupBy("column_name").agg(F.count("*").alias("unique"), best.alias("b"), F.max("n").alias("freq"))
            .select("column_name", "unique", F.col("b.v").alias("top"), F.col("b.t").alias("top_text"), "freq"))
    return (moments.join(tops, "column_name", "left")
            .select("column_name", "count", F.coalesce("unique", F.lit(0)).alias("unique"), "top", "top_text", "freq",
                    "mean", "std", "min", "q25", "q50", "q75", "max"))


#: Items that a heavy-hitter sketch tracks; a column with half as many distinct values is described exactly.
TRACKED = 1024
#: Binary logarithm of the registers of a distinct-count sketch.
LG_K = 14


def summary_sketch(df: DataFrame, cols: Sequence[str] | None = None, tracked: int = TRACKED, lg_k: int = LG_K,
                   quartiles: str = "approx", digits: int = 6) -> DataFrame:
    """PRF-6, approximate: :func:`summary` from mergeable sketches; no value of any column is shuffled.

    One wide aggregate of every column: moments, a HyperLogLog sketch of the values
    (``unique``) and a heavy-hitter sketch of ``tracked`` items (``top``, ``freq``).
    Tasks send their sketches, whose size does not depend on the rows.  Text is
    sketched by its MD5, so long texts cost no memory; the text behind a column's
    top digest is then fetched by one more aggregate (a minimum over the rows with
    that digest).

    ``exact`` says that the sketches lost nothing: the tracked counts add up to all
    rows and fill half of the sketch at most.  Then ``unique``, ``top`` (ties: the
    smallest value) and ``freq`` equal those of :func:`summary`.  Otherwise
    ``unique`` is an estimate that lies within [``unique_low``, ``unique_high``] (three
    standard errors of 1.04 / sqrt(2^lg_k)) and ``top`` the item with the greatest
    estimate, whose true count lies within [``freq_low``, ``freq``] (the sketch's
    error is 3.5 / map size of the rows); no such item: null.

    Quartiles are those of a bounded rank sketch, or exact with ``quartiles="cont"``.
    NaN and null are missing.
    """
    cols = list(cols or df.columns)
    numbers = [c for c in cols if isinstance(df.schema[c].dataType, NUMERIC)]
    cell = {c: F.col(f"`{c}`").cast("double") if c in numbers else F.col(f"`{c}`").cast("string") for c in cols}
    narrow = df.select(*[(F.when(~F.isnan(x), x + F.lit(0.0)) if c in numbers else x).alias(c) for c, x in cell.items()])
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`")
        item = x if c in numbers else F.md5(x)
        keyed = F.xxhash64(item)  # the distinct-count sketch takes no doubles
        aggs += [F.count(x).alias(f"n{i}"),
                 F.hll_sketch_estimate(F.hll_sketch_agg(F.when(x.isNotNull(), keyed), lg_k)).alias(f"u{i}"),
                 F.call_function("approx_top_k", item, F.lit(tracked + 1), F.lit(tracked + 1)).alias(f"t{i}")]
        if c in numbers:
            aggs += [F.round(F.avg(x), digits + 1).alias(f"mean{i}"), F.round(F.stddev_samp(x), digits).alias(f"std{i}"),
                     F.min(x).alias(f"min{i}"), F.max(x).alias(f"max{i}")]
    row = narrow.agg(*aggs).first()
    q = stats.quantiles(narrow, numbers, [0.25, 0.5, 0.75], method=quartiles) if numbers else {}
    slots = 1 << max(3, int((tracked + 1) / 0.75) - 1).bit_length()
    found, leading = {}, {}
    for i, c in enumerate(cols):
        n, items = int(row[f"n{i}"]), {r["item"]: int(r["count"]) for r in row[f"t{i}"] or () if r["item"] is not None}
        exact = sum(items.values()) == n and 2 * len(items) <= tracked
        freq = max(items.values(), default=None)
        seen = sum(int(r["count"]) for r in row[f"t{i}"] or () if r["item"] is None) + n  # null is an item there
        error = 0 if exact else math.ceil(3.5 * seen / slots)
        spread = 0.0 if exact else 3 * 1.04 / (1 << lg_k) ** 0.5
        unique = len(items) if exact else int(row[f"u{i}"] or 0)
        leading[c] = sorted(k for k, v in items.items() if v == freq)
        found[c] = (n, unique, math.floor(unique * (1 - spread)), math.ceil(unique * (1 + spread)), freq,
                    None if freq is None else max(freq - error, 0), exact)
    texts = [c for c in cols if c not in numbers and leading[c]]
    named = {}
    if texts:  # one row
        named = narrow.agg(*[F.min(F.when(F.md5(F.col(f"`{c}`")).isin(leading[c]), F.col(f"`{c}`"))).alias(c)
                             for c in texts]).first().asDict()
    rows = []
    for i, c in enumerate(cols):
        n, unique, low, high, freq, least, exact = found[c]
        quarts = [None if x is None else round(float(x), digits) for x in q.get(c, (None,) * 3)]
        moments = [row[f"{m}{i}"] if c in numbers else None for m in ("mean", "std", "min")]
        rows.append((c, n, unique, low, high, leading[c][0] if c in numbers and leading[c] else None, named.get(c), freq,
                     least, exact, *moments, *quarts, row[f"max{i}"] if c in numbers else None))
    return df.sparkSession.createDataFrame(
        rows, "column_name string, count long, unique long, unique_low long, unique_high long, top double, top_text string, "
              "freq long, freq_low long, exact boolean, mean double, std double, min double, q25 double, q50 double, "
              "q75 double, max double")


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int | None = None,
                   out: str = "repetitions") -> DataFrame:
    """PRF-11: keys that occur more than once, most repeated first (HAVING + top-k).

    Counted by a digest, so long keys are not shuffled; only rows whose digest
    repeats are grouped by the keys themselves.
    """
    keys = list(keys)
    d = df.select(*keys, *digest(keys))
    again = d.groupBy("__d0", "__d1").agg(F.count("*").alias("__n")).where("__n > 1").drop("__n")
    g = (d.join(again, ["__d0", "__d1"], "left_semi").groupBy(*keys).agg(F.count("*").alias(out))
         .where(F.col(out) > 1).orderBy(F.desc(out), *keys))
    return g.limit(limit) if limit else g


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None,
                   out: str = "duplicate_rows") -> DataFrame:
    """PRF-12: number of rows that repeat an earlier identical row (rows compared by a 128-bit digest)."""
    g = df.select(*digest(list(cols or df.columns))).groupBy("__d0", "__d1").agg(F.count("*").alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias(out))


def corr_matrix(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6,
                diagonal: bool = False) -> DataFrame:
    """PRF-14: Pearson correlation of each column pair (a before b), one aggregate."""
    cols = list(cols or numeric_columns(df))
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + (0 if diagonal else 1):]]
    aggs = [F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
            for i, (a, b) in enumerate(pairs)]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"),
                     F.round(F.col(f"p{i}"), digits).alias("r"))
            for i, (a, b) in enumerate(pairs)]
    return wide.select(F.inline(F.array(*rows)))


def label_correlations(df: DataFrame, label: str, cols: Sequence[str] | None = None,
                       digits: int = 6) -> DataFrame:
    """PRF-15: correlation of every feature with the label, strongest first."""
    cols = [c for c in (cols or numeric_columns(df)) if c != label]
    aggs = [F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(f"p{i}")
            for i, c in enumerate(cols)]
    rows = [F.struct(F.lit(c).alias("feature"), F.round(F.col(f"p{i}"), digits).alias("r"))
            for i, c in enumerate(cols)]
    return (df.agg(*aggs).select(F.inline(F.array(*rows)))
            .orderBy(F.desc(F.abs("r")), "feature"))


def corr_gram(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """PRF-14 for many columns: Pearson correlation of each pair (a before b) from one Gram matrix.

    The columns become one vector; each task sums the products of its rows into one
    matrix and the matrices are added up a tree, so the plan is the same for ten and
    for a thousand columns (:func:`corr_matrix` has k(k-1)/2 aggregates).  Rows with a
    null or NaN in any of the columns are left out (listwise); a constant column has
    no correlation (null).  The matrix, columns x columns, goes through the driver.
    """
    names, m = _gram(df, list(cols or numeric_columns(df)), digits)
    rows = [(a, b, m[i][j]) for i, a in enumerate(names) for j, b in enumerate(names) if i < j]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def label_gram(df: DataFrame, label: str, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """PRF-15 for many columns: correlation of every feature with the label, strongest first, null last."""
    names, m = _gram(df, [c for c in (cols or numeric_columns(df)) if c != label] + [label], digits)
    rows = sorted(((a, m[i][-1]) for i, a in enumerate(names[:-1])), key=lambda r: (r[1] is None, -abs(r[1] or 0), r[0]))
    return df.sparkSession.createDataFrame(rows, "feature string, r double")


def _gram(df: DataFrame, names: list[str], digits: int) -> tuple[list[str], list[list[float | None]]]:
    """(names, correlations)."""
    narrow = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    narrow = narrow.where(" AND ".join(f"c{i} IS NOT NULL AND NOT isnan(c{i})" for i in range(len(names))))
    if narrow.isEmpty():
        return names, [[None] * len(names) for _ in names]
    vectors = VectorAssembler(inputCols=narrow.columns, outputCol="v").transform(narrow).select("v")
    m = Correlation.corr(vectors, "v").first()[0].toArray()
    return names, [[None if x != x else round(float(x), digits) + 0.0 for x in line] for line in m]


class StageAudit:
    """PRF-10: rows in/out per cleaning stage, collected with ``observe``.

    Each stage's row count is gathered by the job that consumes the data anyway,
    so auditing costs no extra scan.
    """

    def __init__(self):
        self.stages: list[tuple[str, Observation]] = []

    def mark(self, df: DataFrame, name: str) -> DataFrame:
        obs = Observation(name)
        self.stages.append((name, obs))
        return df.observe(obs, F.count(F.lit(1)).alias("rows"))

    def report(self) -> list[tuple[str, int, int]]:
        """(stage, rows, removed vs previous stage) once an action has run."""
        out, prev = [], None
        for name, obs in self.stages:
            rows = obs.get.get("rows", 0)
            out.append((name, rows, 0 if prev is None else prev - rows))
            prev = rows
        return out
