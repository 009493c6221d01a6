"""Mixing sources to target weights by hash-threshold histograms (native).

Every row has a 60-bit hash of its id.  For each source the words are summed by
the leading hash digits; the bucket in which the running sum passes the budget
is the boundary, everything below it is in, and only the boundary bucket is read
again with the next digits, until it is the one row (or group of rows with one
hash) that does not fit.  That row is left out, and the budget still open is
filled behind it in the same way with rows that fit into it, ``ROUNDS`` times in
all, so a large row at the boundary does not leave a large gap.  The first
thresholds are nested: a larger budget keeps what a smaller one kept.  Nothing
is sorted; the largest table beside the rows is (sources x 4096 buckets).

Defined cases
* null text or no word: size 0, taken 0; null source: one source, last in order;
* null id: the text stands in for it; rows with the same id (or both null and
  the same text) share a hash, so they enter or stay out together;
* a source takes at most its target; what stays open is less than the smallest
  row that the last round left out;
* empty table: empty result; further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_key, n_words, scratch, small_side

HEX_PER_LEVEL = 3
LEVELS = 5
HASH_HEX = HEX_PER_LEVEL * LEVELS
ROUNDS = 3
END = "g"  # after every hash


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """Target words per source: (source, source_size, target).

    Sources ordered by code point (null last) take the weights in turn and share
    the whole corpus; a target stops at ``cap`` times its source's size and the
    excess is shared again by weight.  That is the water level ``level`` with
    target = min(cap * size, level * weight), found by one running sum over the
    sources (one row each).
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.array(*[F.lit(int(x)) for x in weights])
    s = (sizes.withColumn("rank", F.row_number().over(order))
         .withColumn("weight", F.element_at(w, (F.col("rank") - 1) % len(weights) + 1))
         .withColumn("most", F.col("source_size") * cap))
    before = Window.orderBy(F.col("most") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = (s.withColumn("capped", F.coalesce(F.sum("most").over(before), F.lit(0)))
         .withColumn("used", F.coalesce(F.sum("weight").over(before), F.lit(0)))
         .withColumn("total", F.sum("source_size").over(everything))
         .withColumn("weights", F.sum("weight").over(everything))
         .withColumn("at", (F.col("total") - F.col("capped")).cast("double")
                     / (F.col("weights") - F.col("used")).cast("double"))
         .withColumn("fits", F.col("at") * F.col("weight") <= F.col("most"))
         .withColumn("level", F.min(F.when(F.col("fits"), F.struct(F.col("used"), F.col("at"))))
                     .over(everything)["at"]))
    return s.select("source", "source_size", F.least(
        F.col("most").cast("double"), F.coalesce(F.col("level"), F.lit(0.0)) * F.col("weight")).alias("target"))


def _lead(bound: str) -> Column:
    """The digits of h that a bound has."""
    return F.expr(f"substring(h, 1, length({bound}))")


def _open_to(after: str, cap: str) -> Column:
    """Whether a row lies behind the bound ``after`` and fits into ``cap``."""
    return ((F.col(after) == "") | (_lead(after) > F.col(after))) & (F.col("size") <= F.col(cap))


def _boundary(rows: DataFrame, state: DataFrame) -> DataFrame:
    """``state`` with ``stop``: leading digits of the first hash that does not fit into ``need``, and ``below``: words before it.

    ``state``: a row for each source with ``need``, ``after`` and ``cap``.
    """
    state = scratch(state.withColumns({"stop": F.lit(""), "below": F.lit(0).cast("long"), "open": F.lit(True)}), "mix-state")
    for level in range(LEVELS):
        done = level * HEX_PER_LEVEL
        s = small_side(state.where("open").select(F.col("source").alias("_s"), "stop", "after", "cap"))
        bucket = F.substring("h", 1, done + HEX_PER_LEVEL)
        hist = (rows.join(s, rows["source"].eqNullSafe(F.col("_s")) & (F.substring("h", 1, done) == F.col("stop")))
                .where(_open_to("after", "cap")).groupBy("source", bucket.alias("bucket"))
                .agg(F.sum("size").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi")))
        run = Window.partitionBy("source").orderBy("bucket")
        hist = (hist.withColumn("upto", F.sum("n").over(run))
                .select(F.col("source").alias("_s"), "bucket", "n", "upto", (F.col("lo") == F.col("hi")).alias("one")))
        j = state.join(hist, state["source"].eqNullSafe(hist["_s"]) & F.col("open"), "left")
        passed = F.col("below") + F.col("upto") > F.col("need")
        found = j.groupBy(*[F.col(c) for c in state.columns]).agg(
            F.min(F.when(passed, F.struct("bucket", "n", "upto", "one"))).alias("b"), F.max("upto").alias("all"))
        hit = F.col("b.bucket").isNotNull()
        rest = [c for c in state.columns if c not in ("stop", "below", "open")]
        last = F.col("b.one") | F.lit(level == LEVELS - 1)
        state = scratch(found.select(
            *rest,
            # everything fits: the bound lies after the last hash
            F.when(~F.col("open"), F.col("stop")).when(hit, F.col("b.bucket")).otherwise(F.lit(END)).alias("stop"),
            (F.col("below") + F.when(~F.col("open"), 0).when(hit, F.col("b.upto") - F.col("b.n"))
             .otherwise(F.coalesce("all", F.lit(0)))).alias("below"),
            F.when(F.col("open") & hit, ~last).otherwise(F.lit(False)).alias("open")), "mix-state")
        if state.where("open").isEmpty():
            break
    return state.drop("open")


def thresholds(rows: DataFrame, plan: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Hash thresholds per source: (source, source_size, target, whole, after1, cap1, stop1, ...).

    ``rows``: (source, h, size) kept as a table; ``plan``: (source, source_size,
    target).  ``whole`` copies of every row fit into the target; a row takes one
    more if, for one of the rounds, it lies between ``after`` and ``stop`` and its
    size is ``cap`` at most.
    """
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = (plan.withColumn("whole", whole.cast("long"))
             .withColumn("need", F.col("target") - F.col("whole") * F.col("source_size"))
             .withColumn("after", F.lit("")).withColumn("cap", F.lit(float("inf"))))
    for k in range(1, rounds + 1):
        found = _boundary(rows, state)
        open_ = F.col("need") - F.col("below")
        state = found.withColumns({f"after{k}": F.col("after"), f"cap{k}": F.col("cap"), f"stop{k}": F.col("stop"),
                                   "need": open_, "after": F.col("stop"), "cap": open_}).drop("stop", "below")
    return scratch(state.drop("need", "after", "cap"), "mix-thresholds")


def hashed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           seed: str = "mix") -> DataFrame:
    """(id, source, size, h) of every row; h: 15 hex digits."""
    i, t = F.col(id_col), F.col(text_col)
    return docs.select(i.alias("id"), F.col(source_col).alias("source"), n_words(t).alias("size"),
                       F.substring(F.md5(F.concat(F.lit(seed), id_key(i, t))), 1, HASH_HEX).alias("h"))


def _copies(rounds: int = ROUNDS) -> Column:
    extra = F.lit(False)
    for k in range(1, rounds + 1):
        extra = extra | (_open_to(f"after{k}", f"cap{k}") & (_lead(f"stop{k}") < F.col(f"stop{k}")))
    return (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("long")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """One row per row of ``docs``: id, source, size, source_size, target, copies, taken."""
    rows = scratch(hashed(docs, id_col, text_col, source_col), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = thresholds(rows, targets(sizes, weights, cap))
    s = small_side(state).withColumnRenamed("source", "_s")
    out = rows.join(s, rows["source"].eqNullSafe(F.col("_s"))).withColumn("copies", _copies())
    return out.select("id", "source", "size", "source_size", "target", "copies",
                      (F.col("size") * F.col("copies")).alias("taken"))


def resample(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: Sequence[int] = (1, 2, 3), cap: int = 3) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (not at all: gone).

    The rows keep their columns and are not shuffled: the thresholds are joined
    by source and tested on each row's hash.
    """
    rows = scratch(hashed(docs, id_col, text_col, source_col), "mix-rows")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    state = thresholds(rows, targets(sizes, weights, cap))
    names = docs.columns
    i, t = F.col("r." + id_col), F.col("r." + text_col)
    s = small_side(state.drop("source_size", "target"))
    wide = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("r"))
    wide = wide.withColumn("size", n_words(t)).withColumn("h", F.substring(F.md5(F.concat(F.lit("mix"), id_key(i, t))), 1, HASH_HEX))
    out = wide.join(s, F.col("r." + source_col).eqNullSafe(F.col("source"))).withColumn("copies", _copies())
    out = out.where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return out.select([F.col(f"r.`{c}`").alias(c) for c in names])
