"""Deduplication and dense surrogate keys (DED-*, WIN-1)."""
from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel


def digest(cols: Sequence[str]) -> list[Column]:
    """A 128-bit key for the values of the columns, as two longs; null is a value of its own, -0.0 is 0.0."""
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(*parts).alias("__d0"), F.xxhash64(F.lit("second"), *parts).alias("__d1")]


#: Types whose minimum is kept in place by a hash aggregate.
_PLAIN = (T.BooleanType, T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def winners(df: DataFrame, keys: Sequence[str], order: Sequence = (), keep: str = "first") -> DataFrame:
    """One row of each key: that with the smallest (``first``) or largest (``last``) order; null order values never win.

    The choice is made on narrow rows and the wide ones are fetched late.  A hash
    aggregate counts the rows of each key digest (two longs, whatever the keys),
    with the best value of a single plain order column; only keys with several rows
    are kept, most tables have few of these.  Rows of other keys pass through an
    anti join, the rows of the kept keys (their best ones) through an equi-join.
    The kept keys are written first, so both joins are planned from their size: where
    keys rarely repeat they are sent to the rows' tasks and no wide row is shuffled
    (an exchange of the rows would be made beside that of the keys, before their
    size is measured).  The rest is ranked by (order, row hash): each task
    cuts its rows to one a key before they meet, so a key with a third of all rows
    is reduced where it lies.  The input is read three times: one that is expensive
    to compute should be written first.
    """
    from medallion.session import materialized

    keys, names = list(keys), df.columns
    cols = [F.col(o) if isinstance(o, str) else o for o in order]
    plain = len(cols) == 1 and isinstance(df.select(cols[0]).schema[0].dataType, _PLAIN)
    keyed = df.select("*", *digest(keys), (cols[0] if plain else F.lit(0)).alias("__o"))
    again = (keyed.select("__d0", "__d1", "__o").groupBy("__d0", "__d1")
             .agg(F.count("*").alias("__n"), (F.min if keep == "first" else F.max)("__o").alias("__best"))
             .where("__n > 1").drop("__n"))
    again = materialized(again, "repeated-keys")
    alone = keyed.join(again, ["__d0", "__d1"], "left_anti").select(*names)
    tied = keyed.join(again, ["__d0", "__d1"]).where(F.col("__o").eqNullSafe(F.col("__best")))
    ranked = [c.asc_nulls_last() if keep == "first" else c.desc_nulls_last() for c in cols]
    first = Window.partitionBy("__d0", "__d1").orderBy(*ranked, F.xxhash64(*_flagged(names)))
    one = tied.withColumn("__k", F.row_number().over(first)).where("__k = 1").select(*names)
    return alone.unionByName(one)


def _flagged(cols: Sequence[str]) -> list[Column]:
    """The columns with their null flags: equal hashes then stand for equal rows, not for shifted nulls."""
    return [x for c in cols for x in (F.col(c).isNull(), F.col(c))]


def dedupe(df: DataFrame, keys: Sequence[str] | None = None, order: Sequence | None = None,
           keep: str = "first", ignore: Sequence[str] | None = None) -> DataFrame:
    """DED-1/2/3: remove duplicates.

    * no keys: exact-row dedupe (``ignore`` leaves columns such as a surrogate
      key out of the comparison; one arbitrary row of each group survives);
    * keys without order: one row per key (the smallest row hash);
    * keys with order: the row with the smallest (``keep="first"``) or largest
      order survives (null order values never win; ties go to the smallest row
      hash).

    The rows are compared by a 128-bit digest and fetched late (:func:`winners`).
    """
    if keys is None:
        return winners(df, [c for c in df.columns if c not in set(ignore or ())])
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if order is not None and len(others) == 1 and list(order) == others:
        # the survivor's only other column is the order itself: a hash-aggregated min/max
        agg = F.min if keep == "first" else F.max
        return df.groupBy(*keys).agg(agg(others[0]).alias(others[0])).select(*df.columns)
    return winners(df, keys, order or (), keep)


def resequence(df: DataFrame, order: Sequence[str], out: str = "seq", start: int = 1,
               partitions: int | None = None, path: str | None = None,
               tiebreak: bool = True) -> DataFrame:
    """WIN-1: dense key ``start..start+n-1`` following ``order`` (nulls first).

    Instead of an unpartitioned ``row_number()`` (which moves every row to one
    task) the rows are range-partitioned on ``order`` (include a unique
    tiebreak so even a hot key value is split across partitions), sorted within
    partitions and written once, with their partition id and in-partition
    position, as a Parquet table under the shared checkpoint folder.  The
    written table fixes the partitioning, so nothing depends on a second
    evaluation of the range sampling and lost executors are harmless.
    Per-partition row counts (one number per partition, read from two small
    columns) give each partition its offset; no shuffle follows.  With
    ``tiebreak`` a row hash extends the order, so rows with equal keys are
    numbered in a fixed order and a hot key value is split across partitions
    (rows that tie on the hash as well are identical).
    """
    from medallion.session import scratch_path

    order = list(order)
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or scratch_path(spark, f"resequence-{uuid.uuid4().hex}")
    ordering = [F.asc_nulls_first(c) for c in order]
    if tiebreak:
        ordering.append(F.asc(F.xxhash64(*_flagged(df.columns))))
    # the range sampling pass and the write pass both read the input: keep it
    # (memory and disk; lost blocks are recomputed from the lineage)
    src = df.persist(StorageLevel.MEMORY_AND_DISK)
    (src.repartitionByRange(n, *ordering).sortWithinPartitions(*ordering)
     .withColumn("__pid", F.spark_partition_id())
     .withColumn("__pos", F.monotonically_increasing_id()
                 - F.spark_partition_id().cast("long") * F.lit(1 << 33))
     .write.mode("errorifexists").parquet(path))
    src.unpersist()
    fixed = spark.read.parquet(path)
    counts = dict(fixed.groupBy("__pid").count().collect())
    offsets, acc = [], 0
    for p in range(max(counts, default=-1) + 1):
        offsets.append(acc)
        acc += counts.get(p, 0)
    off = F.array(*[F.lit(o).cast("long") for o in offsets]) if offsets else F.array().cast("array<long>")
    seq = F.element_at(off, F.col("__pid") + 1) + F.col("__pos") + F.lit(start)
    return fixed.withColumn(out, seq).drop("__pid", "__pos").select(
        *[c if c != out else out for c in df.columns] + ([] if out in df.columns else [out]))
