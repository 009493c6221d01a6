"""Connected components of a link table, wholly distributed."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, scratch


#: Parts into which the rows of a component are dealt.
SALTS = 32


def with_best(named: DataFrame, key: str, preferred: Column) -> DataFrame:
    """``named`` (rows with ``root``, null without links) and ``best``: the least ``preferred`` of the row's component.

    One component may hold a large share of the rows: its least value is found by map-side minima, and
    goes back to its rows in ``SALTS`` parts; rows without links take no part in the join.
    """
    linked = named.where("root is not null")
    best = (linked.groupBy("root").agg(F.min(preferred).alias("best"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
    dealt = linked.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int"))
    return (named.where("root is null").withColumn("best", preferred)
            .unionByName(dealt.join(best, ["root", "salt"]).drop("salt")))


def _smallest(e: DataFrame) -> DataFrame:
    """(u, m): smallest neighbour of each node, itself included."""
    return e.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of ``links``; root is the smallest node reachable.

    Alternates two star steps until nothing changes.  The large step hangs every
    greater neighbour of a node onto the node's smallest neighbour, the small
    step does the same for the smaller ones; each is a minimum by key (combined
    before the shuffle) and an equi-join, which adaptive execution splits where
    a node is a hub.  Every round is written to the shared folder, and the one
    before it is deleted.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = scratch(e, "links")
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (both.join(_smallest(both), "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        near = large.select("u", "v")
        m = near.groupBy("u").agg(F.min("v").alias("m"))
        small = (near.join(m, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                          F.col("m").alias("v")).where("u <> v").distinct())
        nxt = scratch(small, "links")
        row = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_scratch(e)
        e = nxt
        if tuple(row) == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = tuple(row)
