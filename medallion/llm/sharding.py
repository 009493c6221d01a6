"""Sharding by a hierarchical weighted hash tree (native).

A tree has regions, racks and shards.  A row descends level by level: every
child of the node it stands in draws -ln(u) / weight, u being a hash of the row
id and the child's name, and the smallest draw wins.  A child's weight is the
sum of the weights below it.  A changed weight therefore moves rows only into
or out of the subtree whose weight changed; inside every other subtree the
draws are the same as before.

A new shard is put into a region of its own (:func:`grow`), so that the only
changed subtree is the new one: rows move into the new shard and nowhere else.

Defined cases
* null id: the text stands in for it (null too: one common key);
* rows with equal ids land in the same shard; their order inside it is by id,
  size and checksum, and rows equal in all of these are interchangeable;
* null text: no bytes, so size 1 and checksum 0; empty table: empty result;
* further columns are kept by :func:`assign`; if they are called ``shard`` or
  ``grown_shard``, the operator's own columns replace them.
"""
from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_key


class Leaf(NamedTuple):
    region: str
    rack: str
    shard: int
    weight: float = 1.0


def balanced(shards: int, per_rack: int = 4, racks_per_region: int = 2) -> list[Leaf]:
    """Tree of equal shards, filled rack by rack and region by region."""
    per_region = per_rack * racks_per_region
    return [Leaf(f"g{s // per_region}", f"g{s // per_region}r{s % per_region // per_rack}", s)
            for s in range(shards)]


def grow(tree: list[Leaf], weight: float = 1.0) -> list[Leaf]:
    """The tree with one more shard, in a region and rack of its own."""
    new = max((x.shard for x in tree), default=-1) + 1
    return [*tree, Leaf(f"new{new}", f"new{new}r0", new, weight)]


def _draw(key: Column, name: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from 52 hash bits."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit("/"), name)), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / F.lit(float(2 ** 52))) / weight


def _choose(key: Column, children: Column) -> Column:
    """Name of the child with the smallest draw; children: array of (name, weight)."""
    drawn = F.transform(children, lambda c: F.struct(_draw(key, c["name"], c["weight"]).alias("d"),
                                                     c["name"].alias("name")))
    return F.array_min(drawn)["name"]


def _children(pairs: dict[str, float]) -> Column:
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(float(w)).alias("weight"))
                     for n, w in sorted(pairs.items()) if w > 0])


def _below(of: dict[str, dict[str, float]]) -> Column:
    return F.create_map(*[x for parent in sorted(of) if any(w > 0 for w in of[parent].values())
                          for x in (F.lit(parent), _children(of[parent]))])


def shard_of(key: Column, tree: list[Leaf]) -> Column:
    """Shard (int) of a row with this string key."""
    regions: dict[str, float] = defaultdict(float)
    racks: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    leaves: dict[str, dict[str, float]] = defaultdict(lambda: defaultdict(float))
    for x in tree:
        regions[x.region] += x.weight
        racks[x.region][x.rack] += x.weight
        leaves[x.rack][f"{x.rack}s{x.shard}"] += x.weight
    region = _choose(key, _children(regions))
    # each step is bound once, by a one-element array, and then used by the next
    rack = F.transform(F.array(region), lambda g: _choose(key, _below(racks)[g]))
    leaf = F.transform(rack, lambda r: _choose(key, _below(leaves)[r]))
    return F.substring_index(F.element_at(leaf, 1), "s", -1).cast("int")


def assign(docs: DataFrame, tree: list[Leaf], grown: list[Leaf] | None = None,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``shard`` (and ``grown_shard`` under the grown tree); no shuffle."""
    key = id_key(F.col(id_col), F.col(text_col))
    out = {"shard": shard_of(key, tree)}
    if grown is not None:
        out["grown_shard"] = shard_of(key, grown)
    return docs.withColumns(out)


def manifest(assigned: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             cell_hex: int = 2, chunk: int = 65536) -> DataFrame:
    """(id, size, text_crc32, shard, slot[, grown_shard]) with slots 0.. in every shard.

    Equal entries are counted first, so that a row repeated any number of times
    is one row in the windows.  A shard's entries are cut into 16 ** ``cell_hex``
    cells by hash; each cell is numbered on its own and starts where the cells
    before it end, so no task holds a whole shard.
    """
    more = [c for c in ("grown_shard",) if c in assigned.columns]
    t = F.coalesce(F.col(text_col), F.lit(""))
    rows = assigned.select(
        F.col(id_col).alias("id"), (F.octet_length(t) + 1).cast("long").alias("size"),
        F.crc32(t.cast("binary")).alias("text_crc32"), "shard", *more,
        F.md5(id_key(F.col(id_col), F.col(text_col))).alias("h"))
    names = ["id", "size", "text_crc32", "shard", *more, "h"]
    entries = rows.groupBy(*names).agg(F.count("*").alias("n"))
    cell = F.substring("h", 1, cell_hex)
    counts = rows.groupBy("shard", cell.alias("cell")).agg(F.count("*").alias("in_cell"))
    run = Window.partitionBy("shard").orderBy("cell")
    starts = counts.select("shard", "cell", (F.sum("in_cell").over(run) - F.col("in_cell")).alias("start"))
    inside = Window.partitionBy("shard", "cell").orderBy("h", "id", "size", "text_crc32")
    numbered = (entries.withColumn("cell", cell)
                .withColumn("upto", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))))
    placed = (numbered.join(starts, ["shard", "cell"])
              .withColumn("first", F.col("start") + F.col("upto") - F.col("n")))
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {chunk}")))
    spread = placed.withColumn("part", part)
    low = F.col("first") + F.col("part") * chunk
    high = F.least(low + chunk, F.col("first") + F.col("n")) - 1
    return (spread.withColumn("slot", F.explode(F.sequence(low, high)))
            .select("id", "size", "text_crc32", "shard", "slot", *more))


def write_shards(docs: DataFrame, path: str, tree: list[Leaf], id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Write ``docs`` as Parquet, one folder per shard."""
    assign(docs, tree, id_col=id_col, text_col=text_col).write.partitionBy("shard").parquet(path)
