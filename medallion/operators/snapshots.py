"""Mutations of a table as pure DataFrame transformations (MUT-*, MRG-1, VER-4).

``update``, ``delete``, ``upsert``, ``append`` and ``diff_versions`` take and give
DataFrames.  Commit logs, time travel and rollback belong to the table format in
which the user stores the results.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """Raised by ``append`` when the incoming schema differs from the table's."""

    def __init__(self, report: list[tuple[str, str | None, str | None]]):
        self.report = report
        lines = [f"{c}: table={a} incoming={b}" for c, a, b in report]
        super().__init__("schema mismatch:\n  " + "\n  ".join(lines))


def schema_diff(expected: T.StructType, actual: T.StructType) -> list[tuple[str, str | None, str | None]]:
    """Columns whose presence or type differ: (column, expected type, actual type)."""
    e = {f.name: f.dataType.simpleString() for f in expected.fields}
    a = {f.name: f.dataType.simpleString() for f in actual.fields}
    return [(c, e.get(c), a.get(c)) for c in list(e) + [c for c in a if c not in e]
            if e.get(c) != a.get(c)]


def update(df: DataFrame, cond: Column | str, sets: Mapping[str, Column | object]) -> DataFrame:
    """MUT-3: set columns where ``cond`` holds (a null condition changes nothing)."""
    c = F.expr(cond) if isinstance(cond, str) else cond
    hit = F.coalesce(c, F.lit(False))
    new = {}
    for col, v in sets.items():
        val = v if isinstance(v, Column) else F.lit(v)
        new[col] = F.when(hit, val.cast(df.schema[col].dataType)).otherwise(F.col(col))
    return df.withColumns(new)


def delete(df: DataFrame, cond: Column | str) -> DataFrame:
    """MUT-4: remove rows where ``cond`` holds (a null condition keeps the row)."""
    c = F.expr(cond) if isinstance(cond, str) else cond
    return df.where(~F.coalesce(c, F.lit(False)))


def append(df: DataFrame, new: DataFrame) -> DataFrame:
    """MUT-1: rows of ``new`` added if the schemas agree, else :class:`SchemaMismatch`."""
    diff = schema_diff(df.schema, new.schema)
    if diff:
        raise SchemaMismatch(diff)
    return df.unionByName(new)


def append_batches(df: DataFrame, batches: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """MUT-1 as a gate: (table with the rows of all batches whose schema agrees, report).

    Each batch goes through :func:`append`.  A rejected one adds no row; the report
    has a line for each of its differing columns (batch, accepted, column_name,
    table_type, incoming_type), and one line without a column for each accepted batch.
    Only schemas are looked at: no data is read.
    """
    lines = []
    for name, new in batches.items():
        try:
            df = append(df, new)
            lines.append((name, True, None, None, None))
        except SchemaMismatch as e:
            lines += [(name, False, *line) for line in e.report]
    return df, df.sparkSession.createDataFrame(
        lines, "batch string, accepted boolean, column_name string, table_type string, incoming_type string")


def check_unique_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key without nulls occurs twice (one grouped aggregate, stops at the first hit)."""
    dup = (df.where(_all_not_null(keys)).groupBy(*keys).count().where(F.col("count") > 1).limit(1).collect())
    if dup:
        raise ValueError(f"duplicate keys in merge source, e.g. {dup[0].asDict()}")


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str],
           check_source: bool = True) -> DataFrame:
    """MRG-1: matched keys take the whole source row, unmatched source rows are inserted.

    Update-all semantics: every target row whose key matches becomes the
    source row (a null in the source overwrites); target rows without a match
    stay; source rows without a match are inserted.  Null keys never match.
    Source keys must be unique (checked; null keys may repeat).

    One left join of the target to the source (which adaptive execution can
    split where a key is hot, unlike a full outer join) and one anti join of the
    source to the distinct target keys (reduced before the shuffle).
    """
    keys = list(keys)
    if check_source:
        check_unique_keys(source, keys)
    missing = [c for c in target.columns if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks columns {missing}")
    cols = target.columns
    src = source.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in cols])
    new = src.where(_all_not_null(keys)).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                                                F.struct(*[F.col(c) for c in cols]).alias("__new"))
    old = target.select(*[F.col(k).alias(f"__t{i}") for i, k in enumerate(keys)],
                        F.struct(*[F.col(c) for c in cols]).alias("__old"))
    on = F.lit(True)
    for i in range(len(keys)):
        on = on & (F.col(f"__t{i}") == F.col(f"__k{i}"))
    merged = (old.join(new, on, "left").select(F.coalesce("__new", "__old").alias("__row"))
              .select(*[F.col(f"__row.{c}").alias(c) for c in cols]))
    known = target.select(*keys).where(_all_not_null(keys)).distinct()
    return merged.unionByName(src.join(known, keys, "left_anti").select(*cols))


def _all_not_null(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def diff_versions(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """VER-4: keys added, removed or changed between two versions.

    One aggregate over the tagged union of both versions, grouped by key: per
    side the row count, the least and greatest row and an order-independent sum
    of 64-bit row hashes.  A key is ``added`` / ``removed`` when one side has no
    rows, ``changed`` when any of these differ.  Nulls are values: the hash is
    taken over each column's null flag and value, so a value that moves from one
    column to another is a change.  Where a key has one row on each side (or
    two), the comparison of the rows is exact; the hash sums stand for longer
    groups.  No join and no row pairs: a hot key is reduced map-side.
    """
    keys = list(keys)
    others = [c for c in old.columns if c not in keys]

    def tag(df: DataFrame, side: str) -> DataFrame:
        flags = [x for c in others for x in (F.col(c).isNull(), F.col(c))]
        h = F.xxhash64(*flags) if others else F.lit(0)
        row = F.struct(*[F.col(c) for c in others]) if others else F.struct(F.lit(0).alias("none"))
        return df.select(*keys, F.lit(side).alias("__side"), h.cast("decimal(38,0)").alias("__h"), row.alias("__row"))
    u = tag(old, "o").unionByName(tag(new.select(*old.columns), "n"))
    aggs = []
    for s in "on":
        own = F.col("__side") == s
        aggs += [F.count_if(own).alias(f"__n{s}"), F.sum(F.when(own, F.col("__h"))).alias(f"__h{s}"),
                 F.min(F.when(own, F.col("__row"))).alias(f"__lo{s}"), F.max(F.when(own, F.col("__row"))).alias(f"__hi{s}")]
    g = u.groupBy(*keys).agg(*aggs)
    same = F.lit(True)
    for x in ("n", "h", "lo", "hi"):
        same = same & F.col(f"__{x}o").eqNullSafe(F.col(f"__{x}n"))
    change = (F.when(F.col("__no") == 0, F.lit("added"))
              .when(F.col("__nn") == 0, F.lit("removed")).when(~same, F.lit("changed")))
    return g.select(*keys, change.alias("change")).where(F.col("change").isNotNull())
