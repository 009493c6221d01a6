"""Unification of conformed sources (UNI-*)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.operators.cleaning import conform
from medallion.operators.keys import winners


def unify(sources: Mapping[str, tuple[DataFrame, int]], schema: T.StructType | None = None,
          source_col: str = "source", priority_col: str = "priority") -> DataFrame:
    """UNI-1/UNI-5: conform each source to ``schema`` and ``unionByName``.

    Adds the source name and its priority.  Ids are conformed to the schema
    type (declare ids as string when sources disagree).
    """
    out = None
    for name, (df, prio) in sources.items():
        d = conform(df, schema, violations=None) if schema is not None else df
        d = d.withColumn(source_col, F.lit(name)).withColumn(priority_col, F.lit(prio).cast("int"))
        out = d if out is None else out.unionByName(d, allowMissingColumns=schema is None)
    return out


def unify_latest(df: DataFrame, key: str | Sequence[str], priority: str = "priority",
                 tiebreak: Sequence[str] = (), mode: str = "row") -> DataFrame:
    """UNI-2: one row per key, the highest priority wins.

    ``mode="row"`` keeps the winning row whole: the winner of each key is found on
    narrow rows and fetched late (:func:`medallion.operators.keys.winners`; an input
    that is expensive to compute should be written first, it is read three times).
    ``mode="column"`` picks each column separately from the highest-priority
    source where that column is not null, in one aggregate that combines map-side.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    if mode == "row":
        return winners(df, keys, [priority, *tiebreak], "last").select(*keys, *others)
    order = F.struct(F.col(priority), *[F.col(t) for t in tiebreak])
    if mode == "column":
        aggs = [F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order)).alias(c) for c in others]
        return df.groupBy(*keys).agg(*aggs)
    raise ValueError(mode)


def register_view(df: DataFrame, name: str) -> DataFrame:
    """UNI-3: expose a DataFrame to SQL."""
    df.createOrReplaceTempView(name)
    return df
