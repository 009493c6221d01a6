"""Imputation (IMP-*).

Statistics are computed once per call and enter the plan either as a scalar
subquery (mean: lazy, evaluated once by Spark) or as literals (medians, from the
quantile routine, and modes).  Fills use ``coalesce`` so NaN is never
silently touched (NaN is turned to null at ingestion instead).
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import coerce as fx
from medallion.operators import stats


def fill_const(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """IMP-1: null -> constant."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in values.items()})


def fill_median(df: DataFrame, cols: Sequence[str], method: str = "cont", **kw) -> DataFrame:
    """IMP-2: null -> column median (``cont``, ``disc`` or ``approx``)."""
    med = stats.median(df, cols, method=method, **kw)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(med[c]).cast(df.schema[c].dataType))
                           for c in cols if med[c] is not None})


def fill_mean(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """IMP-3: null -> column mean (scalar subquery, one aggregate for all columns)."""
    means = df.agg(*[F.avg(c).alias(c) for c in cols])
    return df.withColumns({
        c: F.coalesce(F.col(c), means.select(c).scalar().cast(df.schema[c].dataType))
        for c in cols})


def modes(df: DataFrame, cols: Sequence[str]) -> dict[str, str | None]:
    """Most frequent non-null value of each column as text, the lowest value on ties (None: no value).

    One pass for all columns: (column, value) pairs are counted, combined
    map-side, and the best pair of each column is a minimum; no group is ever
    gathered whole and one row per column reaches the driver.
    """
    cells = []
    for c in cols:
        kind = df.schema[c].dataType
        number = F.col(c).cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")
        cells.append(F.struct(F.lit(c).alias("c"), number.alias("v"), F.col(c).cast("string").alias("t")))
    n = df.select(F.inline(F.array(*cells))).where("t is not null").groupBy("c", "v", "t").agg(F.count("*").alias("n"))
    best = n.groupBy("c").agg(F.min(F.struct(-F.col("n"), F.col("v"), F.col("t")))["t"].alias("t"))
    got = {r["c"]: r["t"] for r in best.collect()}
    return {c: got.get(c) for c in cols}


def fill_mode(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """IMP-4: null -> mode (nulls excluded, ties -> smallest)."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    found = modes(df, cols)
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
                           for c, v in found.items() if v is not None})


def null_if(df: DataFrame, col: str, sentinels: Sequence[str] = ("NAN",)) -> DataFrame:
    """IMP-5: sentinel text -> null (trimmed, case-insensitive)."""
    return df.withColumn(col, fx.null_if_in(col, sentinels))


def handle_amount(df: DataFrame, col: str = "amount", on_null: str = "mean") -> DataFrame:
    """IMP-6: missing amount -> mean (default) or drop the row."""
    if on_null == "mean":
        return fill_mean(df, [col])
    if on_null == "drop":
        return df.na.drop(subset=[col])
    raise ValueError(on_null)
