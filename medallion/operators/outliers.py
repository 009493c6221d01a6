"""IQR fences, outlier reports and IQR filters (OUT-*, PRF-8, PRF-9, PRF-16)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from medallion.operators import stats


def fence_values(df: DataFrame, cols: Sequence[str], factor: float | Mapping[str, float] = 1.5,
                 method: str = "cont", **kw) -> dict[str, tuple]:
    """{col: (q1, q3, lo, hi)} for all columns from one quantile pass."""
    q = stats.quantiles(df, cols, [0.25, 0.75], method=method, **kw)
    out = {}
    for c in cols:
        f = factor[c] if isinstance(factor, Mapping) else factor
        q1, q3 = q[c]
        if q1 is None:
            out[c] = (None, None, None, None)
        else:
            iqr = q3 - q1
            out[c] = (q1, q3, q1 - f * iqr, q3 + f * iqr)
    return out


def fences(df: DataFrame, cols: Sequence[str], factor=1.5, method: str = "cont",
           digits: int = 6, **kw) -> DataFrame:
    """OUT-1: (column_name, q1, q3, iqr, lo, hi)."""
    fv = fence_values(df, cols, factor, method, **kw)
    r = lambda x: None if x is None else round(float(x), digits)
    rows = [(c, r(q1), r(q3), r(None if q1 is None else q3 - q1), r(lo), r(hi))
            for c, (q1, q3, lo, hi) in fv.items()]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, q1 double, q3 double, iqr double, lo double, hi double")


def outlier_report(df: DataFrame, cols: Sequence[str], factor=1.5, method: str = "cont",
                   digits: int = 6, **kw) -> DataFrame:
    """PRF-8: per column fences, outlier count, median and max.

    Two passes over the data for all columns together: one quantile pass, one
    conditional-count aggregate.
    """
    q = stats.quantiles(df, cols, [0.25, 0.5, 0.75], method=method, **kw)
    aggs, meta = [], []
    for i, c in enumerate(cols):
        f = factor[c] if isinstance(factor, Mapping) else factor
        q1, med, q3 = q[c]
        lo, hi = (q1 - f * (q3 - q1), q3 + f * (q3 - q1)) if q1 is not None else (None, None)
        v = F.col(c).cast("double")
        aggs += [F.count_if((v < F.lit(lo)) | (v > F.lit(hi))).alias(f"o{i}"),
                 F.max(v).alias(f"m{i}")]
        meta.append((c, q1, q3, lo, hi, med))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.round(F.lit(q1).cast("double"), digits).alias("q1"),
                     F.round(F.lit(q3).cast("double"), digits).alias("q3"),
                     F.round(F.lit(lo).cast("double"), digits).alias("lo"),
                     F.round(F.lit(hi).cast("double"), digits).alias("hi"),
                     F.col(f"o{i}").cast("long").alias("n_outliers"),
                     F.round(F.lit(med).cast("double"), digits).alias("median"),
                     F.col(f"m{i}").alias("max_value"))
            for i, (c, q1, q3, lo, hi, med) in enumerate(meta)]
    return wide.select(F.inline(F.array(*rows)))


def outlier_examples(df: DataFrame, col: str, lo: float, hi: float, n: int = 10) -> DataFrame:
    """PRF-9: the largest offending values first (a top-k report; ties by the other columns)."""
    v = F.col(col)
    ties = [F.asc_nulls_first(c) for c in df.columns if c != col]
    return df.where((v < lo) | (v > hi)).orderBy(F.desc(col), *ties).limit(n)


def box_stats(df: DataFrame, cols: Sequence[str], factor: float = 1.5, method: str = "cont",
              digits: int = 6, **kw) -> DataFrame:
    """PRF-16: min, q1, median, q3, max, whiskers (last points inside the fences), outliers."""
    q = stats.quantiles(df, cols, [0.25, 0.5, 0.75], method=method, **kw)
    aggs, meta = [], []
    for i, c in enumerate(cols):
        q1, med, q3 = q[c]  # None for a column without values: all its figures are null
        lo, hi = (None, None) if q1 is None else (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
        v = F.col(c).cast("double")
        aggs += [F.min(v).alias(f"mn{i}"), F.max(v).alias(f"mx{i}"),
                 F.min(F.when(v >= F.lit(lo), v)).alias(f"wl{i}"),
                 F.max(F.when(v <= F.lit(hi), v)).alias(f"wh{i}"),
                 F.count_if((v < F.lit(lo)) | (v > F.lit(hi))).alias(f"o{i}")]
        meta.append((c, q1, med, q3))
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"mn{i}").alias("min_value"),
                     F.round(F.lit(q1).cast("double"), digits).alias("q1"),
                     F.round(F.lit(med).cast("double"), digits).alias("median"),
                     F.round(F.lit(q3).cast("double"), digits).alias("q3"),
                     F.col(f"mx{i}").alias("max_value"),
                     F.col(f"wl{i}").alias("whisker_lo"), F.col(f"wh{i}").alias("whisker_hi"),
                     F.col(f"o{i}").cast("long").alias("n_outliers"))
            for i, (c, q1, med, q3) in enumerate(meta)]
    return wide.select(F.inline(F.array(*rows)))


def iqr_filter(df: DataFrame, cols: Sequence[str], factors: float | Mapping[str, float] = 1.5,
               sequential: bool = True, method: str = "cont", keep_nulls: bool = False,
               persist: bool = True, **kw) -> DataFrame:
    """OUT-2 / OUT-3: keep rows inside ``[q1 - f*IQR, q3 + f*IQR]``.

    ``sequential``: the columns are processed in the given order and each
    column's fences are computed on the survivors of the previous ones (the
    order matters).  Otherwise all fences come from the input in one pass.
    Null values fail the closed-range test unless ``keep_nulls``.

    The fences become literals, so the returned plan is a single fused filter
    over the input.  With ``persist`` the fenced columns are kept (memory and disk)
    only while the dependent statistics passes run, and released before returning.
    """
    def inside(c, lo, hi):
        v = F.col(c)
        test = (v >= F.lit(lo)) & (v <= F.lit(hi))
        return (v.isNull() | test) if keep_nulls else F.coalesce(test, F.lit(False))

    narrow = df.select(*[F.col(c) for c in dict.fromkeys(cols)])
    src = narrow.persist(StorageLevel.MEMORY_AND_DISK) if persist else narrow
    try:
        if not sequential:
            fv = fence_values(src, cols, factors, method, **kw)
            bounds = [(c, fv[c][2], fv[c][3]) for c in cols]
        else:
            bounds, cur = [], src
            for c in cols:
                _, _, lo, hi = fence_values(cur, [c], factors, method, **kw)[c]
                bounds.append((c, lo, hi))
                if lo is not None:
                    cur = cur.where(inside(c, lo, hi))
    finally:
        if persist:
            src.unpersist()
    cond = F.lit(True)
    for c, lo, hi in bounds:
        if lo is not None:
            cond = cond & inside(c, lo, hi)
    return df.where(cond)
