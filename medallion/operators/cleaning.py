"""Projection, coercion and row filters (PRJ-*, FLT-*).

All operators are lazy ``DataFrame -> DataFrame`` and build one ``select`` /
``withColumns`` per call, so long cleaning chains keep a small plan.
"""
from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from medallion.functions import coerce as fx


def coerce_numeric(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """PRJ-1: text -> double; bad text, blanks and non-finite values -> null."""
    return df.withColumns({c: fx.as_double(c, strict) for c in cols})


def coerce_int(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """PRJ-2: text -> int through double (truncating)."""
    return df.withColumns({c: fx.as_int(c, strict) for c in cols})


def coerce_bool(df: DataFrame, cols: Sequence[str] | str, mode: str = "set",
                true_set: Iterable[str] = fx.TRUE_SET,
                false_set: Iterable[str] = fx.FALSE_SET) -> DataFrame:
    """PRJ-3 (``mode="set"``) / PRJ-4 (``mode="cast"``): text -> boolean."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    if mode == "set":
        return df.withColumns({c: fx.as_bool_set(c, true_set, false_set) for c in cols})
    if mode == "cast":
        return df.withColumns({c: fx.as_bool_cast(c) for c in cols})
    raise ValueError(f"unknown mode {mode!r}")


def bool_threshold(df: DataFrame, col: str, threshold: float = 0.5,
                   out: str | None = None) -> DataFrame:
    """PRJ-5: score -> boolean by threshold."""
    return df.withColumn(out or col, fx.bool_threshold(col, threshold))


def bool_to_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ-6: boolean -> 0/1 int (null stays null)."""
    return df.withColumns({c: F.col(c).cast("int") for c in cols})


def coerce_timestamp(df: DataFrame, cols: Sequence[str] | str) -> DataFrame:
    """PRJ-7: text -> timestamp, bad text -> null."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    return df.withColumns({c: fx.as_timestamp(c) for c in cols})


INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _cast_expr(c: Column, dtype: T.DataType, source: T.DataType) -> Column:
    if isinstance(dtype, INTEGRAL):
        if isinstance(source, INTEGRAL):
            return c.try_cast(dtype)
        if isinstance(source, (T.FloatType, T.DoubleType)):
            return c.cast("double").try_cast(dtype)
        # text and decimals truncate ('34.0' and 34.9 become 34) and keep all digits of a long
        return fx.as_long(c, truncate=True).try_cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return fx.as_bool_set(c)
    return c.try_cast(dtype)


def conform(df: DataFrame, schema: T.StructType, renames: Mapping[str, str] | None = None,
            violations: str | None = "_violations") -> DataFrame:
    """PRJ-8: select, rename and cast to ``schema``.

    A value that is present but does not fit the target type (text in a number
    column, 300 in a tinyint) becomes null and its column name is listed in the
    ``violations`` array; rows with an empty array conform.  Missing source
    columns become typed nulls.
    """
    renames = dict(renames or {})
    src = {renames.get(c, c): c for c in df.columns}
    cols, bad = [], []
    for f in schema.fields:
        if f.name in src:
            raw = F.col(f"`{src[f.name]}`")
            typed = _cast_expr(raw, f.dataType, df.schema[src[f.name]].dataType)
            bad.append(F.when(raw.isNotNull() & typed.isNull(), F.lit(f.name)))
            if not f.nullable:
                bad.append(F.when(raw.isNull(), F.lit(f.name)))
        else:
            typed = F.lit(None).cast(f.dataType)
            if not f.nullable:
                bad.append(F.lit(f.name))
        cols.append(typed.alias(f.name))
    if violations:
        cols.append(F.array_compact(F.array(*bad)).alias(violations) if bad
                    else F.array().cast("array<string>").alias(violations))
    return df.select(*cols)


def split_conformed(df: DataFrame, violations: str = "_violations") -> tuple[DataFrame, DataFrame]:
    """Good rows (no violation, column dropped) and quarantined rows."""
    good = df.where(F.size(violations) == 0).drop(violations)
    bad = df.where(F.size(violations) > 0)
    return good, bad


def flatten(df: DataFrame, spec: Mapping[str, tuple[str, str | None]]) -> DataFrame:
    """PRJ-9: one ``select`` of nested leaves: ``{out: (dotted.path, cast_kind)}``.

    ``cast_kind`` is one of None (as is), "double", "int", "bool", "bool_cast",
    "string", "timestamp".  A null parent struct gives null leaves.
    """
    kinds = {
        None: lambda c: c,
        "string": lambda c: c.cast("string"),
        "double": fx.as_double,
        "int": fx.as_int,
        "bool": fx.as_bool_set,
        "bool_cast": fx.as_bool_cast,
        "timestamp": fx.as_timestamp,
    }
    return df.select(*[kinds[k](F.col(path)).alias(out) for out, (path, k) in spec.items()])


def drop_cols(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """PRJ-10: drop, tolerant of absent columns."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_sparse(df: DataFrame, max_null_share: float, cols: Sequence[str] | None = None) -> DataFrame:
    """PRJ-11: drop columns whose null share exceeds ``max_null_share`` (one aggregate)."""
    cols = list(cols or df.columns)
    row = df.agg(F.count("*").alias("__n"),
                 *[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    n = row["__n"] or 1
    return df.drop(*[c for c in cols if row[c] / n > max_null_share])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-12."""
    return df.withColumnsRenamed(dict(mapping))


def clamp_cols(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """PRJ-13: clamp each column into its (lo, hi)."""
    return df.withColumns({c: fx.clamp(c, lo, hi) for c, (lo, hi) in bounds.items()})


def keep_integral(df: DataFrame, col: str) -> DataFrame:
    """FLT-2: keep rows whose value is a whole number (null and fractions out)."""
    return df.where(fx.is_integral(col))


def keep_in(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """FLT-3: domain filter."""
    return df.where(F.col(col).isin(list(values)))


def clean_flag(df: DataFrame, col: str, default: int = 0, allowed=(0, 1)) -> DataFrame:
    """FLT-4: null -> default, keep only allowed values, cast to int."""
    num = isinstance(df.schema[col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                                                T.FloatType, T.DoubleType))
    v = F.coalesce(F.col(col).cast("double") if num else fx.as_double(col), F.lit(float(default)))
    return (df.withColumn(col, v).where(F.col(col).isin([float(a) for a in allowed]))
            .withColumn(col, F.col(col).cast("int")))


def keep_between(df: DataFrame, bounds: Mapping[str, tuple]) -> DataFrame:
    """FLT-5: closed range on many columns (null fails)."""
    cond = F.lit(True)
    for c, (lo, hi) in bounds.items():
        cond = cond & F.col(c).between(lo, hi)
    return df.where(cond)


def keep_at_most(df: DataFrame, col: str, hi) -> DataFrame:
    """FLT-6: one-sided bound (null fails)."""
    return df.where(F.col(col) <= F.lit(hi))


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None, how: str = "any") -> DataFrame:
    """FLT-7 / SRC-6: drop rows null in any (or all) of the columns."""
    return df.na.drop(how=how, subset=list(cols) if cols else None)


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """SRC-6: drop rows where every column is null."""
    return df.na.drop(how="all")


def count_prefix(dfs: Mapping[str, DataFrame], col: str, prefix: str) -> DataFrame:
    """FLT-8: per source, rows whose key (as text) starts with ``prefix``."""
    parts = [d.agg(F.count_if(F.coalesce(F.col(col).cast("string").startswith(prefix),
                                         F.lit(False))).alias("n_rows"))
             .select(F.lit(name).alias("source"), "n_rows") for name, d in dfs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate(df: DataFrame, rules: Mapping[str, Column], valid: str = "_valid",
             violations: str = "_violations") -> DataFrame:
    """FLT-9: evaluate named row rules; a null rule result counts as a failure.

    Adds ``_violations`` (array of failed rule names) and ``_valid``.
    """
    fails = [F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]
    return (df.withColumn(violations, F.array_compact(F.array(*fails)))
            .withColumn(valid, F.size(violations) == 0))


def quarantine(df: DataFrame, valid: str = "_valid") -> tuple[DataFrame, DataFrame]:
    return df.where(F.col(valid)), df.where(~F.col(valid))
