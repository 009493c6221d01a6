"""Category encoding and feature frames (ENC-*)."""
from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions import coerce as fx
from medallion.operators.keys import resequence

def fit_index(dfs: DataFrame | Sequence[DataFrame], col: str) -> DataFrame:
    """ENC-3: index table (label, idx) fitted on the union of sources, so an index means one category everywhere.

    Labels are ordered by frequency (desc), ties alphabetically; values are
    compared as strings.  The grouped counts, one row per label, are range-partitioned
    on (count, label) and numbered by the offsets of the partitions
    (:func:`medallion.operators.keys.resequence`), so no task ranks all labels.  The
    table is written once under the shared checkpoint folder.
    """
    dfs = [dfs] if isinstance(dfs, DataFrame) else list(dfs)
    u = None
    for d in dfs:
        part = d.select(F.col(col).cast("string").alias("label"))
        u = part if u is None else u.unionByName(part)
    counts = u.where("label is not null").groupBy("label").agg((-F.count("*")).alias("less"))
    ranked = resequence(counts, ["less", "label"], "idx", start=0, tiebreak=False)
    return ranked.select("label", F.col("idx").cast("double").alias("idx"))


def index_category(df: DataFrame, col: str, out: str | None = None, index: DataFrame | None = None) -> DataFrame:
    """ENC-1/ENC-2: frequency-ranked index by a join with the index table; unknown and null -> number of labels."""
    out = out or f"{col}_idx"
    table = index if index is not None else fit_index(df, col)
    unknown = table.agg(F.count("*").cast("double")).scalar()
    t = table.select(F.col("label").alias("__label"), F.col("idx").alias("__idx"))
    j = df.join(t, F.col(col).cast("string") == F.col("__label"), "left")
    return j.withColumn(out, F.coalesce(F.col("__idx"), unknown)).drop("__label", "__idx")


def _safe(name: str) -> str:
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


#: Columns that :func:`one_hot` makes by itself.
ONE_HOT_COLUMNS = 1000


def one_hot(df: DataFrame, col: str, categories: Sequence[str] | None = None,
            prefix: str | None = None, drop: bool = True, max_columns: int = ONE_HOT_COLUMNS) -> DataFrame:
    """ENC-4: one 0/1 int column per category (null -> all zeros).

    With ``categories`` the operator is lazy.  Without, the distinct values are
    gathered first: they become the columns of the result.  A table has a bounded
    number of columns, so beyond ``max_columns`` values this is an error before
    anything is gathered, and :func:`one_hot_vector` is the way.
    """
    if categories is None:
        vals = df.select(F.col(col).cast("string")).where(F.col(col).isNotNull()).distinct().limit(max_columns + 1).collect()
        if len(vals) > max_columns:
            raise ValueError(f"{col} has more than {max_columns} values: name the categories or use one_hot_vector")
        categories = sorted(r[0] for r in vals)
    prefix = col if prefix is None else prefix
    s = F.col(col).cast("string")
    new = {f"{prefix}_{_safe(c)}": F.coalesce((s == F.lit(c)).cast("int"), F.lit(0))
           for c in categories}
    out = df.withColumns(new)
    return out.drop(col) if drop else out


def one_hot_vector(df: DataFrame, col: str, out: str | None = None, index: DataFrame | None = None) -> DataFrame:
    """ENC-4 for any number of categories: one sparse 0/1 vector by the frequency index (null or unknown: all zeros)."""
    out = out or f"{col}_vec"
    table = index if index is not None else fit_index(df, col)
    size = table.count()
    indexed = index_category(df, col, "__code", table)
    encoder = OneHotEncoder(inputCol="__code", outputCol=out, dropLast=True, handleInvalid="keep")
    # the encoder learns its size from the greatest index; the last place, unknown, is dropped
    top = df.sparkSession.range(1).select(F.lit(float(max(size - 1, 0))).alias("__code"))
    return encoder.fit(top).transform(indexed).drop("__code")


def model_frame(df: DataFrame, cols: Sequence[str] | None = None, drop: Sequence[str] = (),
                keep: Sequence[str] = ()) -> DataFrame:
    """ENC-5: coerce every column to double (booleans -> 0/1) and drop rows with a null; ``keep`` are carried as they are."""
    cols = [c for c in (cols or df.columns) if c not in {*drop, *keep}]
    typed = [F.col(c) for c in keep]
    for c in cols:
        dt_ = df.schema[c].dataType.simpleString()
        typed.append((F.col(c).cast("int").cast("double") if dt_ == "boolean"
                      else _finite(F.col(c)) if dt_ == "double"
                      else F.col(c).cast("double") if dt_ in _WHOLE else fx.as_double(c)).alias(c))
    # columns that cannot be null (one-hot) stay out of the filter, which would compute them a second time
    out = df.select(*typed)
    can = [f.name for f in out.schema if f.nullable]
    return out.na.drop(subset=can) if can else out


#: Whole numbers; these and doubles become double without the detour through text that :func:`fx.as_double` takes.
_WHOLE = ("tinyint", "smallint", "int", "bigint")


def _finite(c):
    """A double; NaN and the infinities are null, as their text is in :func:`fx.as_double`."""
    return F.when(F.abs(c) < F.lit(float("inf")), c)


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """ENC-6: feature vector column."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="error").transform(df)
