"""Category normalisation and log-line parsing (STR-*)."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions import coerce as fx
from medallion.functions.logs import LOG_DEFAULTS, LOG_FIELDS, MANDATORY_FIELDS


def normalize_category(df: DataFrame, col: str, case: str = "title",
                       sentinels: Sequence[str] = ("NAN",), out: str | None = None) -> DataFrame:
    """STR-1/STR-2 (+IMP-5): trim, sentinel -> null, blank -> null, then title or lower case."""
    v = fx.blank_to_null(fx.null_if_in(col, sentinels))
    if case == "title":
        v = F.initcap(F.lower(v))
    elif case == "lower":
        v = F.lower(v)
    elif case == "upper":
        v = F.upper(v)
    elif case != "keep":
        raise ValueError(case)
    return df.withColumn(out or col, v)


def map_category(df: DataFrame, col: str, mapping: Mapping[str, str],
                 out: str | None = None) -> DataFrame:
    """STR-3: synonym map on ``lower(trim(col))``; unmapped values pass through lower-cased.

    The mapping is a literal map expression (no join); it is meant for
    hand-written synonym lists.  Use a join for mapping tables.
    """
    key = F.lower(F.trim(F.col(col)))
    m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
    return df.withColumn(out or col, F.coalesce(F.try_element_at(m, key), key))


def map_category_table(df: DataFrame, col: str, mapping: DataFrame, out: str | None = None,
                       src_col: str = "src", dst_col: str = "dst") -> DataFrame:
    """STR-3 for large mapping tables: equi-join on the normalised key.

    Spark decides broadcast vs shuffle from the measured size of ``mapping``.
    """
    key = "__map_key"
    m = mapping.select(F.lower(F.trim(src_col)).alias(key), F.col(dst_col).alias("__dst")) \
        .dropDuplicates([key])
    j = df.withColumn(key, F.lower(F.trim(F.col(col)))).join(m, key, "left")
    return j.withColumn(out or col, F.coalesce("__dst", key)).drop(key, "__dst")


def blank_to_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """STR-4: trim; empty text -> null."""
    return df.withColumns({c: fx.blank_to_null(c) for c in cols})


def _field(value, regex: str, kind: str):
    raw = F.nullif(F.regexp_extract(value, regex, 1), F.lit(""))
    if kind == "string":
        return raw
    if kind == "int":
        return raw.try_cast("double").try_cast("int")
    if kind == "double":
        return raw.try_cast("double")
    if kind == "decimal_comma":
        return F.translate(raw, ",", ".").try_cast("double")
    if kind == "flag":
        return F.when(raw.isNotNull(), raw == F.lit("1"))
    if kind == "truefalse":
        return F.when(raw.isNotNull(), raw == F.lit("true"))
    raise ValueError(kind)


def parse_logs(df: DataFrame, value_col: str = "value", fields=LOG_FIELDS,
               keep: Sequence[str] = (), defaults: Mapping[str, object] = LOG_DEFAULTS) -> DataFrame:
    """STR-5..7: one ``select`` of ``regexp_extract`` + ``try_cast`` per field.

    A field that is absent from the line takes its default, else null (never ``''``).
    """
    v = F.col(value_col)
    cols = []
    for name, rx, kind in fields:
        c = _field(v, rx, kind)
        cols.append((F.coalesce(c, F.lit(defaults[name])) if name in defaults else c).alias(name))
    return df.select(*keep, *cols)


def _rows_where(df: DataFrame, cond) -> DataFrame:
    """Keep rows where ``cond`` holds, evaluated together with the projection.

    A plain ``where`` on parsed columns is pushed below the parsing projection,
    so every regex it references would run twice (once in the filter, once in
    the projection).  ``inline`` of a one-element (or empty) array keeps the
    row selection inside the same projection: each expression runs once.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    keep = F.when(F.coalesce(cond, F.lit(False)), F.array(row)).otherwise(F.array().cast(
        f"array<{row_type(df)}>"))
    return df.select(F.inline(keep))


def row_type(df: DataFrame) -> str:
    return df.schema.simpleString()


def split_unparsed(df: DataFrame, mandatory: Sequence[str] = MANDATORY_FIELDS) -> tuple[DataFrame, DataFrame]:
    """STR-8: (parsed rows, rows missing a mandatory field), each parse evaluated once."""
    ok = F.lit(True)
    for c in mandatory:
        ok = ok & F.col(c).isNotNull()
    return _rows_where(df, ok), _rows_where(df, ~ok)
