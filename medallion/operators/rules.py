"""Scoring and labelling rules (SCR-*)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medallion.functions.rules import BANDS, DEFAULT_RULES, LOW_BAND, BASE_RISK
from medallion.functions.rules import risk_band_expr, risk_score_expr

# Fixed value: a quoted id prefix in the supervisor note is the text between
# an opening double quote and the first '.' or the closing quote.
NOTE_PREFIX_REGEX = r'"([^".]+)[^"]*"'


def risk_score(df: DataFrame, out: str = "risk_score", rules=DEFAULT_RULES,
               base: float = BASE_RISK, digits: int = 2) -> DataFrame:
    """SCR-1: additive, null-safe risk score in [0, 1]."""
    return df.withColumn(out, risk_score_expr(rules, base, digits))


def risk_band(df: DataFrame, score: str = "risk_score", out: str = "risk_band",
              bands=BANDS, low: str = LOW_BAND) -> DataFrame:
    """SCR-2: score -> band name."""
    return df.withColumn(out, risk_band_expr(score, bands, low))


def rules_from_text(df: DataFrame, value_col: str = "value") -> DataFrame:
    """SCR-4: rule table (``prefix``) out of note lines; every quoted prefix of a line is a rule."""
    found = F.regexp_extract_all(F.col(value_col), F.lit(NOTE_PREFIX_REGEX), F.lit(1))
    return df.select(F.explode(found).alias("prefix")).where(F.col("prefix") != "").distinct()


def relabel_by_prefix(df: DataFrame, id_col: str, prefixes: Sequence[str] | DataFrame,
                      label_col: str = "is_fraud", label_value=True) -> DataFrame:
    """SCR-3: set ``label_col`` to ``label_value`` when the id starts with a rule prefix.

    A list of prefixes becomes a ``startswith`` disjunction; for a rule DataFrame
    (column ``prefix``) see :func:`prefix_hit`.
    """
    if isinstance(prefixes, DataFrame):
        out = prefix_hit(df, id_col, prefixes, "__rule_hit")
        hit = F.col("__rule_hit")
    else:
        out, ids, hit = df, F.col(id_col).cast("string"), F.lit(False)
        for p in prefixes:
            hit = hit | F.coalesce(ids.startswith(p), F.lit(False))
    return out.withColumn(label_col, F.when(hit, F.lit(label_value)).otherwise(F.col(label_col))).drop("__rule_hit")


def prefix_hit(df: DataFrame, id_col: str, rules: DataFrame, out: str) -> DataFrame:
    """``df`` with a boolean: whether the id (as text) starts with a prefix of the rule table.

    One equi-join per distinct prefix length on ``substring(id, 1, len)``, so
    Spark chooses broadcast or shuffle from the measured size of the rule table
    and the data never meets a nested-loop join.
    """
    ids = F.col(id_col).cast("string")
    rules = rules.select(F.col("prefix").cast("string").alias("prefix")).where("prefix is not null").distinct()
    lengths = [r[0] for r in rules.select(F.length("prefix")).distinct().collect()]
    hits = [F.lit(False)]
    for i, n in enumerate(sorted(lengths)):
        key, flag = f"__rule_key{i}", f"__rule_flag{i}"
        r = rules.where(F.length("prefix") == n).select(F.col("prefix").alias(key), F.lit(True).alias(flag))
        df = df.withColumn(key, F.substring(ids, 1, n)).join(r, key, "left").drop(key)
        hits.append(F.coalesce(F.col(flag), F.lit(False)))
    hit = hits[0]
    for h in hits[1:]:
        hit = hit | h
    return df.withColumn(out, hit).drop(*[f"__rule_flag{i}" for i in range(len(lengths))])


def prefix_flag(df: DataFrame, col: str, prefix: str, out: str = "id_flag") -> DataFrame:
    """SCR-5: 1 when the key (as text) starts with ``prefix``, else 0 (null -> 0)."""
    return df.withColumn(out, F.coalesce(F.col(col).cast("string").startswith(prefix),
                                         F.lit(False)).cast("int"))
