"""Scoring rule expressions (additive risk score and its bands)."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """``weight`` is added when ``predicate(column)`` holds; a null input adds nothing."""
    column: str
    op: str          # one of: is_true, ge, le
    weight: float
    threshold: float | None = None


# The additive fraud risk rules (base 0.05, result clamped to
# [0, 1] and rounded to 2 decimals).
BASE_RISK = 0.05
DEFAULT_RULES = (
    Rule("is_foreign_transaction", "is_true", 0.25),
    Rule("location_mismatch", "is_true", 0.25),
    Rule("amount", "ge", 0.15, 500.0),
    Rule("velocity_last_24h", "ge", 0.10, 10.0),
    Rule("device_trust_score", "le", 0.10, 40.0),
)
# Risk bands (score >= 0.65 high, >= 0.35 medium, else low).
BANDS = ((0.65, "high"), (0.35, "medium"))
LOW_BAND = "low"


def _term(rule: Rule, columns: dict[str, Column] | None) -> Column:
    c = (columns or {}).get(rule.column, F.col(rule.column))
    if rule.op == "is_true":
        cond = c.cast("boolean")
    elif rule.op == "ge":
        cond = c >= F.lit(rule.threshold)
    elif rule.op == "le":
        cond = c <= F.lit(rule.threshold)
    else:
        raise ValueError(f"unknown rule op {rule.op!r}")
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(rule.weight)).otherwise(F.lit(0.0))


def risk_score_expr(rules=DEFAULT_RULES, base: float = BASE_RISK, digits: int = 2,
                    columns: dict[str, Column] | None = None) -> Column:
    """Null-safe additive score, clamped to [0, 1] and rounded."""
    total = F.lit(base)
    for r in rules:
        total = total + _term(r, columns)
    return F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)), digits)


def risk_band_expr(score, bands=BANDS, low: str = LOW_BAND) -> Column:
    s = F.col(score) if isinstance(score, str) else score
    out = None
    for threshold, name in bands:
        out = (F.when(s >= F.lit(threshold), F.lit(name)) if out is None
               else out.when(s >= F.lit(threshold), F.lit(name)))
    return F.when(s.isNull(), F.lit(None)).otherwise(out.otherwise(F.lit(low)))
