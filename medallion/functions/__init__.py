"""Column expressions (pure ``Column -> Column``), JVM-side and codegen friendly."""
from medallion.functions.coerce import (  # noqa: F401
    NUMERIC_TEXT, as_bool_cast, as_bool_set, as_double, as_int, as_timestamp,
    blank_to_null, bool_threshold, clamp, is_integral, null_if_in,
)
from medallion.functions.rules import risk_band_expr, risk_score_expr  # noqa: F401
