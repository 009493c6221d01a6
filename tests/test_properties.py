"""Property tests from the survey's test plan (§5c)."""
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from medallion.operators import rules
from medallion.operators import snapshots as snap

SCHEMA = "id long, tag string"


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(0, 50), max_size=20), st.lists(st.integers(0, 50), max_size=20))
def test_delete_after_append_is_inverse(spark, base, extra):
    t = spark.createDataFrame([(i, "base") for i in base], SCHEMA)
    added = t.unionByName(spark.createDataFrame([(i, "new") for i in extra], SCHEMA))
    back = snap.delete(added, F.col("tag") == "new")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, t.collect()))


nums = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False))
flags = st.one_of(st.none(), st.booleans())


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(flags, flags, nums, nums, nums), min_size=1, max_size=30))
def test_risk_score_in_unit_interval(spark, rows):
    df = spark.createDataFrame(rows, "is_foreign_transaction boolean, location_mismatch boolean, "
                                     "amount double, velocity_last_24h double, device_trust_score double")
    out = rules.risk_band(rules.risk_score(df)).collect()
    for r in out:
        assert 0.0 <= r.risk_score <= 1.0 and r.risk_band in ("low", "medium", "high")
