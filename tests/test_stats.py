"""Quantile routine: exact for every distribution and sketch size."""
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from medallion.operators import stats


def _disc(vals, p):
    s = sorted(vals)
    return s[stats.disc_rank(p, len(s))]


def test_every_sketch_size_gives_the_same(spark):
    rng = np.random.default_rng(7)
    vals = [float(x) for x in rng.integers(0, 500, 3000)] + [7.0] * 2000  # a hot value
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(4)
    ps = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    for accuracy in (stats.ACCURACY, 40):
        assert stats.quantiles(df, ["v"], ps, "disc", accuracy=accuracy)["v"] == [_disc(vals, p) for p in ps]
        assert np.allclose(stats.quantiles(df, ["v"], ps, "cont", accuracy=accuracy)["v"], np.quantile(vals, ps))


@pytest.mark.parametrize("share", [1 / 3, 0.6, 0.995])
def test_heavy_values_end_the_search_without_a_sort(spark, monkeypatch, share):
    """Passes are single aggregates; rows inside the last intervals are bounded by the sketch size."""
    n = 30_000
    rng = np.random.default_rng(3)
    vals = np.where(rng.random(n) < share, 0.5, rng.random(n)).tolist()
    df = spark.createDataFrame([(v,) for v in vals], "v double").repartition(4)
    passes, sizes, run = [], [], stats._sketched

    def watched(base, asked, accuracy, count=()):
        passes.append(len(asked))
        sizes.append([iv.size for iv, _ in asked if iv.size is not None])
        plan = base._jdf.queryExecution().optimizedPlan().toString()
        assert "Sort" not in plan and "Window" not in plan
        return run(base, asked, accuracy, count)
    monkeypatch.setattr(stats, "_sketched", watched)
    ps = [0.01, 0.25, 0.5, 0.75, 0.9]
    assert stats.quantiles(df, ["v"], ps, "disc", accuracy=100)["v"] == [_disc(vals, p) for p in ps]
    assert len(passes) <= 6  # each round keeps a few hundredths of the rows
    assert all(s <= 0.15 * n for later in sizes[1:] for s in later)


def test_nan_and_null_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,), (3.0,)], "v double")
    assert stats.median(df, ["v"])["v"] == 2.0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60), st.floats(0, 1))
def test_disc_matches_definition(spark, xs, p):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    for kw in ({}, {"accuracy": 20}):
        got = stats.quantiles(df, ["v"], [p], "disc", **kw)["v"][0]
        assert got == _disc([float(x) for x in xs], p)
        cont = stats.quantiles(df, ["v"], [p], "cont", **kw)["v"][0]
        assert math.isclose(cont, float(np.quantile(xs, p)), rel_tol=1e-9, abs_tol=1e-9)


def test_all_ranks_of_small_and_odd_columns(spark):
    vals = [float("-inf"), -1e300, -0.0, 0.0, 1e-300, 3.5, 3.5, float("inf"), 1e300]
    df = spark.createDataFrame([(v, None, 1) for v in vals], "a double, b double, c int")
    ps = [i / 8 for i in range(9)]
    for accuracy in (stats.ACCURACY, 20):
        got = stats.quantiles(df, ["a", "b", "c"], ps, "disc", accuracy=accuracy)
        assert got["a"] == [_disc(vals, p) for p in ps] and got["b"] == [None] * 9 and got["c"] == [1.0] * 9
    assert stats.quantiles(df.limit(0), ["a"], ps)["a"] == [None] * 9
