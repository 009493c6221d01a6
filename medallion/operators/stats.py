"""Exact and approximate quantiles without funnelling a column through one task.

``quantiles`` returns a few numbers per column to the driver (k values for k
probabilities), which then enter later plans as literals.

* ``method="approx"``: one ``percentile_approx`` aggregate for all columns
  (bounded sketch per task).
* ``method="cont"`` (linear interpolation, = pandas / DuckDB ``quantile_cont``)
  and ``method="disc"`` (element at rank ``ceil(p*n)``, = ``percentile_disc``)
  are exact, by one algorithm for every size and distribution.  Each wanted rank
  has an open interval of values that holds it.  A round takes a sketch of the
  values inside the intervals and reads from it, for each rank, three edges: the
  value near the rank and one on either side beyond the sketch's rank error.  A
  second pass counts the values below, equal to and above every edge.  A rank
  that falls on an edge is found, however many rows hold that value; otherwise
  its interval shrinks to that between two edges, a few ``1 / accuracy`` of the
  rows.  An interval with at most ``accuracy / 4`` rows is answered by the sketch
  itself, whose rank error is then below one half.  Both passes are single wide
  aggregates over the narrow columns: no sort, no shuffle of rows, and one
  bounded sketch per rank and task.

NaN is treated as missing (policy: NaN -> null at ingestion).
"""
from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACCURACY = 10_000


def _value(c: str) -> Column:
    """The column as double; null where it is missing or NaN."""
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def counts(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    row = df.agg(*[F.count(_value(c)).alias(c) for c in cols]).first()
    return {c: int(row[c]) for c in cols}


def disc_rank(p: float, n: int) -> int:
    """0-based rank of ``percentile_disc(p)`` among ``n`` sorted values."""
    return max(0, math.ceil(p * n) - 1)


def _ranks(p: float, n: int, method: str) -> list[int]:
    if method == "disc":
        return [disc_rank(p, n)]
    h = p * (n - 1)
    return [math.floor(h), math.ceil(h)]


def _combine(p: float, n: int, method: str, kth) -> float:
    if method == "disc":
        return kth[disc_rank(p, n)]
    h = p * (n - 1)
    lo, hi = math.floor(h), math.ceil(h)
    a, b = kth[lo], kth[hi]
    return a if lo == hi else a + (h - lo) * (b - a)


class _Interval:
    """Values of a column strictly between ``lo`` and ``hi``: ``size`` rows, ``below`` rows under them."""

    def __init__(self, col: str, lo, hi, below: int, size: int | None):
        self.col, self.lo, self.hi, self.below, self.size = col, lo, hi, below, size

    def inside(self) -> Column:
        v = F.col(f"`{self.col}`")
        cond = v.isNotNull()
        if self.lo is not None:
            cond = cond & (v > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (v < F.lit(self.hi))
        return cond


def _sketched(base: DataFrame, asked: list[tuple[_Interval, list[float]]], accuracy: int, count: Sequence[str] = ()):
    """The sketch's values at the asked probabilities of each interval, and row counts of ``count``."""
    aggs = [F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(count)]
    some = F.lit(False)
    for i, (iv, probs) in enumerate(asked):
        inside = iv.inside()
        some = some | inside
        aggs.append(F.percentile_approx(F.when(inside, F.col(f"`{iv.col}`")),
                                        F.array(*[F.lit(p) for p in probs]), accuracy).alias(f"q{i}"))
    row = (base if count else base.where(some)).agg(*aggs).first()
    return [row[f"q{i}"] for i in range(len(asked))], {c: int(row[f"n{i}"]) for i, c in enumerate(count)}


def _cell(v: Column, points: list[float], first: int = 0) -> Column:
    """Number of the cell of ``v``: 2i + 1 on the i-th point, else twice the number of points below; found by halving."""
    if not points:
        return F.lit(2 * first)
    mid = len(points) // 2
    return (F.when(v == F.lit(points[mid]), F.lit(2 * (first + mid) + 1))
            .when(v < F.lit(points[mid]), _cell(v, points[:mid], first))
            .otherwise(_cell(v, points[mid + 1:], first + mid + 1)))


def _counted(base: DataFrame, edges: list[tuple[_Interval, list[float]]]) -> list[list[tuple[int, int]]]:
    """(rows of the interval below an edge, rows equal to it) for every edge.

    All edges and bounds of a column cut its values into cells, the single
    points included; the rows are counted by (column, cell) in one aggregation.
    """
    cuts: dict[str, list[float]] = {}
    inside: dict[str, Column] = {}
    for iv, es in edges:
        own = set(cuts.get(iv.col, [])) | set(es) | {x for x in (iv.lo, iv.hi) if x is not None}
        cuts[iv.col] = sorted(own)
        inside[iv.col] = inside[iv.col] | iv.inside() if iv.col in inside else iv.inside()
    cells = []
    for i, (c, points) in enumerate(cuts.items()):
        cells.append(F.when(inside[c], _cell(F.col(f"`{c}`"), points)).alias(f"c{i}"))
    # the cells are computed by a projection of their own: a generator would interpret them row by row
    pairs = [x for i in range(len(cells)) for x in (F.lit(i), F.col(f"c{i}"))]
    got = (base.select(*cells).select(F.stack(F.lit(len(cells)), *pairs).alias("c", "cell")).where("cell is not null")
           .groupBy("c", "cell").agg(F.count("*").alias("n")).collect())
    number = {c: i for i, c in enumerate(cuts)}
    count = {(r["c"], r["cell"]): int(r["n"]) for r in got}
    out = []
    for iv, es in edges:
        points, i = cuts[iv.col], number[iv.col]
        first = 0 if iv.lo is None else 2 * points.index(iv.lo) + 2  # the first cell above the lower bound
        out.append([(sum(count.get((i, x), 0) for x in range(first, 2 * points.index(e) + 1)),
                     count.get((i, 2 * points.index(e) + 1), 0)) for e in es])
    return out


def _edges_around(at: float, accuracy: int) -> list[float]:
    """Probabilities of the three edges for a rank at this share of an interval."""
    slack = 2.0 / accuracy
    return [max(0.0, at - slack), min(1.0, max(0.0, at)), min(1.0, at + slack)]


def _select(df: DataFrame, cols: list[str], probs: list[float], method: str, accuracy: int) -> dict[str, list]:
    base = df.select(*[_value(c).alias(c) for c in cols])
    whole = {c: _Interval(c, None, None, 0, None) for c in cols}
    first = [p for at in probs for p in _edges_around(at, accuracy)]
    sketched, n = _sketched(base, [(whole[c], first) for c in cols], accuracy, cols)
    kth: dict[tuple[str, int], float] = {}
    wanted: dict[tuple[str, int], _Interval] = {}
    edges: list[tuple[_Interval, list[float]]] = []
    for c, q in zip(cols, sketched):
        whole[c].size = n[c]
        if n[c]:
            edges.append((whole[c], sorted(set(q))))
            for p in probs:
                wanted.update({(c, k): whole[c] for k in _ranks(p, n[c], method)})
    while wanted:
        # count around the edges and narrow every rank's interval
        found = {id(iv): (iv, es, got) for (iv, es), got in zip(edges, _counted(base, edges))}
        fresh: dict[tuple, _Interval] = {}
        for (c, k), iv in list(wanted.items()):
            _, es, got = found[id(iv)]
            lo, below, hi, upto = iv.lo, iv.below, iv.hi, iv.below + iv.size
            for e, (b, same) in zip(es, got):
                if k < iv.below + b:
                    hi, upto = e, iv.below + b
                    break
                if k < iv.below + b + same:
                    kth[(c, k)] = e
                    break
                lo, below = e, iv.below + b + same
            if (c, k) in kth:
                del wanted[(c, k)]
            else:
                wanted[(c, k)] = fresh.setdefault((c, lo, hi), _Interval(c, lo, hi, below, upto - below))
        if not wanted:
            break
        # sketch the intervals that are left; small ones are answered by it
        of: dict[int, tuple[_Interval, list[tuple[str, int]]]] = {}
        for key, iv in wanted.items():
            of.setdefault(id(iv), (iv, []))[1].append(key)
        asked = []
        for iv, keys in of.values():
            shares = [(k - iv.below + 0.5) / iv.size for _, k in keys]
            small = 4 * iv.size <= accuracy
            asked.append((iv, shares if small else [p for s in shares for p in _edges_around(s, accuracy)]))
        values, _ = _sketched(base, asked, accuracy)
        edges = []
        for (iv, keys), q in zip(of.values(), values):
            if 4 * iv.size <= accuracy:
                for key, v in zip(keys, q):
                    kth[key] = v
                    del wanted[key]
            else:
                edges.append((iv, sorted(set(q))))
    out = {}
    for c in cols:
        own = {k: v for (x, k), v in kth.items() if x == c}
        out[c] = [_combine(p, n[c], method, own) for p in probs] if n[c] else [None] * len(probs)
    return out


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
              method: str = "cont", accuracy: int = ACCURACY) -> dict[str, list]:
    """Quantiles of each column -> ``{col: [q(p) for p in probs]}`` (None if empty).

    ``accuracy``: sketch size; it sets the number of passes of the exact methods, not their results.
    """
    cols, probs = list(dict.fromkeys(cols)), [float(p) for p in probs]
    if method == "approx":
        row = df.agg(*[F.percentile_approx(_value(c), F.array(*[F.lit(p) for p in probs]), accuracy).alias(c)
                       for c in cols]).first()
        return {c: (list(row[c]) if row[c] is not None else [None] * len(probs)) for c in cols}
    if method not in ("cont", "disc"):
        raise ValueError(f"unknown quantile method {method!r}")
    return _select(df, cols, probs, method, accuracy) if cols and probs else {c: [] for c in cols}


def median(df: DataFrame, cols: Sequence[str], method: str = "cont", **kw) -> dict[str, float]:
    q = quantiles(df, cols, [0.5], method=method, **kw)
    return {c: q[c][0] for c in cols}
