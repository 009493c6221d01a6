"""Embedding near-duplicates by a navigable small-world graph over hubs, with a lowest layer in shards.

Equal vectors are one class.  One class of ``CELL``, chosen by hash, is a hub; the hubs get a hierarchical
navigable small-world graph (built in batches with array operations).  Every class is searched in it once: a
greedy descent through the upper layers, then a beam search in the lowest one.  A class hangs on the ``HOMES``
nearest hubs of its beam.  The classes are dealt into shards by hash, and every class is a query against every
shard: there it is compared with the vectors that hang on the hubs of its beam, in tiles of the matrix product.  A
beam that ends within twice the threshold's angle may have missed hubs of vectors within that angle, so it is
widened, twice as wide each time, until it ends outside.

Before the search an audit compares ``AUDIT`` hash-chosen queries with every vector
of all shards (a class is not its own link).  Where near copies are rare these
show hardly a link, so as many queries are planted at known cosines beside stored
vectors, each compared with one shard.  All beams start as wide as is needed to
find ``RECALL`` of these links, pooled over the shards; if none is wide enough,
every vector is compared.  The audit's work grows with the vectors once, not with
their pairs.

A query that has ``LIMIT`` links or more in a shard, or whose beam of ``LIMIT`` hubs still ends too near, is
compared with the whole shard instead, in tiles of the matrix product.  These comparisons are dealt over tasks of
``WIDE_ROWS`` queries.

A hit counts only if its cosine, computed in double precision, reaches the
threshold.  Links are counted, not listed: the hits of one query are reduced at
once to their number and their cluster of the shard (the vectors joined by the
hits so far), and one link per query and per vector to its cluster's root is
enough for the components.

Defined cases
* null and empty vectors, zero vectors and those with a null or non-finite
  component link with nothing: no links, a component of their own;
* vectors of another length link only among themselves; labels are not read;
* equal vectors, repeated rows: linked with each other (repeated rows of an id
  count as other vectors); null ids: never the smallest unless all are null;
* empty table: empty result; further columns are ignored.
"""
from __future__ import annotations

import logging
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medallion.session import ship_package

from .common import drop_scratch, map_pandas, scratch
from .components import components, with_best

THRESHOLD = 0.95
SHARDS = 8
SHARDS_A_TASK = 2   # shards whose classes a task has as queries of another shard
ROWS_PER_SHARD = 50_000
LINKS = 12          # neighbours on the upper layers; twice as many on the lowest
BEAM_BUILD = 40
BEAM = 32
DESCENT = 8         # beam on the upper layers
RECALL = 0.99
AUDIT = 2_048       # classes that the audit compares with all others, and queries that it plants
_PARTS = 1 << 30
LIMIT = 128         # widest beam; beyond it a query is compared with the whole shard
CELL = 256          # classes for each hub
HOMES = 6           # cells that hold a vector
LEAST_HUBS = 16     # hubs of small tables
ROUTERS = 4         # tasks that search for the classes of a shard
CHUNK = 2_048       # classes of a row of the written shards
ROWS_AT_ONCE = 256  # queries that a beam search takes step by step together
TILE = 1 << 22      # cosines of a tile
WIDE_ROWS = 16_384  # queries of a task that are compared with a whole shard
MARGIN = 1e-5       # by which cosines of 64 components in single precision may be off
_NONE = -1
LOG = logging.getLogger(__name__)


class Graph(NamedTuple):
    vectors: np.ndarray       # (n, d) unit vectors, single precision
    layers: list[np.ndarray]  # lowest first: (n, neighbours), -1 where there are fewer
    entry: int


def _unique_top(ids: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best distinct ids of each row, best first; -1 fills up."""
    order = np.lexsort((-sims, ids), axis=1)
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    again = np.zeros(ids.shape, dtype=bool)
    again[:, 1:] = ids[:, 1:] == ids[:, :-1]
    sims = np.where(again | (ids < 0), -np.inf, sims)
    best = np.argsort(-sims, axis=1, kind="stable")[:, :k]
    ids, sims = np.take_along_axis(ids, best, 1), np.take_along_axis(sims, best, 1)
    return np.where(np.isinf(sims), _NONE, ids), sims


def _similar(vectors: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    sims = np.einsum("qd,qkd->qk", queries, vectors[np.maximum(ids, 0)])
    return np.where(ids < 0, -np.inf, sims)


def beam_search(graph_layer: np.ndarray, vectors: np.ndarray, queries: np.ndarray, start: np.ndarray,
                width: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``width`` best nodes found for each query from its start nodes, many queries step by step together."""
    ids = np.full((len(queries), width), _NONE)
    sims = np.full((len(queries), width), -np.inf, dtype=vectors.dtype)
    if not len(queries):
        return ids, sims
    links = graph_layer.shape[1]
    take = min(4, width)  # the best unopened nodes of a beam are opened together
    tags = np.arange(1, take * links + 1, dtype=np.uint16)
    seen = np.zeros((min(ROWS_AT_ONCE, len(queries)), len(vectors)), dtype=np.uint16)
    for lo in range(0, len(queries), ROWS_AT_ONCE):
        some = slice(lo, lo + ROWS_AT_ONCE)
        ids[some], sims[some] = _beam(graph_layer, vectors, queries[some], start[some, :width], width, tags, seen)
    return ids, sims


def _beam(graph_layer: np.ndarray, vectors: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int,
          tags: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``beam_search`` of queries that step together; ``seen`` is used to mark the nodes that a query has met."""
    n, take = len(queries), len(tags) // graph_layer.shape[1]
    ids = np.full((n, width), _NONE)
    ids[:, : start.shape[1]] = start
    sims = np.full((n, width), -np.inf, dtype=vectors.dtype)
    sims[:, : start.shape[1]] = _similar(vectors, queries, start)
    opened = ids < 0
    seen[:n] = 0
    met, base = seen.reshape(-1), np.arange(n) * len(vectors)
    met[(base[:, None] + start)[start >= 0]] = 1
    live = np.arange(n)
    while len(live):
        s = np.where(opened[live], -np.inf, sims[live])
        pick = np.argpartition(-s, take - 1, axis=1)[:, :take]
        usable = ~np.isinf(np.take_along_axis(s, pick, 1))
        go = usable.any(axis=1)
        live, pick, usable = live[go], pick[go], usable[go]
        if not len(live):
            break
        node = np.where(usable, np.take_along_axis(ids[live], pick, 1), _NONE)
        opened[live[:, None], pick] = True
        near = np.where(node[:, :, None] < 0, _NONE, graph_layer[np.maximum(node, 0)]).reshape(len(live), -1)
        at = base[live][:, None] + near
        row, col = np.nonzero((near >= 0) & (met.take(at, mode="clip") == 0))
        at = at[row, col]
        met[at] = tags[col]  # of a node that comes twice in this step the last one stays
        new = met.take(at) == tags[col]
        row, col = row[new], col[new]
        fresh = np.full(near.shape, -np.inf, dtype=vectors.dtype)
        fresh[row, col] = np.einsum("nd,nd->n", vectors.take(near[row, col], axis=0), queries.take(live[row], axis=0))
        # keep the best
        all_sims = np.concatenate((sims[live], fresh), axis=1)
        best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        s = np.take_along_axis(all_sims, best, 1)
        none = np.isinf(s)
        done = np.concatenate((opened[live], np.zeros(near.shape, dtype=bool)), axis=1)
        sims[live], opened[live] = s, np.take_along_axis(done, best, 1) | none
        ids[live] = np.where(none, _NONE, np.take_along_axis(np.concatenate((ids[live], near), axis=1), best, 1))
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _descend(graph: Graph, queries: np.ndarray, down_to: int) -> np.ndarray:
    """Start nodes of each query on layer ``down_to``."""
    at = np.full((len(queries), 1), graph.entry)
    for layer in graph.layers[:down_to:-1]:
        at = beam_search(layer, graph.vectors, queries, at, DESCENT)[0]
    return at


def build(vectors: np.ndarray, seed: int = 1, batch: int = 512) -> Graph:
    """Graph of unit vectors; inserted in growing batches, each searched in the graph so far and against itself."""
    n = len(vectors)
    rng = np.random.default_rng(seed)
    level = np.minimum((-np.log(rng.random(n)) / np.log(LINKS)).astype(int), 6)
    order = np.argsort(-level, kind="stable")  # the highest come first, so that every layer has its entry
    top = int(level[order[0]]) if n else 0
    layers = [np.full((n, LINKS * (2 if k == 0 else 1)), _NONE, dtype=np.int32) for k in range(top + 1)]
    graph = Graph(vectors, layers, int(order[0]) if n else 0)
    at = min(n, 64)
    bounds = [0, at] if n else [0]
    while at < n:
        at = min(n, at + min(batch, at))
        bounds.append(at)
    for lo, hi in zip(bounds, bounds[1:]):
        own = order[lo:hi]
        for k in range(top + 1):
            new = own[level[own] >= k]
            if not len(new):
                continue
            q = vectors[new]
            # the batch against itself
            sims = q @ q.T
            np.fill_diagonal(sims, -np.inf)
            best = np.argsort(-sims, axis=1)[:, : min(len(new), BEAM_BUILD)]
            cand, csim = new[best], np.take_along_axis(sims, best, 1)
            cand = np.where(np.isinf(csim), _NONE, cand)
            if lo:
                # the start is a node of this layer: those inserted first are on all layers
                found, fsim = beam_search(layers[k], vectors, q, _descend(graph, q, k), BEAM_BUILD)
                cand, csim = np.concatenate((cand, found), 1), np.concatenate((csim, fsim), 1)
            _connect(layers[k], vectors, new, cand, csim)
    return graph


def _diverse(vectors: np.ndarray, cand: np.ndarray, sims: np.ndarray, m: int) -> np.ndarray:
    """Up to m of each row's candidates (best first): those nearer to the node than to any chosen one, then the best others."""
    n, c = cand.shape
    v = vectors[np.maximum(cand, 0)]
    among = np.einsum("ncd,nkd->nck", v, v)
    chosen = np.zeros((n, c), dtype=bool)
    for j in range(c):
        worst = np.where(chosen, among[:, j], -np.inf).max(axis=1)
        chosen[:, j] = (cand[:, j] >= 0) & (worst < sims[:, j]) & (chosen.sum(axis=1) < m)
    # fill up with the best that were left out
    rank = np.where(cand < 0, 3 * c, np.where(chosen, 0, c)) + np.arange(c)
    pick = np.argsort(rank, axis=1)[:, :m]
    out = np.take_along_axis(np.where(cand < 0, _NONE, cand), pick, 1)
    if out.shape[1] < m:
        out = np.concatenate((out, np.full((n, m - out.shape[1]), _NONE)), 1)
    return out


def _connect(layer: np.ndarray, vectors: np.ndarray, new: np.ndarray, cand: np.ndarray, sims: np.ndarray) -> None:
    """Link new nodes with the best of their candidates, both ways."""
    m = layer.shape[1]
    ids, s = _unique_top(cand, sims, BEAM_BUILD)
    layer[new] = _diverse(vectors, ids, s, m)
    # back links: every node that was chosen gets the new ones as candidates
    src = np.repeat(new, m)
    dst = layer[new].ravel()
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
    for lo in range(0, len(nodes), 2048):
        some, f, c = nodes[lo:lo + 2048], first[lo:lo + 2048], np.minimum(count[lo:lo + 2048], 4 * m)
        wide = np.full((len(some), int(c.max())), _NONE)
        at = np.arange(wide.shape[1])
        has = at < c[:, None]
        wide[has] = src[(f[:, None] + at)[has]]
        every = np.concatenate((layer[some], wide), 1)
        ids, s = _unique_top(every, _similar(vectors, vectors[some], every), min(every.shape[1], 2 * m))
        layer[some] = _diverse(vectors, ids, s, m)


def _margin(vectors: np.ndarray) -> float:
    return MARGIN * max(1.0, vectors.shape[1] / 64)


# ---- range search ------------------------------------------------------------------------------

def _beams(graph: Graph, queries: np.ndarray, low: float, width: int,
           limit: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(queries, nodes, similarities, whether ``limit`` nodes are too few): beams of ``width`` nodes, widened twice as
    wide each time while they end at ``low`` or more."""
    n = len(graph.vectors)
    limit = min(limit, n)
    for at in range(0, len(queries), 2048):
        part = queries[at:at + 2048]
        start = _descend(graph, part, 0)
        todo, w = np.arange(len(part)), min(width, limit)
        while len(todo):
            ids, sims = beam_search(graph.layers[0], graph.vectors, part[todo], start[todo], w)
            full = (sims[:, -1] >= low) & (w < n)
            yield at + todo[~full], ids[~full], sims[~full], False
            if w == limit:
                yield at + todo[full], ids[full], sims[full], True
                break
            todo, w = todo[full], min(2 * w, limit)


def _range_search(graph: Graph, queries: np.ndarray, threshold: float, width: int,
                  limit: int) -> Iterator[tuple[int, np.ndarray | None]]:
    """(query, nodes) with similarity of about the threshold or more (single precision, with a margin).

    None instead of the nodes: a beam of ``limit`` nodes is too narrow.
    """
    low = threshold - _margin(queries)
    for some, ids, sims, full in _beams(graph, queries, low, width, limit):
        for k, i in enumerate(some.tolist()):
            yield i, None if full else ids[k][sims[k] >= low]


def _verified(graph: Graph, exact: np.ndarray, queries: np.ndarray, threshold: float, width: int,
              limit: int) -> Iterator[tuple[int, np.ndarray | None]]:
    """``_range_search`` with the cosines of its nodes verified in double precision."""
    for i, h in _range_search(graph, queries.astype(np.float32), threshold, width, limit):
        yield i, h if h is None else h[(exact[h] @ queries[i]) >= threshold]


def _compared(exact: np.ndarray, queries: np.ndarray, threshold: float) -> Iterator[tuple[int, np.ndarray]]:
    """(query, nodes) by comparison with every vector, queries without any left out, a tile of the matrix product at a time.

    The product is in single precision; cosines too close to the threshold for that are computed in double precision.
    """
    step, margin = max(1, TILE // max(1, len(exact))), _margin(exact)
    single, asking = exact.astype(np.float32), queries.astype(np.float32)
    for at in range(0, len(queries), step):
        sims = asking[at:at + step] @ single.T
        near = sims >= threshold - margin
        for k in np.flatnonzero(near.any(axis=1)).tolist():
            h = np.flatnonzero(near[k])
            close = np.flatnonzero(sims[k, h] < threshold + margin)
            if len(close):
                h = np.delete(h, close[exact[h[close]] @ queries[at + k] < threshold])
            if len(h):
                yield at + k, h


def search(graph: Graph, exact: np.ndarray, queries: np.ndarray, threshold: float = THRESHOLD, beam: int = BEAM,
           recall: float = RECALL, audit: int = 64) -> tuple[list[np.ndarray], float, int]:
    """(hits of each query, audited recall, beam) against one graph in memory; beam 0: every vector was compared.

    ``exact`` and ``queries`` are unit vectors in double precision; hits are verified with them.
    """
    n = len(exact)
    sample = queries[::max(1, len(queries) // audit)]
    total = sum(len(h) for _, h in _compared(exact, sample, threshold))
    while beam <= n:
        got = sum(len(h) for _, h in _verified(graph, exact, sample, threshold, beam, n))
        if got >= recall * total:
            found = dict(_verified(graph, exact, queries, threshold, beam, n))
            return [found[i] for i in range(len(queries))], got / total if total else 1.0, beam
        beam *= 2
    # a graph that falls apart: no beam is wide enough, every vector is compared
    found = dict(_compared(exact, queries, threshold))
    return [found.get(i, np.zeros(0, dtype=np.int64)) for i in range(len(queries))], 1.0, 0


# ---- hubs and cells ------------------------------------------------------------------------------

class Routes(NamedTuple):
    hubs: np.ndarray   # the hubs that the queries' beams found, best first, one query's after the other's
    sizes: np.ndarray  # their number for each query
    far: np.ndarray    # queries that are compared with every vector: no beam was wide enough


def routes(graph: Graph | None, queries: np.ndarray, threshold: float, width: int, limit: int) -> Routes:
    """Beams of the queries (unit vectors) in the graph of the hubs.

    A vector within the threshold's angle of a query may hang on a hub within twice that angle, so a beam
    that ends there is widened.  Without hubs, or if ``limit`` hubs are too few, a query is ``far``; of its hubs only
    those on which its vector hangs are kept.
    """
    n = len(queries)
    found, sizes, far = np.zeros((n, 0), dtype=np.int32), np.zeros(n, dtype=np.int32), np.ones(n, dtype=bool)
    if graph is not None:
        for some, ids, _, full in _beams(graph, queries.astype(np.float32), _twice(threshold), width, limit):
            ids = ids[:, :HOMES] if full else ids
            if found.shape[1] < ids.shape[1]:
                found = np.pad(found, ((0, 0), (0, ids.shape[1] - found.shape[1])), constant_values=_NONE)
            found[some, : ids.shape[1]], sizes[some], far[some] = ids, (ids >= 0).sum(axis=1), full
    return Routes(found[np.arange(found.shape[1]) < sizes[:, None]], sizes, far)


def _twice(threshold: float) -> float:
    """Cosine of twice the threshold's angle."""
    return 2 * threshold * threshold - 1 if threshold > 0 else -1.0


def homes(found: Routes) -> np.ndarray:
    """(n, HOMES): the hubs on which vectors hang, the nearest that their beams found; -1 where there are fewer."""
    at = np.arange(HOMES)
    first = np.cumsum(found.sizes) - found.sizes
    has = at < found.sizes[:, None]
    out = np.full(has.shape, _NONE, dtype=np.int32)
    out[has] = found.hubs[(first[:, None] + at)[has]]
    return out


def _sorted(hubs: np.ndarray) -> np.ndarray:
    """Stable order of numbers of hubs; short ones are sorted faster."""
    if len(hubs) and hubs.max() < 0xFFFF:
        hubs = hubs.astype(np.uint16)
    return np.argsort(hubs, kind="stable")


def _true(exact: np.ndarray, queries: np.ndarray, i: np.ndarray, j: np.ndarray, threshold: float) -> np.ndarray:
    """Whether query ``i`` and vector ``j`` reach the threshold in double precision, a bounded number at once."""
    parts = (slice(at, at + (1 << 16)) for at in range(0, len(i), 1 << 16))
    return np.concatenate([np.zeros(0, dtype=bool), *(
        np.einsum("nd,nd->n", exact[j[p]], queries[i[p]]) >= threshold for p in parts)])


def _met(exact: np.ndarray, cells: np.ndarray, queries: np.ndarray, found: Routes, threshold: float,
         limit: int) -> Iterator[tuple[int, np.ndarray | None]]:
    """(query, nodes) that reach the threshold among the vectors that hang (``cells``) on the hubs found; queries without any are left out.

    Each cell meets the queries that found its hub, in tiles of the matrix product (single precision, with a
    margin); what is left is verified in double precision.  None instead of the nodes: ``limit`` or more, or a far
    query.  A vector may be met in several cells, so a query goes on until it has met ``limit`` for certain.
    """
    low, single, asking = threshold - _margin(exact), exact.astype(np.float32), queries.astype(np.float32)
    who = np.repeat(np.arange(len(queries)), found.sizes)
    order = _sorted(found.hubs)
    who, asked = who[order], found.hubs[order]
    member = np.flatnonzero(cells >= 0)
    of = cells.ravel()[member]
    order = _sorted(of)
    of, member = of[order], member[order] // cells.shape[1]
    hubs = np.unique(asked)
    some = zip(*(np.searchsorted(x, hubs, side=side).tolist() for x in (asked, of) for side in ("left", "right")))
    most, held = limit * cells.shape[1], 0
    count, pairs = np.where(found.far, most, 0), [np.zeros(0, dtype=np.int64)]
    for lo, hi, first, last in some:
        if first == last:
            continue
        nodes = member[first:last]
        near = single[nodes].T
        step = max(1, TILE // len(nodes))
        for at in range(lo, hi, step):
            q = who[at:min(hi, at + step)]
            q = q[count[q] < most]
            sims = asking.take(q, axis=0) @ near
            hot = np.flatnonzero(sims.max(axis=1) >= low)
            if not len(hot):
                continue
            q, hit = q[hot], sims[hot] >= low
            n = hit.sum(axis=1)
            count[q] += np.where(n < limit, n, most)
            hit[count[q] >= most] = False
            i, j = np.nonzero(hit)
            i, j = q[i], nodes[j]
            true = _true(exact, queries, i, j, threshold)
            pairs.append(i[true] * len(exact) + j[true])
            held += len(pairs[-1])
            if held > TILE:
                pairs, held = [np.unique(np.concatenate(pairs))], 0
    i, j = np.divmod(np.unique(np.concatenate(pairs)), max(1, len(exact)))
    count[np.bincount(i, minlength=len(count)) >= limit] = most
    for k in np.flatnonzero(count >= most).tolist():
        yield k, None
    few = count[i] < most
    i, j = i[few], j[few]
    query, first = np.unique(i, return_index=True)
    for k, nodes in zip(query.tolist(), np.split(j, first[1:])):
        yield k, nodes


def _join(root: np.ndarray, nodes: np.ndarray) -> None:
    """Join ``nodes`` in a forest where no root has a greater number than its members."""
    r = root[nodes]
    while not np.array_equal(up := root[r], r):
        r = up
    root[r] = root[nodes] = r.min()


def _reduced(keys: np.ndarray, weights: np.ndarray, ask: np.ndarray,
             found: Iterable[tuple[int, np.ndarray | None]]) -> pd.DataFrame:
    """(key, n_links, other, wide) of queries ``ask``; each one's nodes are counted, joined and dropped."""
    links, first = np.zeros(len(ask), dtype=np.int64), np.full(len(ask), _NONE)
    wide = np.zeros(len(ask), dtype=bool)
    root = np.arange(len(keys))
    for i, h in found:
        if h is None:
            wide[i] = True
            continue
        h = h[keys[h] != ask[i]]  # a class is not its own neighbour
        if len(h):
            links[i], first[i] = weights[h].sum(), h[0]
            _join(root, h)
    while not np.array_equal(up := root[root], root):
        root = up
    # a query joins all it hits: one link to their common root is enough, and roots are joined with their members
    some, m, beyond = np.flatnonzero(first >= 0), np.flatnonzero(root != np.arange(len(keys))), np.flatnonzero(wide)
    none = np.zeros(len(beyond), dtype=np.int64)
    return pd.DataFrame({
        "key": np.concatenate((ask[some], keys[m], ask[beyond])),
        "n_links": np.concatenate((links[some], np.zeros(len(m), dtype=np.int64), none)),
        "other": np.concatenate((keys[root[first[some]]], keys[root[m]], none)),
        "wide": np.repeat((False, True), (len(some) + len(m), len(beyond)))})


# ---- Spark -------------------------------------------------------------------------------------

def _usable(v: Column) -> Column:
    """Whether a vector can link: no null or non-finite component, not zero."""
    d = v.cast("array<double>")
    bad = F.exists(d, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(d, lambda x: x != 0), F.lit(False))


def classes(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(key, vec, n, first): classes of equal usable vectors; key: hash of the components, n: rows."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    v = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # -0 is 0
    d = vectors.where(_usable(F.col(f"`{vec_col}`"))).select(F.col(f"`{id_col}`").alias("id"), v.alias("vec"))
    return d.groupBy("vec").agg(F.count("*").alias("n"), F.min("id").alias("first"))


def class_key(vec: str) -> Column:
    """First choice of a class's key."""
    return F.xxhash64(vec)


def _again(df: DataFrame, clash: DataFrame, level: int) -> DataFrame:
    """``df`` with other keys for the vectors whose key is in ``clash``."""
    c = clash.select(F.col("key").alias("__key"), F.lit(True).alias("__clash"))
    other = F.when(F.col("__clash"), F.xxhash64(F.lit(level), F.col("vec"))).otherwise(F.col("key"))
    return df.join(c, df["key"] == c["__key"], "left").withColumn("key", other).drop("__key", "__clash")


def keyed(cls: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``cls`` with a 64-bit ``key``, distinct for distinct vectors, and the keys that had to be chosen again, round by round.

    Among billions of vectors two may have one hash: such vectors get another one until no key is shared.
    """
    cls = scratch(cls.withColumn("key", class_key("vec")), "classes")
    clashes: list[DataFrame] = []
    while True:
        clash = cls.groupBy("key").agg(F.count("*").alias("c")).where("c > 1").select("key")
        if clash.isEmpty():
            return cls, clashes
        clashes.append(scratch(clash, "clash"))
        cls = scratch(_again(cls, clashes[-1], len(clashes)), "classes")


def _bounded(rows: int, dim: int) -> int:
    """As many vectors of ``dim`` components as hold the values of ``rows`` vectors of 64."""
    return max(1, rows * 64 // max(64, dim))


def _shard_of(shards: int) -> Column:
    return F.pmod(F.xxhash64("key", F.lit(1)), F.lit(shards)).cast("int")


def _unit(rows: pd.Series) -> np.ndarray:
    return _units(np.array(rows.to_list(), dtype=np.float64))


def _units(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # lengths neither overflow nor vanish
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _packed(v: np.ndarray) -> bytes:
    """Vectors as bytes, in single precision where that holds them exactly."""
    with np.errstate(over="ignore"):
        single = v.astype(np.float32)
    return (single if np.array_equal(single, v) else v).tobytes()


def _unpacked(data: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, dtype=np.float32 if len(data) == 4 * n * dim else np.float64).reshape(n, dim).astype(np.float64)


HUB_SCHEMA = "dim int, vectors binary, layers array<binary>, entry int"


def hub_graphs(cls: DataFrame, n: int, rows: int) -> DataFrame:
    """One row for each length of vectors: the graph of its hubs.

    The hubs are hash-chosen, one of ``CELL`` classes, ``LEAST_HUBS`` at least and ``rows`` at most or so.  A length
    without hubs has few vectors, which are compared with each other.
    """
    hi = max(_PARTS // CELL, -(-_PARTS * LEAST_HUBS // max(1, n)))
    hi = max(1, min(_PARTS, hi, _PARTS * rows // max(1, n)))
    hubs = cls.where(F.pmod(F.xxhash64("key", F.lit(4)), F.lit(_PARTS)) < hi).select("dim", "key", "vec")

    def run(f: pd.DataFrame) -> pd.DataFrame:
        g = build(_unit(f.sort_values("key")["vec"]).astype(np.float32))
        return pd.DataFrame({"dim": [g.vectors.shape[1]], "vectors": [g.vectors.tobytes()],
                             "layers": [[x.tobytes() for x in g.layers]], "entry": [g.entry]})

    ship_package(cls.sparkSession)
    return hubs.groupBy("dim").applyInPandas(run, HUB_SCHEMA)


def _hubs(rows: pd.DataFrame) -> Graph | None:
    """Graph of the hubs."""
    if not len(rows):
        return None
    row = rows.iloc[0]
    v = np.frombuffer(row["vectors"], dtype=np.float32).reshape(-1, int(row["dim"]))
    return Graph(v, [np.frombuffer(x, dtype=np.int32).reshape(len(v), -1) for x in row["layers"]], int(row["entry"]))


#: layers: the hubs on which the vectors hang; the hubs, numbers of hubs and far queries of their Routes.
GRAPH_SCHEMA = "dim int, shard int, chunk int, keys binary, weights binary, vectors binary, layers array<binary>"


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _none(schema: str) -> pd.DataFrame:
    return pd.DataFrame(columns=_names(schema), dtype=object)


def _dealt(df: DataFrame, groups: int, *by: str) -> DataFrame:
    """``df`` dealt out by ``by`` to several times as many partitions as there are groups, so that few meet in a task."""
    return df.repartition(min(1 << 14, 4 * groups), *by)


def build_graphs(cls: DataFrame, shards: int, hubs: DataFrame, threshold: float, beam: int) -> DataFrame:
    """The lowest layer of each shard, a row for each ``CHUNK`` of its classes: keys, weights, vectors and their routes as queries.

    Every class is searched once in the graph of the hubs, whatever the number of shards.
    """
    def run(hub: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        if not len(f):
            return _none(GRAPH_SCHEMA)
        f = f.sort_values("key", ignore_index=True)
        v = np.array(f["vec"].to_list(), dtype=np.float64)
        found = routes(_hubs(hub), _units(v), threshold, beam, LIMIT)
        cells, ends = homes(found), np.concatenate(([0], np.cumsum(found.sizes)))
        step, out = _bounded(CHUNK, v.shape[1]), []
        for lo in range(0, len(v), step):
            hi = min(len(v), lo + step)
            layers = (cells[lo:hi], found.hubs[ends[lo]:ends[hi]], found.sizes[lo:hi], found.far[lo:hi].astype(np.int8))
            out.append((v.shape[1], int(f["shard"].iloc[0]), lo // step * ROUTERS + int(f["part"].iloc[0]), f["key"].to_numpy()[lo:hi].tobytes(),
                        f["n"].to_numpy()[lo:hi].tobytes(), _packed(v[lo:hi]), [x.tobytes() for x in layers]))
        return pd.DataFrame(out, columns=_names(GRAPH_SCHEMA))

    ship_package(cls.sparkSession)
    by = ["dim", "shard", "part"]
    part = F.pmod(F.xxhash64("key", F.lit(5)), F.lit(ROUTERS)).cast("int")
    rows = cls.select("dim", _shard_of(shards).alias("shard"), part.alias("part"), "key", "n", "vec")
    every = (hubs.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(ROUTERS - 1)))))
    rows, every = (_dealt(t, shards * ROUTERS, *by) for t in (rows, every))
    return every.groupBy(*by).cogroup(rows.groupBy(*by)).applyInPandas(run, GRAPH_SCHEMA)


LINK_SCHEMA = "dim int, shard int, key long, n_links long, other long, wide boolean"


def _keys(chunks: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(chunks["keys"]), dtype=np.int64)


def _vectors(chunks: pd.DataFrame) -> np.ndarray:
    """Unit vectors of a shard's rows."""
    return _units(np.concatenate([_unpacked(v, len(k) // 8, int(d)) for v, k, d in
                                  zip(chunks["vectors"], chunks["keys"], chunks["dim"])]))


def _shard(chunks: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, weights and unit vectors of a shard."""
    return _keys(chunks), np.frombuffer(b"".join(chunks["weights"]), dtype=np.int64), _vectors(chunks)


def _cells(chunks: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(x[0] for x in chunks["layers"]), dtype=np.int32).reshape(-1, HOMES)


def _routes(chunks: pd.DataFrame) -> Routes:
    """Routes of a shard's classes as queries, from the last three of its layers."""
    hubs, sizes, far = (b"".join(x[k] for x in chunks["layers"]) for k in (-3, -2, -1))
    return Routes(np.frombuffer(hubs, dtype=np.int32), np.frombuffer(sizes, dtype=np.int32),
                  np.frombuffer(far, dtype=np.int8) == 1)


def _by_block(graphs: DataFrame, asked: DataFrame, blocks: int, run, schema: str) -> DataFrame:
    """``run(graph, queries)`` for the queries of each shard (dim, shard, key, vec), block by block."""
    by = ["dim", "shard", "block"]
    every = graphs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(blocks)).cast("int"))
    names = _names(schema)

    def task(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(graph) or not len(queries):
            return _none(schema)
        out = run(graph.sort_values("chunk"), queries.sort_values("key", ignore_index=True))
        return out.assign(dim=int(graph["dim"].iloc[0]), shard=int(graph["shard"].iloc[0]))[names]

    return every.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(task, schema)


def _asked(cls: DataFrame, shards: int) -> DataFrame:
    """Every class as a query against every shard."""
    return cls.select("dim", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "key", "vec")


class Audit(NamedTuple):
    recall: float  # of the links seen: the lower one of queries with up to and over a beam of links
    beam: int      # 0: no beam has the recall, every vector is compared
    links: int     # true links of stored vectors that the recall was measured on
    planted: int   # and of planted queries
    part: float    # part of the classes that was compared with all others


def true_links(asked: DataFrame, graphs: DataFrame, blocks: int, threshold: float) -> DataFrame:
    """(dim, shard, key, truth): number of linked classes of each query (dim, shard, key, vec) that has any in the shard."""
    def run(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        keys, _, exact = _shard(graph)
        ask = queries["key"].to_numpy()
        truth = np.zeros(len(ask), dtype=np.int64)
        for i, h in _compared(exact, _unit(queries["vec"]), threshold):
            truth[i] = (keys[h] != ask[i]).sum()
        return pd.DataFrame({"key": ask, "truth": truth})[truth > 0]

    return _by_block(graphs.drop("layers"), asked, blocks, run, "dim int, shard int, key long, truth long")


ROUTE_SCHEMA = "dim int, key long, route array<int>"


def routed(asked: DataFrame, hubs: DataFrame, blocks: int, threshold: float, beam: int) -> DataFrame:
    """(dim, key, route) of queries (dim, key, vec): what ``beam`` finds in the graph of the hubs."""
    by = ["dim", "block"]
    every = hubs.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("key", F.lit(2)), F.lit(blocks)).cast("int"))

    def task(hub: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(queries):
            return _none(ROUTE_SCHEMA)
        queries = queries.sort_values("key", ignore_index=True)
        found = routes(_hubs(hub), _unit(queries["vec"]), threshold, beam, LIMIT)
        route = [x.tolist() for x in np.split(found.hubs, np.cumsum(found.sizes)[:-1])]
        return pd.DataFrame({"dim": queries["dim"], "key": queries["key"],
                             "route": [None if f else r for f, r in zip(found.far, route)]})

    return every.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(task, ROUTE_SCHEMA)


def found_links(seen: DataFrame, graphs: DataFrame, hubs: DataFrame, blocks: int, threshold: float, beam: int) -> DataFrame:
    """(dim, shard, key, truth, found) of queries (dim, shard, key, vec, truth) searched with a beam."""
    ways = routed(seen.select("dim", "key", "vec").dropDuplicates(["dim", "key"]), hubs, blocks, threshold, beam)

    def run(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        keys, _, exact = _shard(graph)
        ask, truth, route = queries["key"].to_numpy(), queries["truth"].to_numpy(), queries["route"].to_list()
        far = np.array([r is None for r in route])
        sizes = np.array([0 if r is None else len(r) for r in route])
        hub = np.concatenate([np.zeros(0, dtype=np.int32), *(r for r in route if r is not None)]).astype(np.int32)
        found = np.zeros(len(ask), dtype=np.int64)
        for i, h in _met(exact, _cells(graph), _unit(queries["vec"]), Routes(hub, sizes, far), threshold, LIMIT):
            found[i] = truth[i] if h is None else min(truth[i], (keys[h] != ask[i]).sum())  # what is compared later is found
        return pd.DataFrame({"key": ask, "truth": truth, "found": found})

    return _by_block(graphs, seen.join(ways, ["dim", "key"]), blocks, run,
                     "dim int, shard int, key long, truth long, found long")


def planted(some: DataFrame, shards: int, threshold: float) -> DataFrame:
    """Queries (dim, shard, key, vec) beside stored vectors: each is turned from a class of ``some`` to a cosine that the
    hash of its key draws between the threshold and 1, and asks the shard of that class.  So each has a true link there."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            if not len(f):
                continue
            out = []
            for key, vec in zip(f["key"], f["vec"]):
                rng = np.random.default_rng(key & 0x7FFFFFFFFFFFFFFF)
                u = _unit(pd.Series([vec]))[0]
                w = rng.normal(size=len(u))
                w -= (w @ u) * u
                c = threshold + (1 - threshold) * rng.uniform(0.02, 0.98)
                length = np.sqrt(w @ w)
                out.append((c * u + np.sqrt(1 - c * c) * w / length if length > 1e-9 else u).tolist())
            yield f.assign(vec=out)

    turned = map_pandas(some.select("dim", _shard_of(shards).alias("shard"), "key", "vec"), run,
                        "dim int, shard int, key long, vec array<double>")
    return turned.withColumn("key", F.xxhash64(F.lit("planted"), "key"))


def audited(cls: DataFrame, graphs: DataFrame, hubs: DataFrame, shards: int, threshold: float, recall: float, n: int,
            rows: int) -> Audit:
    """The beam that finds ``recall`` of the true links of the audit, pooled over all shards.

    About ``AUDIT`` classes, chosen by hash, are compared with every vector; as near copies may be rare,
    as many queries are planted beside stored vectors and compared with one shard each.  ``rows``: classes
    that a task may hold as queries.
    """
    if not n:
        return Audit(1.0, BEAM, 0, 0, 1.0)
    hi = min(_PARTS, -(-AUDIT * _PARTS // n))
    some = cls.where(F.pmod(F.xxhash64("key", F.lit(3)), F.lit(_PARTS)) < hi)
    asked = -(-n * hi // _PARTS)
    few = F.col("truth") < LIMIT
    true = scratch(true_links(_asked(some, shards), graphs, -(-asked // rows), threshold), "audit")
    plants = scratch(planted(some, shards, threshold), "planted")
    known = scratch(true_links(plants, graphs, -(-asked // rows), threshold), "audit")
    links, made = (int(t.agg(F.coalesce(F.sum("truth"), F.lit(0))).first()[0]) for t in (true, known))
    seen = true.join(cls.select("key", "vec"), "key").unionByName(known.join(plants.select("key", "vec"), "key"))
    seen = scratch(seen, "audit-queries")
    most = seen.groupBy("dim", "shard").count().agg(F.max("count")).first()[0]
    beam, least = BEAM, 1.0
    while beam <= LIMIT:
        got = found_links(seen, graphs, hubs, -(-most // rows), threshold, beam)
        least = min(r[1] / r[2] for r in got.groupBy(few).agg(F.sum("found"), F.sum("truth")).collect())
        if least >= recall:
            break
        beam *= 2
    else:
        least, beam = 1.0, 0
    for t in (true, plants, known, seen):
        drop_scratch(t)
    return Audit(least, beam, links, made, hi / _PARTS)


def graph_links(graphs: DataFrame, shards: int, parts: int, threshold: float) -> DataFrame:
    """Rows of LINK_SCHEMA: for each class and shard with hits the vectors linked, and links between classes.

    Each shard meets the classes of all shards as queries, in ``parts`` tasks.  ``wide``: only says that the class
    has as many links in the shard as the widest beam or more.
    """
    by = ["dim", "shard", "part"]

    def run(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        if not len(graph) or not len(queries):
            return _none(LINK_SCHEMA)
        graph = graph.sort_values("chunk")
        keys, weights, exact = _shard(graph)
        cells = _cells(graph)
        blocks = [b.sort_values("chunk") for _, b in queries.groupby("block")]
        ask = [_keys(b) for b in blocks]

        def every() -> Iterator[tuple[int, np.ndarray | None]]:
            first = 0
            for b, k in zip(blocks, ask):
                for i, h in _met(exact, cells, _vectors(b), _routes(b), threshold, LIMIT):
                    yield first + i, h
                first += len(k)

        out = _reduced(keys, weights, np.concatenate(ask), every())
        return out.assign(dim=int(graph["dim"].iloc[0]), shard=int(graph["shard"].iloc[0]))[_names(LINK_SCHEMA)]

    stored = graphs.select("dim", "shard", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), "chunk", "keys",
                           "weights", "vectors", F.slice("layers", 1, 1).alias("layers"))
    asking = graphs.select("dim", F.col("shard").alias("block"), F.pmod("shard", F.lit(parts)).alias("part"), "chunk", "keys",
                           "vectors", F.slice("layers", 2, 3).alias("layers"))
    asking = asking.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    stored, asking = (_dealt(t, shards * parts, *by) for t in (stored, asking))
    return stored.groupBy(*by).cogroup(asking.groupBy(*by)).applyInPandas(run, LINK_SCHEMA)


def compared_links(asked: DataFrame, graphs: DataFrame, blocks: int, threshold: float) -> DataFrame:
    """Rows of LINK_SCHEMA for queries (dim, shard, key, vec) that are compared with every vector of the shard."""
    def run(graph: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        keys, weights, exact = _shard(graph)
        found = _compared(exact, _unit(queries["vec"]), threshold)
        return _reduced(keys, weights, queries["key"].to_numpy(), found)

    return _by_block(graphs.drop("layers"), asked, blocks, run, LINK_SCHEMA)


def links(cls: DataFrame, graphs: DataFrame, hubs: DataFrame, shards: int, threshold: float, beam: int, n: int,
          wide_rows: int) -> DataFrame:
    """(key, n_links, other) of all ``n`` classes; beam 0: every vector is compared, ``wide_rows`` queries in a task."""
    if not beam:
        every = compared_links(_asked(cls, shards), graphs, -(-n // wide_rows), threshold)
        return scratch(every.select("key", "n_links", "other"), "vector-links")
    if beam > BEAM:
        graphs = scratch(build_graphs(cls, shards, hubs, threshold, beam), "graphs")
    found = scratch(graph_links(graphs, shards, -(-shards // SHARDS_A_TASK), threshold), "vector-links")
    wide = found.where("wide").select("dim", "shard", "key")
    most = wide.groupBy("dim", "shard").count().agg(F.max("count")).first()[0]
    if most:
        asked = wide.join(cls.select("key", "vec"), "key")
        more = scratch(compared_links(asked, graphs, -(-most // wide_rows), threshold), "wide-links")
        found = found.where("not wide").unionByName(more)
    if beam > BEAM:
        drop_scratch(graphs)
    return found.select("key", "n_links", "other")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(id, n_links, component) of every row; component: smallest id reachable by links.

    The audit of the search is logged and kept as ``audit`` of the result.
    """
    written, clashes = keyed(classes(vectors, id_col, vec_col))
    cls = written.withColumn("dim", F.size("vec"))
    n, longest = cls.agg(F.count("*"), F.coalesce(F.max("dim"), F.lit(0))).first()
    rows = _bounded(ROWS_PER_SHARD, longest)
    shards = max(SHARDS, -(-n // rows))
    hubs = scratch(hub_graphs(cls, n, rows), "hubs")
    graphs = scratch(build_graphs(cls, shards, hubs, threshold, BEAM), "graphs")
    audit = audited(cls, graphs, hubs, shards, threshold, recall, n, rows)
    LOG.info("%s", audit)
    found = links(cls, graphs, hubs, shards, threshold, audit.beam, n, _bounded(WIDE_ROWS, longest))
    counted = found.groupBy("key").agg(F.sum("n_links").alias("links"))
    roots = components(found.select(F.col("key").alias("a"), F.col("other").alias("b")))
    named = (cls.select("key", "n", "first").join(counted, "key", "left")
             .join(roots.withColumnRenamed("node", "key"), "key", "left"))
    narrow = scratch(named, "named")
    named = with_best(narrow, "key", F.struct(F.col("first").isNull().alias("none"), F.col("first")))
    of_class = scratch(named.select("key", (F.coalesce("links", F.lit(0)) + F.col("n")).alias("links"),
                                    F.col("best.first").alias("component")), "vector-classes")
    for t in (narrow, graphs, hubs, written):  # the result reads none of these
        drop_scratch(t)
    v = F.col(f"`{vec_col}`").cast("array<double>")
    same = F.transform(v, lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = vectors.select(F.col(f"`{id_col}`").alias("id"), F.when(_usable(F.col(f"`{vec_col}`")), same).alias("vec"))
    rows = rows.withColumn("key", F.when(F.col("vec").isNotNull(), class_key("vec")))
    for level, clash in enumerate(clashes, 1):
        rows = _again(rows, clash, level)
    rows = rows.select("id", "key")
    out = rows.join(of_class, "key", "left")
    out = out.select("id", F.coalesce(F.col("links") - 1, F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("links").isNull(), F.col("id")).otherwise(F.col("component")).alias("component"))
    out.audit = audit
    return out
