"""Centroid clustering over dictionaries of distinct subvectors.

The integer vectors are cut into blocks of ``WIDTH`` dimensions.  Each task
dictionary-encodes, chunk by chunk and without loss, every block of its vectors
into the distinct subvectors and a code for each vector; the encoded chunks are
written once.  A round computes, for each chunk and block, the exact squared
distance of every distinct subvector to the block of every centroid, once; the
distance of a vector is the sum of these partial distances by its codes.  Sums
by cluster come the same way: codes are counted by cluster, and the counts
multiplied with the dictionary.

All arithmetic is in integers.  A round moves one row of sums for each cluster
and task; no vector is shuffled, so equal or similar vectors, however many,
never meet in one task.  To the driver go the centroids (clusters x dimensions).

Defined cases
* a vector that is null, has another number of dimensions, or holds a null or
  non-finite component is left out, as is one with a component of 2^21 or more
  in magnitude, whose squared distances would not fit 64 bits;
* null ids: kept, but such a row starts no centroid while others do;
* repeated rows are separate vectors; ties of distance go to the smaller
  cluster number, ties of the starting order (one id twice) to the lesser vector;
* fewer vectors than clusters: fewer clusters; empty table: empty result;
* further columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, map_arrow, scratch

WIDTH = 2
CHUNK = 32_768
LIMIT = float(1 << 21)


def usable(vectors: DataFrame, id_col: str, vec_col: str, dims: int) -> DataFrame:
    """(id, v): rows whose vector has ``dims`` finite components in range, as doubles."""
    v = F.col(f"`{vec_col}`").cast("array<double>")
    good = (F.size(v) == dims) & F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < F.lit(LIMIT)))
    return vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).where(good)


def _chosen(kept: DataFrame, k: int, scale: int, seed: str) -> list[list[int]]:
    """The first ``k`` vectors by the hash of their ids."""
    ints = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x))
    key = F.sha2(F.concat(F.lit(seed), F.col("id").cast("string")).cast("binary"), 256)
    rows = (kept.select(key.alias("key"), ints.alias("v"))
            .orderBy(F.asc_nulls_last("key"), "v").limit(k).collect())
    return [r.v for r in rows]


def encode_chunk(vectors: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """([distinct subvectors of each block], codes by block and vector)."""
    parts, codes = [], []
    for at in range(0, vectors.shape[1], width):
        block = vectors[:, at:at + width]
        code = np.zeros(len(block), dtype=np.int64)
        for column in block.T:  # the code of a longer stretch is the rank of (code, next component)
            distinct, number = np.unique(column, return_inverse=True)
            first, code = np.unique(code * len(distinct) + number, return_index=True, return_inverse=True)[1:]
        parts.append(block[first])
        codes.append(code)
    kind = np.uint16 if max((len(p) for p in parts), default=0) <= 1 << 16 else np.uint32
    return parts, np.array(codes, dtype=kind)


class Chunk:
    """Encoded vectors of one chunk."""

    def __init__(self, n: int, sizes: list[int], parts: bytes, codes: bytes, width: int, dims: int):
        self.n, self.dims = n, dims
        wide = [min(width, dims - at) for at in range(0, dims, width)]
        flat = np.frombuffer(parts, dtype=np.int64)
        ends = np.cumsum([s * w for s, w in zip(sizes, wide)])
        self.parts = [x.reshape(-1, w) for x, w in zip(np.split(flat, ends[:-1]), wide)]
        self.codes = np.frombuffer(codes, dtype=np.uint16 if max(sizes) <= 1 << 16 else np.uint32).reshape(len(wide), n)

    def distances(self, centroids: np.ndarray) -> np.ndarray:
        """Squared distance of each vector (row) to each centroid."""
        total = np.zeros((self.n, len(centroids)), dtype=np.int64)
        at = 0
        for part, code in zip(self.parts, self.codes):
            near = np.zeros((len(part), len(centroids)), dtype=np.int64)
            for i in range(part.shape[1]):
                near += (part[:, i:i + 1] - centroids[None, :, at + i]) ** 2
            total += near[code]
            at += part.shape[1]
        return total

    def sums(self, cluster: np.ndarray, k: int) -> np.ndarray:
        """Sum of the vectors of each cluster."""
        out = []
        for part, code in zip(self.parts, self.codes):
            count = np.bincount(cluster * len(part) + code, minlength=k * len(part)).reshape(k, len(part))
            out.append(count @ part)
        return np.concatenate(out, axis=1)


def encoded(kept: DataFrame, scale: int, dims: int, width: int) -> DataFrame:
    """One row for each chunk: ids, sizes of the dictionaries, the dictionaries and the codes."""
    kind = kept.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CHUNK):
                some = b.slice(at, CHUNK)
                ids, v = some.column(0), some.column(1)
                x = np.floor(scale * v.flatten().to_numpy(zero_copy_only=False)).astype(np.int64).reshape(-1, dims)
                parts, codes = encode_chunk(x, width)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    pa.array([[len(p) for p in parts]], pa.list_(pa.int32())),
                    pa.array([b"".join(np.ascontiguousarray(p).tobytes() for p in parts)], pa.binary()),
                    pa.array([codes.tobytes()], pa.binary())], names=["ids", "sizes", "parts", "codes"])

    return map_arrow(kept, run, f"ids array<{kind}>, sizes array<int>, parts binary, codes binary")


def _chunks(batches: Iterator[pa.RecordBatch], width: int, dims: int) -> Iterator[tuple[pa.Array, Chunk]]:
    for b in batches:
        for i in range(b.num_rows):
            ids = b.column(0).slice(i, 1).flatten()
            yield ids, Chunk(len(ids), b.column(1)[i].as_py(), b.column(2)[i].as_py(), b.column(3)[i].as_py(), width, dims)


def _sums(chunks: DataFrame, centroids: list[list[int]], width: int, dims: int) -> dict[int, tuple[int, list[int]]]:
    """{cluster: (vectors, sum of each dimension)} of an assignment."""
    at = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(at.shape, dtype=np.int64), np.zeros(len(at), dtype=np.int64)
        for _, chunk in _chunks(batches, width, dims):
            cluster = chunk.distances(at).argmin(axis=1)
            total += chunk.sums(cluster, len(at))
            count += np.bincount(cluster, minlength=len(at))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(at)), pa.int32()), pa.array(count), pa.array(total.tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "total"])

    told = map_arrow(chunks, run, "cluster int, n long, total array<bigint>")
    cells = told.select("cluster", F.posexplode(F.concat(F.array("n"), "total")).alias("dim", "x"))
    rows = cells.groupBy("cluster", "dim").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    out = {c: [0] * (dims + 1) for c in range(len(at))}
    for r in rows:
        out[r.cluster][r.dim] = int(r.x)
    return {c: (x[0], x[1:]) for c, x in out.items()}


def _assigned(chunks: DataFrame, centroids: list[list[int]], width: int, dims: int, kind: str) -> DataFrame:
    at = np.array(centroids, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, chunk in _chunks(batches, width, dims):
            d = chunk.distances(at)
            cluster = d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32()), pa.array(d[np.arange(len(d)), cluster])],
                names=["id", "cluster", "distance"])

    return map_arrow(chunks, run, f"id {kind}, cluster int, distance long")


def cluster(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", dims: int = 64, k: int = 16,
            rounds: int = 3, scale: int = 64, seed: str = "1:", width: int = WIDTH) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance, cluster_inertia, inertia, centroid_sha256), centroids).

    Components become floor(scale * x).  The centroids start as the ``k`` vectors
    with the smallest SHA-256 of ``seed`` and their id; each round assigns all
    vectors and replaces every non-empty centroid by the floor of its mean; then
    all are assigned once more.
    """
    kept = usable(vectors, id_col, vec_col, dims)
    kind = kept.schema["id"].dataType.simpleString()
    chunks = scratch(encoded(kept, scale, dims, width), "subvectors")
    centroids = _chosen(kept, k, scale, seed)
    if not centroids:
        empty = vectors.sparkSession.createDataFrame([], f"id {kind}, cluster int, distance long, cluster_inertia long, "
                                                         "inertia long, centroid_sha256 string")
        return empty, []
    for _ in range(rounds):
        totals = _sums(chunks, centroids, width, dims)
        centroids = [[x // totals[c][0] for x in totals[c][1]] if totals[c][0] else old
                     for c, old in enumerate(centroids)]
    found = scratch(_assigned(chunks, centroids, width, dims, kind), "clusters")
    drop_scratch(chunks)
    rows = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()
    inertia = {r.cluster: int(r.d) for r in rows}

    def by_cluster(values: list, kind: str):
        return F.element_at(F.array(*[F.lit(x).cast(kind) for x in values]), F.col("cluster") + 1)
    return found.select(
        "id", "cluster", "distance",
        by_cluster([inertia.get(c, 0) for c in range(len(centroids))], "long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        by_cluster([hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids], "string")
        .alias("centroid_sha256")), centroids
