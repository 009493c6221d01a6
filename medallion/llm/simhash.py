"""SimHash near-duplicates with bit-sliced comparison.

Fingerprint: ASCII capitals are lowered, the text is cut into words and
three-word shingles (repeats count, fewer words make one shingle), each shingle
is hashed with XXH64 (seed 42), and a bit is set if it is set in over half of
the hashes.  A text without words has fingerprint zero.

Links (at most ``RADIUS`` differing bits) are searched among the distinct
fingerprints.  The 64 bits are cut into four parts; two fingerprints within two
bits agree in at least two of them, so each fingerprint is filed under the six
pairs of parts, and only entries of one file are compared.  A file with more
than ``BLOCK`` entries is dealt into blocks by hash, and each pair of blocks is
a task's own work, so no entry is left out and no task holds a whole hot file.
Within a cell the fingerprints lie as bit planes (plane b holds bit b of all of
them).  The distances of a fingerprint to all others are counted together by
carry-save adders over the planes, and a block is abandoned as soon as all of
it is beyond the radius.

Defined cases
* null or blank text: fingerprint zero, linked like any other;
* repeated rows and equal texts: same fingerprint, one component;
* null ids: never the smallest of a component unless all its ids are null;
* empty table: empty result; texts are hashed whole; further columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_scratch, map_arrow, map_pandas, scratch, small_side
from .components import components, with_best

SHINGLE = 3
RADIUS = 2
BLOCK = 1024
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_CHUNK = 1 << 15
SMALL = 8  # cells up to this size are compared pair by pair in common lanes


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """SimHash of a UTF-8 text."""
    w = (text or b"").translate(_LOWER).split()  # ASCII white space: space and 09..0D
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), dtype=np.int64, count=len(w)) + 1) - 1
    k = min(shingle, len(w))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(w) - k + 1].tolist()
    stops = ends[k - 1:].tolist()
    h = xxhash.xxh64_intdigest
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(starts), _CHUNK):  # bounded memory for very long texts
        hashes = np.array([h(joined[s:e], 42) for s, e in zip(starts[at:at + _CHUNK], stops[at:at + _CHUNK])], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = SHINGLE) -> DataFrame:
    """(id, th, fp) of every row; th: hash of the text, fp: the fingerprint's 64 bits as a long."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("th"),
                      F.col(f"`{text_col}`").cast("binary").alias("t"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["id", "th", "fp"])

    return map_arrow(src, run, f"id {kind}, th long, fp long")


# ---- bit-sliced comparison -------------------------------------------------------------------

def planes(fps: np.ndarray) -> np.ndarray:
    """Bit planes of n fingerprints: row b holds bit b of all of them, 64 to a word."""
    bits = np.unpackbits(np.ascontiguousarray(fps).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    lanes = -(-len(fps) // 64) * 64
    up = np.zeros((64, lanes), dtype=np.uint8)
    up[:, : len(fps)] = bits.T
    return np.packbits(up, axis=1, bitorder="little").view("<u8")


def within(queries: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, np.ndarray]]:
    """(query index, indices of fps within the radius) for each query with a hit.

    ``count`` holds the distances so far as carry-save planes (ones, twos, ...);
    ``over`` has a bit for each fingerprint whose distance has passed the radius.
    """
    p = planes(fps)
    width = max(1, (radius + 1).bit_length())
    n_words = p.shape[1]
    pad = np.zeros(n_words, dtype=np.uint64)
    if len(fps) % 64:
        pad[-1] = ~np.uint64((1 << (len(fps) % 64)) - 1)
    ones = np.uint64(0xFFFFFFFFFFFFFFFF)
    step = max(1, (1 << 18) // n_words)
    for at in range(0, len(queries), step):
        q = queries[at:at + step]
        live = np.arange(len(q))
        count = [np.zeros((len(q), n_words), dtype=np.uint64) for _ in range(width)]
        over = np.broadcast_to(pad, (len(q), n_words)).copy()
        for b in range(64):
            own = ((q[live] >> np.uint64(b)) & np.uint64(1)).astype(bool)
            carry = p[b] ^ np.where(own, ones, np.uint64(0))[:, None]
            for c in count:  # add one bit to every distance
                c ^= carry
                carry = carry & ~c
            over |= carry  # past what the counters hold
            over |= _above(count, radius)
            if b >= 7 and b % 4 == 3:
                keep = ~(over == ones).all(axis=1)  # the others: the whole block is beyond the radius
                if not keep.all():
                    live, over = live[keep], over[keep]
                    count = [c[keep] for c in count]
                    if not len(live):
                        break
        if len(live):
            hit = np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little")[:, : len(fps)]
            for row, i in enumerate(live):
                found = np.flatnonzero(hit[row])
                if len(found):
                    yield at + int(i), found


def _above(count: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counted distance is greater than the radius (bitwise comparison from the top)."""
    greater = np.zeros_like(count[0])
    equal = ~greater
    for k in range(len(count) - 1, -1, -1):
        if radius >> k & 1:
            equal = equal & count[k]
        else:
            greater |= equal & count[k]
            equal = equal & ~count[k]
    return greater


def _union(n: int, pairs: Iterator[tuple[int, np.ndarray]]) -> np.ndarray:
    """Root of each of n nodes under the given links."""
    root = np.arange(n)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for i, found in pairs:
        for j in found.tolist():
            x, y = find(i), find(j)
            if x != y:
                root[max(x, y)] = min(x, y)
    return np.array([find(i) for i in range(n)])


def cell_links(fps: np.ndarray, part: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of the fingerprints of a cell (part 0 against part 1, or 0 with itself)."""
    left, right = np.flatnonzero(part == 0), np.flatnonzero(part == 1)
    if not len(right):
        right = left
    pairs = ((left[i], right[found]) for i, found in within(fps[left], fps[right], radius))
    root = _union(len(fps), pairs)
    linked = np.flatnonzero(root != np.arange(len(fps)))
    return fps[linked], fps[root[linked]]


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """(a, b): links among distinct fingerprints ``fp`` that connect all within the radius."""
    parts = radius + 2
    cuts = [64 * i // parts for i in range(parts + 1)]
    keys = []
    for n, (i, j) in enumerate(combinations(range(parts), 2)):
        mask = ((1 << cuts[i + 1]) - (1 << cuts[i])) | ((1 << cuts[j + 1]) - (1 << cuts[j]))
        mask -= (mask >> 63) << 64
        keys.append(F.struct(F.lit(n).cast("byte").alias("n"), F.col("fp").bitwiseAND(F.lit(mask)).alias("key")))
    filed = fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.n", "k.key")
    size = filed.groupBy("n", "key").agg(F.count("*").alias("size")).where("size > 1")
    size = scratch(size, "files")
    filed = filed.join(size, ["n", "key"])
    blocks = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = filed.withColumn("blocks", blocks).withColumn("own", own)
    # block i meets every block j; the cell of a pair is (smaller, greater)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("n", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         (F.col("own") > F.col("other")).cast("byte").alias("part"), "fp")
    cells = (dealt.withColumn("cell", F.xxhash64("n", "key", "i", "j"))
             .repartition("cell").sortWithinPartitions("cell", "n", "key", "i", "j"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for f in frames:
            f = f if rest is None else pd.concat([rest, f], ignore_index=True)
            last = f[["n", "key", "i", "j"]].iloc[-1]
            open_ = ((f["n"] == last["n"]) & (f["key"] == last["key"]) & (f["i"] == last["i"])
                     & (f["j"] == last["j"])).to_numpy()
            rest = f[open_]
            yield from _compare(f[~open_], radius)
        if rest is not None:
            yield from _compare(rest, radius)

    return map_pandas(cells.select("n", "key", "i", "j", "part", "fp"), run, "a long, b long")


def lanes_within(x: np.ndarray, y: np.ndarray, radius: int) -> np.ndarray:
    """Whether x[i] and y[i] are within the radius, for all i at once (both as bit planes)."""
    diff = planes(x) ^ planes(y)
    count = [np.zeros(diff.shape[1], dtype=np.uint64) for _ in range(max(1, (radius + 1).bit_length()))]
    over = np.zeros(diff.shape[1], dtype=np.uint64)
    for carry in diff:
        for c in count:
            c ^= carry
            carry = carry & ~c
        over |= carry | _above(count, radius)
    return np.unpackbits((~over).view(np.uint8), bitorder="little")[: len(x)].astype(bool)


def _compare(f: pd.DataFrame, radius: int) -> Iterator[pd.DataFrame]:
    """Links of whole cells that lie one after the other.

    The few pairs of small cells share the lanes of one comparison.
    """
    if not len(f):
        return
    k = f[["n", "key", "i", "j"]].to_numpy()
    start = np.flatnonzero(np.r_[True, (k[1:] != k[:-1]).any(axis=1)])
    size = np.diff(np.r_[start, len(f)])
    fps, part = f["fp"].to_numpy().view(np.uint64), f["part"].to_numpy()
    left, right = [], []
    for n in range(2, SMALL + 1):
        at = start[size == n]
        if len(at):
            i, j = np.triu_indices(n, 1)
            left.append((at[:, None] + i).ravel())
            right.append((at[:, None] + j).ravel())
    out_a, out_b = [], []
    if left:
        x, y = fps[np.concatenate(left)], fps[np.concatenate(right)]
        near = lanes_within(x, y, radius)
        out_a.append(x[near])
        out_b.append(y[near])
    for s, n in zip(start[size > SMALL].tolist(), size[size > SMALL].tolist()):
        a, b = cell_links(fps[s:s + n], part[s:s + n], radius)
        out_a.append(a)
        out_b.append(b)
    if out_a and sum(map(len, out_a)):
        yield pd.DataFrame({"a": np.concatenate(out_a).view(np.int64), "b": np.concatenate(out_b).view(np.int64)})


def _rank() -> F.Column:
    """Order in which a group's rows are preferred: by id, null last, then by text."""
    return F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("th"))


def _classes(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    """Rows (id, th, fp) and, per fingerprint, the preferred row of its component (fp, best)."""
    rows = scratch(fingerprints(docs, id_col, text_col, shingle), "simhash")
    classes = rows.groupBy("fp").agg(F.min(_rank()).alias("first"))
    roots = components(fingerprint_links(rows.select("fp").distinct(), radius))
    named = scratch(classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left"), "named")
    out = scratch(with_best(named, "fp", F.col("first")).select("fp", "best"), "classes")
    drop_scratch(named)
    return rows, out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(id, fp, component) of every row; component: smallest id reachable by links."""
    rows, classes = _classes(docs, id_col, text_col, shingle, radius)
    return rows.join(classes, "fp").select("id", "fp", F.col("best.id").alias("component"))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """``docs`` with one row left of each group: that with the smallest id (null ids last, then by text).

    Of rows that repeat this id and text one stays.
    """
    rows, classes = _classes(docs, id_col, text_col, shingle, radius)
    gone = rows.join(classes, "fp").where(~_rank().eqNullSafe(F.col("best"))).select("id", "th").distinct()
    gone = scratch(gone, "gone")
    again = rows.groupBy("id", "th").agg(F.count("*").alias("n")).where("n > 1").select("id", "th")
    again = scratch(again, "again")
    drop_scratch(rows)
    names = docs.columns
    wide = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(f"`{text_col}`").alias("th"),
                       F.struct(*[F.col(f"`{c}`") for c in names]).alias("r"))

    def rejoin(how: str, other: DataFrame, left: DataFrame) -> DataFrame:
        o = small_side(other)
        return left.join(o, left["id"].eqNullSafe(o["id"]) & (left["th"] == o["th"]), how)

    left = rejoin("left_anti", gone, wide)
    if not again.isEmpty():
        one = (rejoin("left_semi", again, left).groupBy("id", "th")
               .agg(F.min_by("r", F.xxhash64("r")).alias("r")))
        left = rejoin("left_anti", again, left).unionByName(one)
    return left.select([F.col(f"r.`{c}`").alias(c) for c in names])
