"""Periodic runs of words by descending-LCP Kruskal over suffix classes.

A run is a stretch of words with smallest period q that no neighbouring word
extends, of at least ``min_length`` words and ``min_exponent`` periods.

The suffixes of a text that share their first l words form a class; as l falls,
classes unite.  Suffix neighbours (in suffix order) are the edges of a graph,
weighted by their longest common prefix (LCP), and Kruskal's algorithm takes
them by decreasing LCP: a union-find structure keeps for each class its text
positions in order, the smaller class is put into the larger one, and two
positions i < j that become neighbours at LCP l, with j - i <= l, seed a run:
the words from i have period j - i over exactly l + j - i words.  Such a period
is the smallest one, because a smaller one p would have put i + p between them
at a greater LCP.  If the word before i continues the period, the seed belongs
to a run that starts earlier; otherwise it is the run.

Only positions whose first ``least`` words (the least LCP that a run can have)
occur twice in their text can seed anything.  Those are found for whole groups
of texts at once by ranking pairs of ranks; texts without any are done, and the
union-find works on those positions alone.

Everything happens inside a row, so there is no shuffle.  Memory: a group holds
``GROUP_BYTES`` of text (one longer text is a group of its own), some ten numbers
for each of its words, and one more for each doubling where a text has repeats.

Defined cases
* null or blank text: no words, no runs, empty collapsed text;
* null ids, ties, repeated rows and further columns: each row is treated alone;
  of runs that tie the caller chooses, they come by start, then period;
* empty table: empty result; texts are read whole, whatever their length.
"""
from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACES, map_arrow

GROUP_BYTES = 4 << 20

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES.encode())] = True


class Words:
    """The words of several texts: their places in the joined bytes, and a number for each distinct word."""

    def __init__(self, texts: list[bytes]):
        self.raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)  # every word is followed by white space
        space = _SPACE[self.raw]
        change = np.flatnonzero(np.diff(space, prepend=True))
        self.starts, self.ends = change[::2], change[1::2]
        if len(self.starts) > len(self.ends):
            raise AssertionError("a word without an end")
        text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
        #: number of the first word of each text, and one behind the last
        self.first = np.concatenate(([0], np.searchsorted(self.starts, text_ends)))
        offsets = np.concatenate(([0], np.cumsum(self.ends - self.starts)))
        data = self.raw[~space].tobytes()
        slices = pa.Array.from_buffers(pa.large_binary(), len(self.starts),
                                       [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
        coded = slices.dictionary_encode()
        self.codes = coded.indices.to_numpy().astype(np.int64)
        self._dictionary = coded.dictionary

    def __len__(self) -> int:
        return len(self.starts)

    def distinct(self) -> list[bytes]:
        """The distinct words by number."""
        return self._dictionary.to_pylist()

    def joined(self, keep: np.ndarray) -> list[bytes]:
        """The kept words of each text, joined by single spaces."""
        shown = self.raw.copy()
        shown[self.ends] = 0x20
        edge = np.zeros(len(self.raw) + 1, dtype=np.int8)
        edge[self.starts[keep]] += 1
        edge[self.ends[keep] + 1] -= 1  # a word that follows at once starts there
        out = shown[np.cumsum(edge[:-1]) > 0].tobytes()
        size = np.concatenate(([0], np.cumsum((self.ends - self.starts + 1) * keep)))[self.first].tolist()
        return [out[a:max(a, b - 1)] for a, b in zip(size, size[1:])]


def least_lcp(min_length: int, min_exponent: int) -> int:
    """The least LCP (run length less its period) over all periods."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each key, whether it occurs again)."""
    _, rank, count = np.unique(keys, return_inverse=True, return_counts=True)
    return rank, count[rank] > 1


def repeated(words: Words, least: int) -> np.ndarray:
    """Positions whose first ``least`` words occur again in the same text.

    The rank of a stretch is the rank of the pair of ranks of its two (overlapping)
    halves.  Ranks of single words are taken by text, so no stretch of two texts is repeated.
    """
    n = len(words)
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    at = np.arange(n)
    rank = np.full(n, -1, dtype=np.int64)
    r, again = _ranks(text * (int(words.codes.max(initial=0)) + 1) + words.codes)
    rank[again] = r[again]
    size = 1
    while size < least:
        step = min(size, least - size)
        at = at[(at + step < n)]
        at = at[(rank[at] >= 0) & (rank[at + step] >= 0)]
        r, again = _ranks(rank[at] * (n + 1) + rank[at + step])
        at = at[again]
        rank = np.full(n, -1, dtype=np.int64)
        rank[at] = r[again]
        size += step
    return at[rank[at] >= 0]


def suffix_neighbours(text: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions in suffix order, LCP of each with the one before it) of the words of some texts, text by text.

    The order comes by prefix doubling.  The ranks of every doubling are kept: an LCP is summed from
    the longest equal stretches down.  A text ends before every word.
    """
    n = len(codes)
    rank = _ranks(text * (int(codes.max()) + 1) + codes)[0]
    levels, reach = [], 1
    while True:
        levels.append((reach, rank.astype(np.int32)))
        then = np.minimum(np.arange(n) + reach, n - 1)
        inside = (text[then] == text) & (np.arange(n) + reach < n)
        rank, again = _ranks(rank * (n + 1) + np.where(inside, rank[then] + 1, 0))
        if not again.any():
            break
        reach *= 2
    order = np.argsort(rank)
    a, b = order[:-1], order[1:]
    lcp = np.zeros(n - 1, dtype=np.int64)
    for reach, rank in reversed(levels):  # ranks go by text, and a rank behind the end belongs to another text
        x, y = a + lcp, b + lcp
        equal = rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)]
        lcp += np.where((x < n) & (y < n) & equal, reach, 0)
    return order, np.append(0, lcp)


def runs_of(codes: memoryview, start: int, order: list[int], lcps: list[int], min_length: int, min_exponent: int,
            least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of the text that begins at ``start``."""
    found = []
    parent = {p: p for p in order}
    places = {p: [p] for p in order}

    def find(p: int) -> int:
        while parent[p] != p:
            parent[p] = p = parent[parent[p]]
        return p

    def seed(i: int, j: int, l: int) -> None:
        q = j - i
        if q <= l and l + q >= max(min_length, min_exponent * q) and (i == start or codes[i - 1] != codes[j - 1]):
            found.append((i - start, l + q, q))

    for e in sorted((e for e in range(1, len(order)) if lcps[e] >= least), key=lambda e: -lcps[e]):
        l, a, b = lcps[e], find(order[e - 1]), find(order[e])
        if len(places[a]) < len(places[b]):
            a, b = b, a
        large, small = places[a], places.pop(b)
        parent[b] = a
        if 8 * len(small) > len(large):
            large = places[a] = sorted(large + small)
        else:
            for p in small:
                insort(large, p)
        own = set(small)
        for p in small:
            k = bisect_left(large, p)
            if k and large[k - 1] not in own:
                seed(large[k - 1], p, l)
            if k + 1 < len(large) and large[k + 1] not in own:
                seed(p, large[k + 1], l)
    return sorted(found, key=lambda run: (run[0], run[2]))


def all_runs(words: Words, min_length: int, min_exponent: int) -> dict[int, list[tuple[int, int, int]]]:
    """Runs of each text that has any."""
    least = least_lcp(min_length, min_exponent)
    seeds = repeated(words, least)
    if not len(seeds):
        return {}
    text = np.repeat(np.arange(len(words.first) - 1), np.diff(words.first))
    chosen = np.zeros(len(words.first) - 1, dtype=bool)
    chosen[text[seeds]] = True
    place = np.flatnonzero(chosen[text])  # the words of texts with seeds
    text = text[place]
    order, lcps = suffix_neighbours(text, words.codes[place])
    seed = np.zeros(len(words), dtype=bool)
    seed[seeds] = True
    kept = seed[place[order]]
    order, lcps = order[kept], lcps[kept]  # suffixes between seeds share fewer words than any run needs
    text, order = text[order], place[order]
    codes = memoryview(words.codes)
    out = {}
    cuts = np.concatenate(([0], np.flatnonzero(np.diff(text)) + 1, [len(text)])).tolist()
    for x, y in zip(cuts, cuts[1:]):
        t = int(text[x])
        found = runs_of(codes, int(words.first[t]), order[x:y].tolist(), lcps[x:y].tolist(), min_length, min_exponent,
                        least)
        if found:
            out[t] = found
    return out


def collapsed(words: Words, runs: dict[int, list[tuple[int, int, int]]]) -> list[bytes]:
    """Each text without the words that a run holds behind its first period."""
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for t, found in runs.items():
        for start, length, period in found:
            edge[words.first[t] + start + period] += 1
            edge[words.first[t] + start + length] -= 1
    return words.joined(np.cumsum(edge[:-1]) == 0)


def groups(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) in groups of bounded size; null: empty text."""
    at, size, some = 0, 0, []
    for i, t in enumerate(texts):
        t = t.as_py() or b""
        if some and size + len(t) > GROUP_BYTES:
            yield at, some
            at, size, some = i, 0, []
        some.append(t)
        size += len(t)
    if some:
        yield at, some


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                  min_exponent: int = 4) -> DataFrame:
    """(id, runs, collapsed): all runs of every row by start and period, and the text reduced to one period of each."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    kind = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, texts in groups(b.column(1)):
                words = Words(texts)
                found = all_runs(words, min_length, min_exponent)
                flat = [r for t in range(len(texts)) for r in found.get(t, ())]
                ends = np.cumsum([0] + [len(found.get(t, ())) for t in range(len(texts))])
                columns = np.array(flat, dtype=np.int64).reshape(-1, 3)
                runs = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(columns[:, i]) for i in range(3)], fields=list(kind)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), runs, pa.array(collapsed(words, found), pa.binary())],
                    names=["id", "runs", "collapsed"])

    head = src.schema["id"].dataType.simpleString()
    out = map_arrow(src, run, f"id {head}, runs array<{RUN}>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def planted_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The table with the tail of every tenth text made periodic, by a rule on the CRC-32 of its id.

    With h that checksum and g = floor(h / 10): if 10 divides h, word i >= a of n becomes word a + (i - a) % p,
    a = g % n, p = 1 + floor((n - a) / (3 + g % 8)).  Other texts, null ids and texts without words stay.
    """
    from .common import words as words_of

    w = words_of(F.col(f"`{text_col}`"))
    h = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary"))
    chosen = docs.withColumn("__h", h).withColumn(
        "__w", F.when(F.col("__h") % 10 == 0, w)).withColumn("__n", F.size("__w").cast("long"))
    g = F.expr("__h div 10")
    a = F.when(F.col("__n") > 0, g % F.col("__n"))
    chosen = chosen.withColumn("__a", a).withColumn(
        "__p", 1 + F.expr("(__n - __a) div (3 + (__h div 10) % 8)"))
    periodic = F.expr("array_join(transform(__w, (x, i) -> CASE WHEN i < __a THEN x "
                      "ELSE get(__w, CAST(__a + (i - __a) % __p AS INT)) END), ' ')")
    return (chosen.withColumn(text_col, F.when(F.col("__n") > 0, periodic).otherwise(F.col(f"`{text_col}`")))
            .drop("__h", "__w", "__n", "__a", "__p"))


def digests(found: DataFrame) -> DataFrame:
    """The runs of :func:`periodic_runs` as figures: number, the longest one, digests of the run list and the collapsed text."""
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    top = found.withColumn("__best", best)
    return top.select(
        "id", F.size("runs").cast("long").alias("n_runs"), (-F.col("__best.start")).alias("start"),
        F.col("__best.length").alias("length"), (-F.col("__best.period")).alias("period"),
        F.expr("(1000 * __best.length) div (-__best.period)").alias("exponent_milli"),
        F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
