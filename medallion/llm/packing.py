"""Packing of token ids into windows whose sources keep target proportions.

Every source has a queue of its documents' ids.  Deficit round-robin serves the
queues: in each round a queue's credit grows by its quantum (its target share of
a window, in fractions of a token), it is served as many whole granules
(``GRANULE`` ids) as the credit covers, and what is left of the credit, the
deficit, is carried into the next round.  The rounds, one after the other, are
cut into windows of ``window`` ids, so every window but the last is full.

After r rounds a queue with quantum a has been served floor(r * a / granule)
granules and its deficit is the rest of that division: the whole state is a
function of r.  So every task enters the round-robin with the deficits that all
windows before it leave behind, wherever its documents lie in their queues, and
serves only them.  A granule's round follows from its place in its queue; its
place in the stream is what all queues have been served by then.

Steps: (1) each task encodes its texts and notes, for each text, the ids of the
same source before it in the task; this table is written once and fixes the
order of the queues; (2) one row for each (task, source) is summed, and prefix
sums give each task its places in the queues; (3) each task cuts its texts.

The shares are kept in units of 2^-16 ids of a window.  A source with less than
1/1024 of all ids (two ids of a window) shares a queue with others of its hash,
so there are 2,048 queues at most, whatever the number of sources.  Without
``weights`` the target shares are those of the corpus, and all queues end
together; with ``weights`` a source that runs out leaves its place to the others.

Ids are those of the tokenizer file without special tokens, then ``end_id``.
Texts are cut where the tokenizer's own rules cut in any case (at white space, and
between ASCII letters, digits and marks); each distinct part is encoded once for a
group of texts and remembered by the worker, in flat arrays of bounded size.

Defined cases
* null text: as the empty text, one id (the end); null source: a source of its
  own; null ids, repeated rows: each row is treated alone; ties do not occur (the
  place in the written table decides); further columns are not read; empty
  table: empty result; texts are encoded and cut whole, whatever their length.
"""
from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, Remembered, binary_slices, drop_scratch, map_arrow, scratch, small_side
from .periodic import groups

GRANULE = 64
SHARE_BITS = 16
SHARED_QUEUES = 1024
REMEMBERED_BYTES = 32 << 20
CUT_GROUP = 1 << 18


# Kinds of bytes.  The tokenizer drops white space and cuts between letters, single digits and other
# characters, but for contractions after an apostrophe; a byte beyond ASCII may belong to any of these.
_SPACE, _LETTER, _DIGIT, _MARK, _OTHER = range(5)
_KIND = np.full(256, _OTHER, dtype=np.uint8)
for _c in range(128):
    _KIND[_c] = (_SPACE if chr(_c) in SPACES else _LETTER if chr(_c).isalpha() else _DIGIT if chr(_c).isdigit()
                 else _OTHER if chr(_c) == "'" else _MARK)
_CUT = np.zeros((5, 5), dtype=bool)
_CUT[_SPACE, 1:] = True
for _a, _b in ((_LETTER, _DIGIT), (_LETTER, _MARK), (_DIGIT, _LETTER), (_DIGIT, _DIGIT), (_DIGIT, _MARK),
               (_MARK, _LETTER), (_MARK, _DIGIT)):
    _CUT[_a, _b] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def parts(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(number of each part, the distinct parts, first part of each text and one behind the last).

    Parts are stretches between white space, cut where the tokenizer cuts in any case (between ASCII
    letters, digits and marks), with A-Z in lower case as it has them.
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    kind = _KIND[raw]
    start = np.empty(len(raw), dtype=bool)
    start[0] = kind[0] != _SPACE
    start[1:] = _CUT.ravel()[kind[:-1].astype(np.int64) * 5 + kind[1:]]
    word = kind != _SPACE
    at = np.flatnonzero(start)
    ends = np.append(np.cumsum(word)[at] - 1, int(word.sum()))
    coded = binary_slices(_LOWER[raw[word]].tobytes(), ends).dictionary_encode()
    text_ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, np.concatenate(([0], np.searchsorted(at, text_ends)))


class WordIds:
    """Ids of words by a tokenizer file; parts of words are remembered up to ``REMEMBERED_BYTES``."""

    def __init__(self, packed: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(packed)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.known = Remembered(REMEMBERED_BYTES)

    def computed(self, words: list[bytes]) -> pa.Array:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        flat, size = [], []
        for at in range(0, len(words), 4096):
            some = [w.decode("utf-8", "replace") for w in words[at:at + 4096]]
            found = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
            size += map(len, found)
            flat.append(np.fromiter(chain.from_iterable(found), dtype="<u4").tobytes())
        return binary_slices(b"".join(flat), 4 * np.cumsum([0, *size]))

    def encode(self, texts: list[bytes], end: bytes) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers, with the end id."""
        number, distinct, first = parts(texts)
        if not len(number):
            return [end] * len(texts)
        values = self.known.values_of(distinct, self.computed).take(pa.array(number))
        _, ends, data = values.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[:len(values) + 1][first].tolist()
        data = data.to_pybytes() if data is not None else b""
        return [data[a:b] + end for a, b in zip(ends, ends[1:])]


_ENCODERS: dict[int, WordIds] = {}  # one in a worker process


def _encoder(packed: bytes) -> WordIds:
    key = hash(packed)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = WordIds(packed)
    return _ENCODERS[key]


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, queue_key, task, before, n, ids): the ids of every row and its place among its task's rows of the source."""
    with open(tokenizer_path, "rb") as f:
        packed = docs.sparkSession.sparkContext.broadcast(f.read())
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
                      F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(packed.value)
        task = TaskContext.get().partitionId()
        served: dict[str | None, int] = defaultdict(int)
        for b in batches:
            for at, texts in groups(b.column(2)):
                ids = encoder.encode(texts, end)
                n = [len(x) // 4 for x in ids]
                source = b.column(1).slice(at, len(texts))
                before = []
                for s, size in zip(source.to_pylist(), n):
                    before.append(served[s])
                    served[s] += size
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, len(texts)), source, pa.array([task] * len(n), pa.int32()),
                     pa.array(before, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                    names=["id", "source", "task", "before", "n", "ids"])
                pa.default_memory_pool().release_unused()

    kind = src.schema["id"].dataType.simpleString()
    out = map_arrow(src, run, f"id {kind}, source string, task int, before long, n long, ids binary")
    return out.withColumn("queue_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))


def quanta(totals: list[int], weights: list[float] | None, window: int) -> np.ndarray:
    """Quantum of each queue in units of 2^-SHARE_BITS ids."""
    shares = [float(w) for w in (weights if weights is not None else totals)]
    whole = sum(shares) or 1.0
    return np.array([max(1, round(s / whole * window * (1 << SHARE_BITS))) for s in shares], dtype=np.int64)


def served(rounds: np.ndarray, quantum: np.ndarray, totals: np.ndarray, granule: int) -> np.ndarray:
    """Ids served to each queue (column) after each number of rounds (row)."""
    return np.minimum((rounds[:, None] * quantum[None, :]) // (granule << SHARE_BITS) * granule, totals[None, :])


def cut(queue: np.ndarray, start: np.ndarray, n: np.ndarray, quantum: np.ndarray, totals: np.ndarray, window: int,
        granule: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of texts that lie at ``start`` in their queues: (text, start in the text, length, place in the stream)."""
    first, last = start // granule, (start + n - 1) // granule
    count = last - first + 1
    text = np.repeat(np.arange(len(n)), count)
    g = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[text]
    q = queue[text]
    unit = granule << SHARE_BITS
    rounds = -(-(g + 1) * unit // quantum[q]) - 1  # the first after which the credit covers this granule
    distinct, number = np.unique(rounds, return_inverse=True)
    ahead = np.empty(len(g), dtype=np.int64)
    step = max(1, (1 << 22) // len(totals))
    by_round = np.argsort(number, kind="stable")
    edges = np.searchsorted(number[by_round], np.arange(0, len(distinct) + step, step))
    for k, at in enumerate(range(0, len(distinct), step)):
        some = by_round[edges[k]:edges[k + 1]]
        now = served(distinct[at:at + step], quantum, totals, granule)
        then = served(distinct[at:at + step] + 1, quantum, totals, granule)
        # queues before this one have been served this round as well, those behind it have not
        before = np.cumsum(then, axis=1) - then
        behind = now.sum(axis=1, keepdims=True) - np.cumsum(now, axis=1)
        ahead[some] = (before + behind)[number[some] - at, q[some]]
    lo, hi = np.maximum(start[text], g * granule), np.minimum((start + n)[text], (g + 1) * granule)
    place = ahead + lo
    # neighbours in the text that are neighbours in the stream are one piece, until a window ends
    fresh = np.ones(len(g), dtype=bool)
    fresh[1:] = (text[1:] != text[:-1]) | (place[1:] != (place + hi - lo)[:-1])
    at = np.flatnonzero(fresh)
    size = np.add.reduceat(hi - lo, at) if len(at) else np.zeros(0, dtype=np.int64)
    text, lo, place = text[at], (lo - start[text])[at], place[at]
    windows = (place + size - 1) // window - place // window + 1
    part = np.repeat(np.arange(len(at)), windows)
    w = place[part] // window + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    x = np.maximum(place[part], w * window)
    y = np.minimum((place + size)[part], (w + 1) * window)
    return text[part], lo[part] + x - place[part], y - x, x


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, window: int = 2048, weights: dict | None = None,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", granule: int = GRANULE) -> DataFrame:
    """(id, source, start, length, ids, doc_tokens, sequence_id, offset): one row for each piece.

    ``ids`` are little-endian unsigned 32-bit integers.  ``weights`` gives sources
    (None: the null source) their target weights, 1 where it has none.
    """
    held = scratch(encoded(docs, tokenizer_path, end_id, id_col, text_col, source_col), "packing-ids")
    by_task = scratch(held.groupBy("task", "queue_key").agg(F.sum("n").alias("n")), "packing-tasks")
    by_source = by_task.groupBy("queue_key").agg(F.sum("n").alias("source_n"))
    whole = int(by_source.agg(F.sum("source_n")).first()[0] or 0)
    shared = F.concat(F.lit("h"), F.pmod(F.xxhash64("queue_key"), F.lit(SHARED_QUEUES)).cast("string"))
    own = by_source.withColumn("queue", F.when(F.col("source_n") >= F.lit(whole // SHARED_QUEUES), F.col("queue_key"))
                               .otherwise(shared))
    own = scratch(own, "packing-queues")
    queues = own.groupBy("queue").agg(F.sum("source_n").alias("n")).orderBy("queue").collect()  # 2,048 at most
    names = [r.queue for r in queues]
    totals = np.array([int(r.n) for r in queues] or [0], dtype=np.int64)
    told = None
    if weights is not None:
        named = {("n" if s is None else f"s{s}"): float(w) for s, w in weights.items()}
        told = [named.get(name, 1.0) for name in names]
    quantum = quanta(totals.tolist(), told, window)
    number = F.array_position(F.lit(names), F.col("queue")) - 1 if names else F.lit(0)
    places = by_task.join(small_side(own), "queue_key").select(
        "task", "queue_key", number.cast("int").alias("queue_no"),
        (F.sum("n").over(Window.partitionBy("queue").orderBy("task", "queue_key")) - F.col("n")).alias("ahead"))
    places = scratch(places, "packing-places")
    drop_scratch(by_task)
    drop_scratch(own)
    src = held.join(small_side(places), ["task", "queue_key"]).select(
        "id", "source", "n", "ids", "queue_no", (F.col("ahead") + F.col("before")).alias("place"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.column(2).to_numpy().astype(np.int64)
            group = (np.cumsum(n) - n) // CUT_GROUP
            edges = np.concatenate(([0], np.flatnonzero(np.diff(group)) + 1, [len(n)])).tolist()
            for i, j in zip(edges, edges[1:]):
                if i == j:
                    continue
                some = b.slice(i, j - i)
                text, start, length, place = cut(
                    some.column(4).to_numpy().astype(np.int64), some.column(5).to_numpy().astype(np.int64), n[i:j],
                    quantum, totals, window, granule)
                ids = [x.as_py() for x in some.column(3)]
                pieces = [ids[t][4 * s:4 * (s + l)] for t, s, l in zip(text.tolist(), start.tolist(), length.tolist())]
                rows = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(rows), some.column(1).take(rows), pa.array(start), pa.array(length),
                     pa.array(pieces, pa.binary()), pa.array(n[i:j][text]), pa.array(place // window),
                     pa.array(place % window)],
                    names=["id", "source", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    return map_arrow(src, run, f"id {kind}, source string, start long, length long, ids binary, doc_tokens long, "
                               "sequence_id long, offset long")


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids): the pieces of each window joined in order (a window's pieces are bounded by its ids)."""
    row = F.struct("offset", "ids")
    return pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(row)).alias("p")).select(
        "sequence_id", F.expr("aggregate(p, cast('' as binary), (x, y) -> concat(x, y.ids))").alias("ids"))
