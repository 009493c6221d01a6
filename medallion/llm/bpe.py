"""Byte-level BPE encoding and decoding by DuckDB recursive queries in each partition.

A text is split into words by the tokenizers' pattern.  The distinct words of a
group of texts become token-position rows (word, place, token); a recursive
query joins neighbouring tokens to the merge table, contracts each word's
leftmost pair of least rank, and goes on until no word has a pair left.  A text's
ids are those of its words in order.  Decoding cuts the ids of a text into pieces, turns
the distinct pieces into (piece, place, token) rows, joins them to the
vocabulary and joins the bytes by an ordered aggregation.

The merge table holds every pair of tokens whose bytes together are a token, so
the ids are those of a rank-file tokenizer.  Words of more than ``WINDOW`` bytes
are contracted window by window, many windows in a query, and joined where two
overlapping windows agree (:meth:`Codec.windowed`, exact); the work so grows
with the bytes, also in scripts without spaces.  Windows that do not agree (long
repetitions) become one; beyond ``SHORT`` bytes such a stretch takes a second
recursive query: it contracts, in one step, all occurrences of the least pair
from the left, up to the first that brings up a still smaller pair; this gives
the same ids in far fewer steps.

The ids of the tokens themselves and of ``FREQUENT`` frequent words are computed
once and sent to all tasks as flat arrays; a task contracts the others.

Memory: a group has ``GROUP_BYTES`` of text (one longer text is a group of its
own), a query ``CHUNK_BYTES`` of words (one longer stretch is a query of its own),
the tables of a task's DuckDB are bounded by ``DUCKDB_MEMORY`` beyond which it
spills to a folder in the task's working directory, and the words of earlier groups that a
worker remembers, in flat arrays, by ``REMEMBERED_BYTES``.

Defined cases
* null text: encoded as the empty text; empty text: no ids, no bytes;
* null ids, ties, repeated rows and further columns: each row is treated alone;
  empty table: empty result; texts are encoded whole.
"""
from __future__ import annotations

import base64
import hashlib
import os
import unicodedata
import uuid
from collections.abc import Callable, Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, binary_slices, give_back, map_arrow

#: The pattern that :func:`split_words` follows (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Longer words are cut into windows of so many bytes, which overlap; windows that had to be joined are
#: contracted by the first query up to ``SHORT`` bytes, by the second beyond.
WINDOW = 96
OVERLAP = 32
SHORT = 1024
GROUP_BYTES = 2 << 20
CHUNK_BYTES = 240_000
PIECES_CHUNK = 100_000
REMEMBERED_BYTES = 16 << 20
SAMPLED = 4096
FREQUENT = 1 << 17
DUCKDB_MEMORY = "112MB"

#: Unicode white space (fixed value).
_WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)

SHORT_WORDS = """
WITH RECURSIVE step(w, g, n, t, nn, nt, k, fin) AS (
  SELECT w, g, n, t, nn, nt, (m.r::BIGINT << 32) | g, false
  FROM init LEFT JOIN merges m ON m.pair = ((t::BIGINT << 32) | nt)
  UNION ALL
  SELECT w, g, n, t, nn, nt, CASE WHEN changed THEN (m.r::BIGINT << 32) | g ELSE k END, fin FROM (
    SELECT s.w, s.g, s.k, b.w IS NULL AS fin,
      coalesce(s.g = b.g OR s.g + s.n = b.g, false) AS changed,
      CASE WHEN s.g = b.g THEN b.n + b.nn ELSE s.n END AS n,
      CASE WHEN s.g = b.g THEN b.r ELSE s.t END AS t,
      CASE WHEN s.g = b.g THEN b.nn2 WHEN s.g + s.n = b.g THEN b.n + b.nn ELSE s.nn END AS nn,
      CASE WHEN s.g = b.g THEN b.nt2 WHEN s.g + s.n = b.g THEN b.r ELSE s.nt END AS nt
    FROM step s LEFT JOIN (
      SELECT c.*, y.nn AS nn2, y.nt AS nt2 FROM (
        SELECT w, (min(k) & 4294967295)::INTEGER AS g, (min(k) >> 32)::INTEGER AS r,
               arg_min(n, k) AS n, arg_min(nn, k) AS nn
        FROM step WHERE NOT fin AND k IS NOT NULL GROUP BY w) c
      JOIN step y ON y.g = c.g + c.n) b ON b.w = s.w
    WHERE NOT s.fin AND (b.w IS NULL OR s.g <> b.g + b.n))
  LEFT JOIN merges m ON m.pair = CASE WHEN changed THEN ((t::BIGINT << 32) | nt) END)
SELECT w, list(t ORDER BY g) AS ids FROM step WHERE fin GROUP BY w ORDER BY w
"""

LONG_WORDS = """
WITH RECURSIVE step(w, g, t, fin) AS (
  SELECT w, g, t, false FROM init
  UNION ALL
  SELECT w, g, CASE WHEN done THEN best ELSE t END, best IS NULL FROM (
    SELECT *, lag(done, 1, false) OVER (PARTITION BY w ORDER BY g) AS eaten FROM (
      SELECT *, chosen AND coalesce(sum(stop::INTEGER) OVER (
          PARTITION BY w ORDER BY g ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS done FROM (
        SELECT p.*, p.chosen AND (coalesce(ml.r < p.best, false) OR coalesce(mr.r < p.best, false)) AS stop FROM (
          SELECT *, CASE WHEN lag(chosen, 2, false) OVER (PARTITION BY w ORDER BY g) THEN best
                         ELSE lag(t) OVER (PARTITION BY w ORDER BY g) END AS lt,
                 lead(t, 2) OVER (PARTITION BY w ORDER BY g) AS rt FROM (
            SELECT *, here AND row_number() OVER (PARTITION BY w, here, run ORDER BY g) % 2 = 1 AS chosen FROM (
              SELECT *, row_number() OVER (PARTITION BY w ORDER BY g)
                        - sum(here::INTEGER) OVER (PARTITION BY w ORDER BY g) AS run FROM (
                SELECT *, coalesce(r = best, false) AS here FROM (
                  SELECT *, min(r) OVER (PARTITION BY w) AS best FROM (
                    SELECT x.w, x.g, x.t, m.r FROM (
                      SELECT w, g, t, lead(t) OVER (PARTITION BY w ORDER BY g) AS nt FROM step WHERE NOT fin) x
                    LEFT JOIN merges m ON m.pair = ((x.t::BIGINT << 32) | x.nt))))))) p
        LEFT JOIN merges ml ON ml.pair = ((p.lt::BIGINT << 32) | p.best)
        LEFT JOIN merges mr ON mr.pair = ((p.best::BIGINT << 32) | p.rt))))
  WHERE NOT eaten)
SELECT w, list(t ORDER BY g) AS ids FROM step WHERE fin GROUP BY w ORDER BY w
"""

#: The vocabulary's bytes stand as characters U+0000..U+00FF, so that text functions can join them.
PIECES = """
SELECT w, string_agg(shown, '') AS shown FROM (
  SELECT w, g, v.shown FROM pieces p JOIN vocab v ON v.t = p.t ORDER BY w, g) GROUP BY w ORDER BY w
"""


def load_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a tokenizer file: one base64 token and its rank in a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def character_kinds() -> np.ndarray:
    """Kind of each code point: letter, number, white space or other."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    first = {"L": _LETTER, "N": _NUMBER}
    for cp in range(0x110000):
        kind[cp] = first.get(unicodedata.category(chr(cp))[0], _OTHER)
    kind[_WHITE] = _SPACE
    return kind


class Splitter:
    """Splits texts into the matches of the pattern, with array operations over many texts at once."""

    def __init__(self, pattern: str = PATTERN, kind: np.ndarray | None = None):
        self.slow = None if pattern == PATTERN else regex.compile(pattern)
        self.kind = character_kinds() if kind is None and pattern == PATTERN else kind

    def words(self, texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """(bytes, word offsets, number of words of each text); the bytes are those of all texts."""
        if self.slow is not None:
            found = [[m.encode() for m in self.slow.findall(t)] for t in texts]
            flat = [w for words in found for w in words]
            ends = np.cumsum([0, *map(len, flat)])
            return b"".join(flat), ends, np.array([len(w) for w in found], dtype=np.int64)
        text = "".join(texts)
        raw = text.encode()
        cp = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        n = len(cp)
        if not n:
            return b"", np.zeros(1, dtype=np.int64), np.zeros(len(texts), dtype=np.int64)
        kind = self.kind[cp]
        first = np.zeros(n + 1, dtype=bool)  # first characters of texts
        first[0] = True
        first[ends] = True
        # a word starts where the kind of character changes ...
        start = first[:n].copy()
        start[1:] |= kind[1:] != kind[:-1]
        # ... the last character of a white-space run before something else is cut off,
        space = kind == _SPACE
        last = np.zeros(n, dtype=bool)
        last[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
        start |= last
        # and if it is U+0020 it belongs to what follows
        start[np.flatnonzero(last & (cp == 0x20)) + 1] = False
        # contractions: an apostrophe that starts a word, and the letters after it
        for i in np.flatnonzero((cp == 0x27) & start).tolist():
            tail = text[i + 1:i + 3]
            k = 1 if tail[:1] in ("s", "t", "m", "d") and tail else 2 if tail in ("re", "ve", "ll") else 0
            if k and not first[i + 1:i + 1 + k].any():
                start[i + 1:i + 1 + k] = False
                if i + 1 + k < n and kind[i + 1 + k] == _LETTER:
                    start[i + 1 + k] = True
        at = np.flatnonzero(start)
        per_text = np.diff(np.searchsorted(at, np.concatenate(([0], ends))))
        if len(raw) != n:
            size = 1 + (cp >= 0x80).astype(np.int8) + (cp >= 0x800) + (cp >= 0x10000)
            at = (np.cumsum(size, dtype=np.int64) - size)[at]
        return raw, np.append(at, len(raw)), per_text


def distinct_slices(data: bytes, offsets: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of each slice among the distinct ones, the distinct slices)."""
    coded = binary_slices(data, offsets).dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def laid_out(number: np.ndarray, parts: pa.Array, per_text: np.ndarray) -> list[bytes]:
    """For each text, its parts (by number) joined in order."""
    data, offsets = _binary(parts.cast(pa.large_binary()).take(pa.array(number))) if len(number) else (b"", np.zeros(1, np.int64))
    ends = offsets[np.concatenate(([0], np.cumsum(per_text)))].tolist()
    return [data[x:y] for x, y in zip(ends, ends[1:])]


class Vocabulary:
    """What a task needs of a rank file, as flat arrays that the driver computes once.

    ``words`` and ``word_ids`` are words whose ids are known beforehand: the tokens
    themselves and, after :func:`with_frequent`, frequent words of the corpus.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.pattern = pattern
        self.byte_token = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        left, right, rank = [], [], []
        for token, r in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    rank.append(r)
        self.pair = (np.array(left, dtype=np.int64) << 32) | np.array(right, dtype=np.int64)
        self.rank = np.array(rank, dtype=np.int32)
        tokens = sorted(ranks, key=ranks.get)
        self.token = np.array([ranks[t] for t in tokens], dtype=np.int32)
        self.shown = pa.array([t.decode("latin-1") for t in tokens], pa.string())
        self.size = np.zeros(int(self.token.max()) + 1, dtype=np.int64)  # bytes of each token
        self.size[self.token] = [len(t) for t in tokens]
        # pieces of ids are cut before every token that starts with a space
        self.cuts = np.zeros(len(self.size), dtype=bool)
        self.cuts[[r for t, r in ranks.items() if t[:1] == b" "]] = True
        self.words = pa.array(tokens, pa.large_binary())  # a word that is a token stays whole
        self.word_ids = pa.array([ranks[t].to_bytes(4, "little") for t in tokens], pa.large_binary())
        self.kind = character_kinds() if pattern == PATTERN else None

    def with_frequent(self, words: list[bytes]) -> "Vocabulary":
        """The vocabulary with the ids of further words."""
        more = pa.array(dict.fromkeys(words), pa.large_binary())
        more = more.filter(pc.is_null(pc.index_in(more, value_set=self.words)))
        codec = Codec(self)
        ids = codec.ids_of(more)
        codec.close()
        self.words, self.word_ids = pa.concat_arrays([self.words, more]), pa.concat_arrays([self.word_ids, ids])
        return self


class Codec:
    """Encoder and decoder of one task; its tables live in a DuckDB of the task."""

    def __init__(self, vocabulary: Vocabulary, known: Remembered | None = None):
        self.vocabulary = vocabulary
        self.splitter = Splitter(vocabulary.pattern, vocabulary.kind)
        self.known = Remembered(REMEMBERED_BYTES) if known is None else known
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "temp_directory": os.path.join(
            os.getcwd(), f"duckdb-{uuid.uuid4().hex}")})
        self._load("merges", pa.table({"pair": vocabulary.pair, "r": vocabulary.rank}))
        self._load("vocab", pa.table({"t": vocabulary.token, "shown": vocabulary.shown}))

    def close(self) -> None:
        """Drop the tables, and the spill folder if there was one; what has been learnt stays."""
        self.db.close()

    def _load(self, name: str, rows: pa.Table) -> None:
        self.db.register("arrow_rows", rows)
        self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM arrow_rows")
        self.db.unregister("arrow_rows")

    def _query(self, sql: str, name: str, rows: pa.Table) -> pa.Table:
        self.db.register(name, rows)
        out = self.db.sql(sql).to_arrow_table()
        self.db.unregister(name)
        return out

    def _contracted(self, words: list[bytes], sql: str) -> list[bytes]:
        size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        t = self.vocabulary.byte_token[np.frombuffer(b"".join(words), dtype=np.uint8)]
        nt = np.append(t[1:], np.int32(-1))
        nt[np.cumsum(size) - 1] = -1
        one = np.ones(len(t), dtype=np.int32)
        rows = pa.table({"w": np.repeat(np.arange(len(words), dtype=np.int32), size),
                         "g": np.arange(len(t), dtype=np.int32), "n": one, "t": t, "nn": one, "nt": nt})
        ids = self._query(sql, "init", rows)["ids"].combine_chunks()
        flat = ids.flatten().to_numpy().astype("<u4").tobytes()
        ends = (ids.offsets.to_numpy().astype(np.int64) * 4).tolist()
        return [flat[a - ends[0]:b - ends[0]] for a, b in zip(ends, ends[1:])]

    def contracted(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word; many words share a query, whose rows are bounded."""
        out: dict[bytes, bytes] = {}
        short = sorted({w for w in words if len(w) <= SHORT}, key=len)
        rest = sorted({w for w in words if len(w) > SHORT}, key=len)
        for some, sql in ((short, SHORT_WORDS), (rest, LONG_WORDS)):
            ends = np.cumsum([len(w) for w in some], dtype=np.int64)
            chunk = (ends - 1) // CHUNK_BYTES if len(some) else ends
            edges = np.concatenate(([0], np.flatnonzero(np.diff(chunk)) + 1, [len(some)])).tolist()
            for x, y in zip(edges, edges[1:]):
                if x < y:
                    out.update(zip(some[x:y], self._contracted(some[x:y], sql)))
        return [out[w] for w in words]

    def windowed(self, words: list[bytes]) -> list[bytes]:
        """Ids of long words from those of overlapping windows.

        Neighbouring tokens are final if they stay two tokens when they alone are encoded, and a
        list of tokens is the encoding of its bytes if that holds for all neighbours (a first merge
        across tokens would also happen between those two alone).  So the tokens of two windows may be
        joined at a token that both have at the same place: all neighbours then stand side by side in
        one of them.  Windows without such a token are made one and encoded again.
        """
        tokens: list[dict[int, tuple[np.ndarray, np.ndarray]]] = [{} for _ in words]
        spans = []
        for w in words:
            starts = range(0, max(1, len(w) - OVERLAP), WINDOW - OVERLAP)
            spans.append([(a, min(a + WINDOW, len(w))) for a in starts])
        todo = [(i, a, b) for i, own in enumerate(spans) for a, b in own]
        joints: list[list[int | None]] = [[] for _ in words]
        while todo:
            found = self.contracted([words[i][a:b] for i, a, b in todo])
            for (i, a, _), ids in zip(todo, found):
                ids = np.frombuffer(ids, dtype="<u4")
                tokens[i][a] = (ids, a + np.cumsum(self.vocabulary.size[ids]))
            todo = []
            for i, own in enumerate(spans):
                joints[i] = [_common(tokens[i][a], a, tokens[i][c], c) for (a, _), (c, _) in zip(own, own[1:])]
                merged = [own[0]]
                for joint, (a, b) in zip(joints[i], own[1:]):
                    if joint is None:
                        merged[-1] = (merged[-1][0], b)
                    else:
                        merged.append((a, b))
                if len(merged) < len(own):
                    todo += [(i, a, b) for a, b in set(merged) - set(own)]
                    spans[i] = merged
        out = []
        for own, held, at in zip(spans, tokens, joints):
            parts = []
            for k, (a, _) in enumerate(own):
                ids, ends = held[a]
                lo = 0 if not k else int(np.searchsorted(ends, at[k - 1]))
                hi = len(ids) if k + 1 == len(own) else int(np.searchsorted(ends, at[k]))
                parts.append(ids[lo:hi].tobytes())
            out.append(b"".join(parts))
        return out

    def computed(self, words: list[bytes]) -> pa.Array:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        short, rest = [w for w in words if len(w) <= WINDOW], [w for w in words if len(w) > WINDOW]
        found = dict(zip(short, self.contracted(short))) | dict(zip(rest, self.windowed(rest)))
        return pa.array([found[w] for w in words], pa.large_binary())

    def ids_of(self, distinct: pa.Array) -> pa.Array:
        """Ids of each distinct word: those sent with the vocabulary, those remembered, and the others."""
        at = pc.index_in(distinct, value_set=self.vocabulary.words)
        missing = pc.is_null(at)
        own = self.known.values_of(distinct.filter(missing), self.computed)
        mask = missing.to_numpy(zero_copy_only=False)
        number = at.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        number[mask] = len(self.vocabulary.words) + np.arange(len(own))
        return pa.concat_arrays([self.vocabulary.word_ids, own]).take(pa.array(number))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        raw, offsets, per_text = self.splitter.words(texts)
        number, distinct = distinct_slices(raw, offsets)
        return laid_out(number, self.ids_of(distinct), per_text)

    def pieces(self, distinct: pa.Array) -> pa.Array:
        """Bytes of each distinct piece of ids, by ordered aggregation."""
        out = []
        for i in range(0, len(distinct), PIECES_CHUNK):
            flat, ends = _binary(distinct.slice(i, PIECES_CHUNK))
            t = np.frombuffer(flat, dtype="<u4")[ends[0] // 4:ends[-1] // 4].astype(np.int32)
            shown = self._query(PIECES, "pieces", pa.table({
                "w": np.repeat(np.arange(len(ends) - 1, dtype=np.int32), np.diff(ends) // 4),
                "g": np.arange(len(t), dtype=np.int32), "t": t}))["shown"].combine_chunks()
            text = "".join(shown.to_pylist()).encode("latin-1")
            size = np.concatenate(([0], np.cumsum(pc.utf8_length(shown).to_numpy().astype(np.int64))))
            out.append(binary_slices(text, size))
        return pa.concat_arrays(out) if out else pa.array([], pa.large_binary())

    def decode(self, encoded: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids."""
        flat = b"".join(encoded)
        ends = np.cumsum([0, *map(len, encoded)]) // 4
        ids = np.frombuffer(flat, dtype="<u4")
        cut = self.vocabulary.cuts[ids]
        cut[ends[:-1][np.diff(ends) > 0]] = True  # a piece does not span texts
        at = np.flatnonzero(cut)
        per_text = np.diff(np.searchsorted(at, ends))
        number, distinct = distinct_slices(flat, np.append(at, len(ids)) * 4)
        return laid_out(number, self.pieces(distinct), per_text)


def _common(left: tuple[np.ndarray, np.ndarray], a: int, right: tuple[np.ndarray, np.ndarray], c: int) -> int | None:
    """End of a token that two windows (starting at a < c) have at the same place; None if there is none."""
    ends, others = left[1], right[1]
    ends, others = ends[max(0, int(np.searchsorted(ends, c)) - 1):], np.concatenate(([c], others))
    # both have a boundary at x and the next boundary at the same y
    both = np.intersect1d(np.stack([ends[:-1], ends[1:]], 1) @ _PAIR, np.stack([others[:-1], others[1:]], 1) @ _PAIR)
    return int(both[len(both) // 2]) & 0xFFFFFFFF if len(both) else None


_PAIR = np.array([1 << 32, 1], dtype=np.int64)


def _binary(a: pa.Array) -> tuple[bytes, np.ndarray]:
    a = a.cast(pa.large_binary())
    _, offsets, data = a.buffers()
    return (data.to_pybytes() if data is not None else b""), np.frombuffer(offsets, dtype=np.int64)[a.offset:a.offset + len(a) + 1]


def _id_lists(encoded: list[bytes]) -> pa.Array:
    """Array of id lists whose values are the encoded bytes as they are."""
    ends = np.cumsum([0, *map(len, encoded)]) // 4
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.Array.from_buffers(
        pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(encoded))]))


def groups(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) in groups of bounded size; null: empty text."""
    at, size, some = 0, 0, []
    for i, t in enumerate(texts):
        t = t.as_py() or ""
        if some and size + len(t) > GROUP_BYTES:
            yield at, some
            at, size, some = i, 0, []
        some.append(t)
        size += len(t)
    if some:
        yield at, some


def frequent_words(docs: DataFrame, text_col: str, pattern: str) -> list[bytes]:
    """The ``FREQUENT`` most frequent words of some ``SAMPLED`` texts chosen by hash.

    Only the time of the encoding depends on them: a word that is missing here is contracted where it occurs.
    """
    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.count()
    chosen = docs.select(text.alias("t")).where(
        F.col("t").isNotNull() & (F.pmod(F.xxhash64("t"), F.lit(max(1, rows // SAMPLED))) == 0))
    words = chosen.select(F.explode(F.regexp_extract_all("t", F.lit(f"(?U)({pattern})"), F.lit(1))).alias("w"))
    top = (words.where(F.length("w") <= WINDOW // 4).groupBy("w").agg(F.count("*").alias("n"))
           .where("n > 1").orderBy(F.desc("n"), "w").limit(FREQUENT))
    return [r.w.encode() for r in top.select("w").collect() if r.w]


_KNOWN: dict[str, Remembered] = {}  # of a worker process, by vocabulary and pattern


def _mapped(docs: DataFrame, vocab_path: str, columns: list, text_col: str, fields: str, pattern: str,
            make: Callable[[Codec, list[str]], list[pa.Array]]) -> DataFrame:
    """``columns`` beside what ``make`` gives for the texts.

    The vocabulary's arrays are computed on the driver and sent with the tasks (about 10 MB with
    ``FREQUENT`` words; their size does not depend on the corpus).
    """
    vocabulary = Vocabulary(load_ranks(vocab_path), pattern).with_frequent(frequent_words(docs, text_col, pattern))
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    vocabulary_key = hashlib.sha256(vocabulary.pair.tobytes() + pattern.encode()).hexdigest()
    src = docs.select(*columns, F.col(f"`{text_col}`").cast("string").alias("__text"))
    k = len(columns)
    head = [f"{f.name} {f.dataType.simpleString()}" for f in src.schema.fields[:k]]
    names = [f.name for f in src.schema.fields[:k]] + [x.split()[0] for x in fields.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _KNOWN.setdefault(vocabulary_key, Remembered(REMEMBERED_BYTES))
        codec = Codec(shared.value, known)
        try:
            for b in batches:
                for at, texts in groups(b.column(k)):
                    kept = [b.column(i).slice(at, len(texts)) for i in range(k)]
                    yield pa.RecordBatch.from_arrays([*kept, *make(codec, texts)], names=names)
                    give_back()
        finally:
            codec.close()

    return map_arrow(src, run, ", ".join([*head, fields]))


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
           pattern: str = PATTERN) -> DataFrame:
    """(id, ids, decoded): token ids of every row and the bytes decoded from them."""
    def make(codec: Codec, texts: list[str]) -> list[pa.Array]:
        encoded = codec.encode(texts)
        return [_id_lists(encoded), pa.array(codec.decode(encoded), pa.binary())]
    return _mapped(docs, vocab_path, [F.col(f"`{id_col}`").alias("id")], text_col,
                   "ids array<int>, decoded binary", pattern, make)


def digests(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
            pattern: str = PATTERN) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): digests of what :func:`encode` gives, taken in the task.

    The ids and bytes, several times the text, need not leave it.
    """
    def make(codec: Codec, texts: list[str]) -> list[pa.Array]:
        encoded = codec.encode(texts)
        decoded = codec.decode(encoded)
        return [pa.array([len(e) // 4 for e in encoded], pa.int64()),
                pa.array([hashlib.sha256(e).hexdigest() for e in encoded]),
                pa.array([hashlib.sha256(d).hexdigest() for d in decoded])]
    return _mapped(docs, vocab_path, [F.col(f"`{id_col}`").alias("id")], text_col,
                   "n_tokens long, ids_sha256 string, decoded_sha256 string", pattern, make)


def tokenized(docs: DataFrame, vocab_path: str, columns: list[str], text_col: str = "text",
              pattern: str = PATTERN) -> DataFrame:
    """``columns`` of every row with n_tokens, ids and the digest of the decoded bytes."""
    def make(codec: Codec, texts: list[str]) -> list[pa.Array]:
        encoded = codec.encode(texts)
        ids = _id_lists(encoded)
        return [pa.array([len(e) // 4 for e in encoded], pa.int64()), ids,
                pa.array([hashlib.sha256(d).hexdigest() for d in codec.decode(encoded)])]
    return _mapped(docs, vocab_path, [F.col(f"`{c}`") for c in columns], text_col,
                   "n_tokens long, ids array<int>, decoded_sha256 string", pattern, make)
