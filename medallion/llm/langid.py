r"""Language ID with a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes.  Each byte becomes a vector,
filters of several widths run over the vectors, each filter keeps its greatest
response in the window (max pooling), and a softmax layer turns these into a
probability per language.  A text's probabilities are the mean over all of its
windows, weighted by their bytes.  The network is trained in numpy on windows of
a bounded, hash-chosen sample of labelled texts (``PER_LANG`` texts per language,
``WINDOWS_PER_TEXT`` windows each) and is then applied to every window of every
text, in blocks of fixed size.

Defined cases
* null text or a text without a letter: ``und`` with score 0;
* no labelled text at all: every text is ``und`` with score 0;
* texts with a null language are predicted but not learned from;
* a tie goes to the language that sorts first; repeated rows and ids: each row
  is predicted alone; empty table: empty result; texts are read whole; further
  columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import in_share, map_arrow, map_pandas, scratch, small_side

UNDECIDED = "und"
WINDOW = 128
EMBED = 8
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
PER_LANG = 400
WINDOWS_PER_TEXT = 8
EPOCHS = 6
BATCH = 128
BLOCK = 256  # windows in one forward step


class Model(NamedTuple):
    langs: list[str]
    embed: np.ndarray    # (256, EMBED)
    filters: np.ndarray  # (max width * EMBED, filters); narrow filters are zero beyond their width
    bias: np.ndarray
    dense: np.ndarray    # (filters, languages)
    offset: np.ndarray


def _mask() -> np.ndarray:
    m = np.zeros((max(WIDTHS) * EMBED, FILTERS * len(WIDTHS)), dtype=np.float32)
    for i, w in enumerate(WIDTHS):
        m[: w * EMBED, i * FILTERS:(i + 1) * FILTERS] = 1
    return m


def _columns(embed: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """(windows, positions, max width * EMBED): the vectors that a filter sees at each position."""
    e = embed[windows]
    n, length, k = e.shape
    s = e.strides
    return np.ascontiguousarray(np.lib.stride_tricks.as_strided(
        e, (n, length - max(WIDTHS) + 1, max(WIDTHS) * k), (s[0], s[1], s[2])))


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


def forward(model: Model, windows: np.ndarray) -> np.ndarray:
    """Probabilities (windows, languages)."""
    out = np.empty((len(windows), len(model.langs)), dtype=np.float64)
    for at in range(0, len(windows), BLOCK):
        c = _columns(model.embed, windows[at:at + BLOCK])
        r = (c.reshape(-1, c.shape[2]) @ model.filters).reshape(c.shape[0], c.shape[1], -1).max(axis=1)
        out[at:at + BLOCK] = _softmax(np.maximum(r + model.bias, 0) @ model.dense + model.offset)
    return out


def train(windows: np.ndarray, labels: np.ndarray, langs: list[str], seed: int = 7) -> Model:
    """Fit the network by Adam on (n, WINDOW) bytes and their class numbers.

    Beside each window stand a shortened one and, for every fourth, one in ASCII
    capitals, so that short texts and headlines are known too.
    """
    rng = np.random.default_rng(seed)
    short = np.where(np.arange(WINDOW) < rng.integers(3, WINDOW // 2, len(windows))[:, None], windows, 0)
    loud = windows[::4].copy()
    loud[(loud >= 97) & (loud <= 122)] -= 32
    windows, labels = np.concatenate((windows, short, loud)), np.concatenate((labels, labels, labels[::4]))
    mask = _mask()
    p = {"e": rng.normal(0, 0.5, (256, EMBED)), "f": rng.normal(0, 0.25, mask.shape) * mask,
         "b": np.zeros(mask.shape[1]), "d": rng.normal(0, 0.2, (mask.shape[1], len(langs))),
         "o": np.zeros(len(langs))}
    p = {k: v.astype(np.float32) for k, v in p.items()}
    m, v = ({k: np.zeros_like(x) for k, x in p.items()} for _ in range(2))
    t = 0
    wide = max(WIDTHS)
    for epoch in range(EPOCHS):
        rate = 0.01 * (1 - epoch / EPOCHS)
        order = rng.permutation(len(windows))
        for at in range(0, len(order), BATCH):
            own = order[at:at + BATCH]
            x, n = windows[own], len(own)
            c = _columns(p["e"], x)
            r = (c.reshape(-1, c.shape[2]) @ p["f"]).reshape(n, c.shape[1], -1)
            peak = r.argmax(axis=1)
            z = np.take_along_axis(r, peak[:, None, :], axis=1)[:, 0] + p["b"]
            h = np.maximum(z, 0)
            g = _softmax(h @ p["d"] + p["o"])
            g[np.arange(n), labels[own]] -= 1
            g /= n
            gz = (g @ p["d"].T) * (z > 0)
            seen = c[np.arange(n)[:, None], peak]  # (n, filters, wide * EMBED)
            grad = {"d": h.T @ g, "o": g.sum(axis=0), "b": gz.sum(axis=0),
                    "f": np.einsum("nf,nfk->kf", gz, seen) * mask}
            back = gz[:, :, None] * p["f"].T[None]  # to the vectors under each peak
            at_bytes = x[np.arange(n)[:, None, None], peak[:, :, None] + np.arange(wide)]
            ge = np.zeros_like(p["e"])
            np.add.at(ge, at_bytes.ravel(), back.reshape(-1, EMBED))
            grad["e"] = ge
            t += 1
            for k in p:
                m[k] += 0.1 * (grad[k] - m[k])
                v[k] += 0.001 * (grad[k] ** 2 - v[k])
                p[k] = (p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return Model(langs, p["e"], np.ascontiguousarray(p["f"]), p["b"], p["d"], p["o"])


def cut(text: np.ndarray) -> np.ndarray:
    """All windows of a text's bytes, the last one filled with zero bytes."""
    n = -(-len(text) // WINDOW)
    out = np.zeros(n * WINDOW, dtype=np.uint8)
    out[: len(text)] = text
    return out.reshape(n, WINDOW)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Data and offsets of a binary column (nulls have no bytes)."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + len(column) + 1]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), o


def sample_windows(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
                   id_col: str = "doc_id", per_lang: int = PER_LANG, per_text: int = WINDOWS_PER_TEXT) -> pd.DataFrame:
    """(lang, w): windows of at most ``per_lang`` texts of each language, chosen by hash.

    Only a text's own share of windows leaves its task, so the driver gets
    per_lang * per_text * WINDOW bytes for each language at most.
    """
    rows = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    size = rows.groupBy(F.col(lang_col).alias("_l")).agg(F.count("*").alias("_n"))
    share = rows.select(F.col(lang_col).alias("lang"), F.xxhash64(F.col(id_col), F.lit("langid")).alias("h"),
                        F.col(text_col).alias("t"))
    # small_side: one row for each language, broadcast if these are few
    share = (share.join(small_side(scratch(size, "langid-sizes")), F.col("lang") == F.col("_l"))
             .where(in_share(F.col("h"), F.col("_n"), 2 * per_lang))
             .where(F.col("t").rlike(r"\p{L}")).select("lang", "h", F.col("t").cast("binary").alias("t")))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for lang, h, t in zip(f["lang"], f["h"], f["t"]):
                w = cut(np.frombuffer(t, dtype=np.uint8))
                own = np.random.default_rng(h & 0x7FFFFFFF).permutation(len(w))[:per_text]
                out.append((lang, h, w[np.sort(own)].tobytes()))
            yield pd.DataFrame(out, columns=["lang", "h", "w"])

    first = Window.partitionBy("lang").orderBy("h", "w")
    return (map_pandas(share, run, "lang string, h long, w binary").withColumn("k", F.row_number().over(first))
            .where(F.col("k") <= per_lang).select("lang", "h", "w").toPandas()
            .sort_values(["lang", "h", "w"], ignore_index=True)[["lang", "w"]])


def fit(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang",
        id_col: str = "doc_id") -> Model | None:
    """Network trained on the rows where ``learn`` holds; None if there is no labelled text."""
    s = sample_windows(docs, learn, text_col, lang_col, id_col)
    if not len(s):
        return None
    langs = sorted(s["lang"].unique())
    number = {x: i for i, x in enumerate(langs)}
    parts = [np.frombuffer(w, dtype=np.uint8).reshape(-1, WINDOW) for w in s["w"]]
    labels = np.repeat([number[x] for x in s["lang"]], [len(x) for x in parts])
    return train(np.concatenate(parts), labels, langs)


def predict_column(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(class, probability) of each text of a binary column; no bytes: class 0, probability 0."""
    data, o = _bytes(column)
    size = np.diff(o)
    best, score = np.zeros(len(size), dtype=np.int64), np.zeros(len(size))
    at = 0
    while at < len(size):  # groups of texts with bounded bytes; a single text may be longer
        to = max(at + 1, int(np.searchsorted(o, o[at] + (1 << 23), side="right")) - 1)
        many = -(-size[at:to] // WINDOW)
        w = np.zeros((int(many.sum()), WINDOW), dtype=np.uint8)
        flat, row = w.reshape(-1), 0
        for i in range(at, to):
            flat[row * WINDOW: row * WINDOW + size[i]] = data[o[i]: o[i + 1]]
            row += many[i - at]
        p = forward(model, w)
        weight = np.full(len(w), WINDOW, dtype=np.float64)
        full = np.flatnonzero(many)
        ends = np.cumsum(many)[full]
        weight[ends - 1] -= many[full] * WINDOW - size[at:to][full]
        mean = np.add.reduceat(p * weight[:, None], ends - many[full], axis=0) if len(full) else np.zeros((0, p.shape[1]))
        mean /= size[at:to][full][:, None]
        best[at + full] = mean.argmax(axis=1)
        score[at + full] = np.clip(mean.max(axis=1), 0, 1) if len(full) else 0
        at = to
    return best, score


def _predictor(model: Model | None, keep: list[str], at: int):
    """Adds lang_pred and score to the columns ``keep``; column ``at`` holds the text, the last one whether it has a letter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(i) for i in range(len(keep))]
            text, letter = b.column(at), b.column(b.num_columns - 1)
            has = np.array(letter.fill_null(False).to_pylist(), dtype=bool)
            if model is None:
                best, score, has = np.zeros(len(has), int), np.zeros(len(has)), np.zeros(len(has), bool)
            else:
                best, score = predict_column(model, text)
            langs = [model.langs[i] if h else UNDECIDED for i, h in zip(best, has)]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(langs, pa.string()), pa.array(np.where(has, score, 0.0))],
                names=[*keep, "lang_pred", "score"])
    return run


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) of every row."""
    t = F.col(f"`{text_col}`")
    src = docs.select(F.col(f"`{id_col}`").alias("id"), t.cast("binary").alias("t"), t.rlike(r"\p{L}").alias("letter"))
    kind = src.schema["id"].dataType.simpleString()
    return map_arrow(src, _predictor(model, ["id"], 1), f"id {kind}, lang_pred string, score double")


def identified(docs: DataFrame, model: Model | None, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is found with at least ``min_score``; columns unchanged.

    The prediction runs beside the rows (one pass, no shuffle): all columns go
    through the task as they are.
    """
    names = docs.columns
    t = F.col(f"`{text_col}`")
    inner = [f"c{i}" for i in range(len(names))]
    src = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)], t.rlike(r"\p{L}").alias("letter"))
    schema = ", ".join(f"{i} {docs.schema[k].dataType.simpleString()}" for k, i in enumerate(inner))
    out = map_arrow(src, _predictor(model, inner, names.index(text_col)), f"{schema}, lang_pred string, score double")
    out = out.where((F.col("lang_pred") != UNDECIDED) & (F.col("score") >= min_score))
    return out.select(*[F.col(i).alias(c) for c, i in zip(names, inner)])


def crc_rest(id_col: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: of the empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus
