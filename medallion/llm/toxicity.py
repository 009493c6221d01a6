"""Toxicity by a weighted finite-state pattern grammar.

A first transducer reads words and writes classes: insult (with a weight),
threat, target, negation, reported speech or other.  Four small transducers read
the classes of a clause: which harm was said, whether a target stands with it,
whether a negation shortly before covers it, and whether it is reported.  They
are composed into one automaton (:func:`compose`), which writes one pattern for
each clause that holds harm: (kind, target, negated, reported).  A text's score
is a logistic function of the weights of its clauses by pattern.

The words of the insult transducer (whole words and beginnings of words) and
their weights are learned from labelled texts; the pattern weights are learned
too and fall back to the prior ``PRIOR`` where the labels show no such clause.
Learning uses a hash-chosen sample of at most ``PER_LABEL`` ids for each label, one text of each.

Defined cases
* null or empty text, or a text without a harmful clause: the score of a text without harm;
* no labelled text, or labels of one kind only: scores by the prior alone, with the seed words;
* labels without a text, null labels and null ids are not learned from; of several
  labels of an id the greatest counts;
* repeated rows: each is scored alone; empty table: empty result; texts are read
  whole; further columns are ignored.
"""
from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_scratch, in_share, map_arrow, scratch

PER_LABEL = 3000
PARTS = 30          # hash parts of a label that are ranked apart
MIN_TEXTS = 6       # toxic texts that a learned pattern needs
MIN_WEIGHT = 2.0    # and its least log-odds
PREFIXES = range(4, 9)
SCOPE = 3           # words that a negation covers
MEMO = 400_000

#: Seed words in four languages (fixed values).
THREAT = "kill hurt destroy murder stab shoot tuer frapper détruire töten schlagen vernichten matar golpear destruir".split()
TARGET = ("you your yourself he she they them him her tu toi vous votre te du dich dir ihr euch sie tú usted ustedes "
          "ti él ella ellos").split()
NEGATION = "not no never neither nor isn aren wasn don doesn pas jamais nicht kein keine nie nunca jamás ni".split()
REPORT = ("said says say wrote writes claimed called reported quoted dit écrit déclaré sagte sagt schrieb dijo dice "
          "escribió").split()
SEED_INSULTS = {"idiot": 3.0, "moron": 3.0, "scum": 3.0}

_TOKEN = re.compile(r"[^\W\d_]+|[.!?;:\n]")
_END = frozenset(".!?;:\n")
OTHER, INSULT, THREAT_, TARGET_, NEGATION_, REPORT_, END = range(7)
KINDS = ("insult", "threat")
PATTERNS = list(product(KINDS, (False, True), (False, True), (False, True)))  # kind, target, negated, reported
N_FEATURES = len(PATTERNS) + 1
#: Weight of one unit of clause weight by pattern before learning, then the weight of the density of harmful words.
PRIOR = np.array([(0.6 if kind == "insult" else 0.5) * (1.4 if target else 1.0) * (0.2 if negated else 1.0)
                  * (0.4 if reported else 1.0) for kind, target, negated, reported in PATTERNS] + [0.5])
PRIOR_OFFSET = -2.5


class Lexicon(NamedTuple):
    words: dict[str, float]     # whole words
    prefixes: dict[str, float]  # beginnings of words


class Model(NamedTuple):
    lexicon: Lexicon
    weights: np.ndarray
    offset: float


# ---- the clause automaton ---------------------------------------------------------------------

def _harm(state: int, c: int) -> int:
    return {INSULT: state | 1, THREAT_: state | 2, END: 0}.get(c, state)


def _target(state: int, c: int) -> int:
    return {TARGET_: 1, END: 0}.get(c, state)


def _negation(state: int, c: int) -> int:
    """Words that the last negation still covers; 9: it covered a harmful word."""
    if c == END:
        return 0
    if c == NEGATION_:
        return state if state == 9 else SCOPE
    if c in (INSULT, THREAT_):
        return 9 if state else 0
    return state if state in (0, 9) else state - 1


def _report(state: int, c: int) -> int:
    return {REPORT_: 1, END: 0}.get(c, state)


def compose() -> tuple[list[list[int]], list[list[int]]]:
    """Transition table and, for each state, the pattern numbers that the end of a clause writes."""
    parts = (_harm, _target, _negation, _report)
    number, table, todo = {(0, 0, 0, 0): 0}, [], [(0, 0, 0, 0)]
    for state in todo:
        row = []
        for c in range(7):
            nxt = tuple(f(s, c) for f, s in zip(parts, state))
            if nxt not in number:
                number[nxt] = len(number)
                todo.append(nxt)
            row.append(number[nxt])
        table.append(row)
    writes = []
    for harm, target, negation, report in todo:
        writes.append([PATTERNS.index((k, bool(target), negation == 9, bool(report)))
                       for i, k in enumerate(KINDS) if harm >> i & 1])
    return table, writes


TABLE, WRITES = compose()


class Reader:
    """Word transducer with a bounded memory of words seen, and the automaton over its classes."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.memo: dict[str, tuple[int, float]] = {}
        self.fixed = ({w: (END, 0.0) for w in _END} | {w: (REPORT_, 0.0) for w in REPORT}
                      | {w: (NEGATION_, 0.0) for w in NEGATION} | {w: (TARGET_, 0.0) for w in TARGET}
                      | {w: (THREAT_, 2.0) for w in THREAT})

    def read(self, word: str) -> tuple[int, float]:
        found = self.fixed.get(word)
        if found is None:
            weight = self.lexicon.words.get(word)
            if weight is None:
                weight = next((self.lexicon.prefixes[word[:k]] for k in reversed(PREFIXES)
                               if word[:k] in self.lexicon.prefixes and len(word) >= k), None)
            found = (OTHER, 0.0) if weight is None else (INSULT, weight)
        if len(self.memo) > MEMO:
            self.memo.clear()
        self.memo[word] = found
        return found

    def features(self, text: str | None) -> np.ndarray:
        """Clause weight by pattern (logarithmic), then the density of harmful words."""
        x = np.zeros(N_FEATURES)
        tokens = _TOKEN.findall((text or "").lower())
        memo = self.memo
        classes = [memo.get(t) or self.read(t) for t in tokens]
        if not any(w for _, w in classes):
            return x
        state, weight, harm = 0, 0.0, 0
        for c, w in classes + [(END, 0.0)]:
            if c == END:
                for p in WRITES[state]:
                    x[p] += weight
                weight = 0.0
            elif w:
                weight += w
                harm += 1
            state = TABLE[state][c]
        x[:-1] = np.log1p(x[:-1])
        x[-1] = np.log1p(100.0 * harm / len(tokens))
        return x


# ---- learning ----------------------------------------------------------------------------------

def labelled_sample(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic", per_label: int = PER_LABEL) -> DataFrame:
    """(text, toxic) of at most ``per_label`` ids of each label, one text of each; ``learn`` is a condition on ``id``.

    Of several texts of an id the one with the smallest hash counts, so repeated rows do not enlarge the sample.
    """
    y = (labels.select(F.col(id_col).alias("id"), (F.col(label_col) > 0).cast("int").alias("toxic"))
         .where("id is not null and toxic is not null").groupBy("id").agg(F.max("toxic").alias("toxic")))
    y = y.where(learn).withColumn("h", F.xxhash64(F.col("id"), F.lit("toxic")))
    size = y.groupBy(F.col("toxic").alias("_t")).agg(F.count("*").alias("_n"))
    # the first of each hash part, so that no task ranks a whole label
    part = F.pmod(F.shiftright("h", 32), F.lit(PARTS))
    first = Window.partitionBy("toxic", part).orderBy("h", "id")
    some = (y.join(F.broadcast(size), F.col("toxic") == F.col("_t"))  # two rows
            .where(in_share(F.col("h"), F.col("_n"), 2 * per_label))
            .withColumn("k", F.row_number().over(first)).where(F.col("k") * PARTS <= max(per_label, PARTS))
            .select("id", "toxic"))
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text is not null")
    some = F.broadcast(some)  # per_label rows for each of two labels at most
    return (d.join(some, "id").groupBy("id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
            .select("text", "toxic"))


def learn_lexicon(sample: DataFrame) -> Lexicon:
    """Words and beginnings of words with high log-odds of a toxic text, counted by Spark."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n: Counter = Counter()
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = set(_TOKEN.findall((text or "").lower()))
                seen = words | {f"{w[:k]}*" for w in words for k in PREFIXES if len(w) >= k}
                n.update((s, toxic > 0) for s in seen if s not in _END)
            yield pa.RecordBatch.from_arrays(
                [pa.array([s for s, _ in n], pa.string()), pa.array([int(t) for _, t in n], pa.int64()),
                 pa.array(list(n.values()), pa.int64())], names=["form", "toxic", "n"])

    total = {r["t"]: r["n"] for r in sample.groupBy((F.col("toxic") > 0).alias("t")).agg(F.count("*").alias("n")).collect()}
    pos, neg = total.get(True, 0), total.get(False, 0)
    if not pos or not neg:
        return Lexicon(dict(SEED_INSULTS), {})
    forms = (map_arrow(sample, run, "form string, toxic long, n long").groupBy("form")
             .agg(F.sum(F.col("toxic") * F.col("n")).alias("a"), F.sum((1 - F.col("toxic")) * F.col("n")).alias("b"))
             .withColumn("w", F.log((F.col("a") + 0.5) / (pos + 1.0)) - F.log((F.col("b") + 0.5) / (neg + 1.0)))
             .where((F.col("a") >= MIN_TEXTS) & (F.col("w") >= MIN_WEIGHT)))
    # at most as many forms as MIN_TEXTS * forms fit into the sampled texts
    rows = forms.select("form", "w").collect()
    words = {r["form"]: r["w"] for r in rows if not r["form"].endswith("*")}
    prefixes = {r["form"][:-1]: r["w"] for r in rows if r["form"].endswith("*")}
    # a beginning says more than its words only if it is toxic in general
    return Lexicon(words, prefixes)


def _feature_rows(texts: DataFrame, lexicon: Lexicon) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(lexicon)
        for b in batches:
            x = [reader.features(t).tolist() for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), b.column(1)], names=["x", "toxic"])
    return map_arrow(texts.select("text", "toxic"), run, "x array<double>, toxic int")


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def learn_weights(x: np.ndarray, y: np.ndarray, strength: float = 2.0) -> tuple[np.ndarray, float]:
    """Logistic regression, drawn towards the prior, by Newton steps."""
    w = np.append(PRIOR, PRIOR_OFFSET)
    prior = w.copy()
    a = np.column_stack((x, np.ones(len(x))))
    pull = np.full(len(w), strength)
    pull[-1] = 1e-3
    for _ in range(30):
        p = _logistic(a @ w)
        g = a.T @ (p - y) + pull * (w - prior)
        step = np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a + np.diag(pull), g)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    sample = scratch(labelled_sample(docs, labels, learn, id_col, text_col, label_col), "toxic-sample")
    lexicon = learn_lexicon(sample)
    rows = _feature_rows(sample, lexicon).collect()  # 2 * PER_LABEL rows of N_FEATURES numbers at most
    drop_scratch(sample)
    rows.sort(key=lambda r: (r["toxic"], r["x"]))
    y = np.array([float(r["toxic"] > 0) for r in rows])
    if not len(y) or y.min() == y.max():
        return Model(lexicon, PRIOR, PRIOR_OFFSET)
    return Model(lexicon, *learn_weights(np.array([r["x"] for r in rows]), y))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    src = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model.lexicon)
        for b in batches:
            x = np.array([reader.features(t.as_py()) for t in b.column(1)]).reshape(-1, N_FEATURES)
            s = _logistic(x @ model.weights + model.offset)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], names=["id", "score"])

    return map_arrow(src, run, f"id {kind}, score double")
