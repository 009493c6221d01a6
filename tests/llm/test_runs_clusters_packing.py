"""Periodic runs, centroid clustering and packing against brute force."""
import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from medallion.llm import packing, periodic, queries, subvectors

SF = "/root/testdata/sf0.001"


# ---- periodic runs ----

def brute_runs(w, min_length=6, min_exponent=4):
    """Every (start, length, smallest period) by comparing words, position by position."""
    out = []
    for s in range(len(w)):
        for q in range(1, len(w) - s):
            if s and w[s - 1] == w[s + q - 1]:
                continue
            end = s + q
            while end < len(w) and w[end] == w[end - q]:
                end += 1
            n = end - s
            if n >= max(min_length, min_exponent * q) and not any(
                    all(w[s + i] == w[s + i + p] for i in range(n - p)) for p in range(1, q)):
                out.append((s, n, q))
    return out


def brute_collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("limits", [(6, 4), (2, 2), (6, 2), (3, 3), (10, 4)])
def test_runs_against_brute_force(seed, limits):
    rng = random.Random(seed)
    texts = []
    for _ in range(30):
        letters, n = rng.choice([1, 2, 3, 20]), rng.choice([0, 1, 5, 6, 7, 20, 60])
        w = [rng.choice("abcdefghijklmnopqrst"[:letters]) for _ in range(n)]
        if rng.random() < 0.6 and n > 5:
            a = rng.randrange(n)
            p = rng.randint(1, max(1, (n - a) // 3))
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)] + [rng.choice("ab") for _ in range(rng.randint(0, 9))]
        texts.append(w)
    words = periodic.Words([(" " * rng.randint(0, 2) + "\n ".join(w)).encode() for w in texts])
    found = periodic.all_runs(words, *limits)
    shown = periodic.collapsed(words, found)
    for i, w in enumerate(texts):
        assert found.get(i, []) == brute_runs(w, *limits)
        assert shown[i].decode() == brute_collapsed(w, found.get(i, []))


def test_runs_fill_whole_long_texts():
    words = periodic.Words([b"x " * 60_000, b"a b c " * 20_000 + b"a", b"q " + b"a b " * 3])
    assert periodic.all_runs(words, 6, 4) == {0: [(0, 60_000, 1)], 1: [(0, 60_001, 3)]}
    assert periodic.all_runs(words, 6, 3)[2] == [(1, 6, 2)]


def plain_op11(doc_id, text):
    w = (text or "").encode().split()
    if doc_id is not None and w:
        h = zlib.crc32(str(doc_id).encode())
        g, n = h // 10, len(w)
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _order(rows):
    return sorted(map(tuple, rows), key=str)


def test_op11_against_brute_force(spark, tmp_dir, edge_docs):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([0, 3, 12, 40])))) for i in range(300)]
    rows += [(None, "a a a a a a a"), (7, "b " * 40), (7, "b " * 40), (8, "x  y\tx\ny x y x y x y z"), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    rows = [tuple(r) for r in docs.collect()]
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    got = queries.op11_periodic_runs(spark, tmp_dir)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    # the brute force is cubic: the one text of 12,000 words (3,000 periods of four) is held against its known run
    found = [tuple(r) for r in got.collect()]
    small = [r for r in rows if len((r[1] or "").split()) <= 2000]
    assert _order(r for r in found if (r[3] or 0) <= 2000) == _order(plain_op11(*r) for r in small)
    assert [r[:6] for r in found if (r[3] or 0) > 2000] == [(7, 1, 0, 12_000, 4, 3_000_000)]


def test_runs_of_no_documents(spark, no_docs):
    assert periodic.periodic_runs(no_docs).collect() == []
    assert periodic.digests(periodic.periodic_runs(periodic.planted_periods(no_docs))).collect() == []


def test_runs_operator_gives_runs_and_text(spark, edge_docs):
    docs = spark.createDataFrame([(1, "go a b a b a b a b end", "x"), (2, None, "y")], "doc_id long, text string, runs string")
    got = {r.id: r for r in periodic.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[1].runs] == [(1, 8, 2)] and got[1].collapsed == "go a b end"
    assert got[2].runs == [] and got[2].collapsed == ""


# ---- centroid clustering ----

def plain_clusters(rows, k, rounds, dims):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) and abs(x) < 2 ** 21 for x in v):
            kept.append((i, [int(np.floor(64 * float(x))) for x in v]))
    key = [(i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "", v) for i, v in kept]
    centroids = [v for _, _, v in sorted(key)[:k]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out
    for _ in range(rounds):
        at = assign()
        for c in range(len(centroids)):
            own = [v for (_, v), (b, _) in zip(kept, at) if b == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    at = assign()
    total = sum(d for _, d in at)
    return [(i, c, d, sum(y for b, y in at if b == c), total,
             hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for (i, _), (c, d) in zip(kept, at)]


@pytest.mark.parametrize("width", [1, 2, 3, 8])
def test_clusters_against_brute_force(spark, width):
    rng = random.Random(width)
    dims = 7
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 1.0, rng.uniform(-1, 1)]) for _ in range(dims)]) for i in range(150)]
    rows += [(900 + i, rows[3][1]) for i in range(60)]  # a common vector
    rows += [(5, rows[9][1]), (5, rows[5][1]), (None, rows[1][1]), (None, None), (1001, None), (1002, []), (1003, [0.0] * 6),
             (1004, [0.0] * 6 + [None]), (1005, [0.0] * 6 + [float("nan")]), (1006, [0.0] * 6 + [float("inf")]),
             (1007, [3e30] + [0.0] * 6), (1008, [2.0 ** 20] * dims)]
    df = spark.createDataFrame([(*r, "x", 3) for r in rows], "vec_id long, embedding array<float>, cluster string, distance int")
    got, centroids = subvectors.cluster(df, dims=dims, k=5, rounds=3, width=width)
    as_float = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert _order(got.collect()) == _order(plain_clusters(as_float, 5, 3, dims))
    assert len(centroids) == 5


def test_clusters_of_few_vectors(spark):
    schema = "vec_id long, embedding array<double>"
    got, centroids = subvectors.cluster(spark.createDataFrame([], schema), dims=2)
    assert got.collect() == [] and centroids == []
    assert got.columns == ["id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    rows = [(1, [0.5, 0.25]), (2, [0.5, 0.25]), (3, [-4.0, 1.0])]
    got, centroids = subvectors.cluster(spark.createDataFrame(rows, schema), dims=2)
    assert _order(got.collect()) == _order(plain_clusters(rows, 16, 3, 2)) and len(centroids) == 3


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(1)
    v = rng.integers(-5, 5, (300, 7))
    for width in (1, 2, 3, 7):
        parts, codes = subvectors.encode_chunk(v, width)
        assert (np.concatenate([p[c] for p, c in zip(parts, codes)], axis=1) == v).all()
        assert all(len(np.unique(p, axis=0)) == len(p) for p in parts)


# ---- packing ----

PATH = public_tokenizers.path("word_bpe_49k.json")


def library_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [[*e.ids, 1] for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


def test_word_ids_against_library():
    rng = random.Random(11)
    pieces = ["a", "B", "it's", "'S", "'ll", "'", "''", "1", "42", ",", ".", "...", "-", "\u2026", "\u2014", "\u00e9", "e\u0301", "\u0301",
              "\u0130", "\u03a3", "\u03c3\u03a3", "\u4e2d\u6587", "\u00b2", "\u2167", "\u01c5", "<|endoftext|>", "<|startoftext|>", "\x1c", "\x85",
              "\u00a0", "\u3000", "\u200b", " ", "  ", "\n", "\t", "\x0b", "\x00", "\U0001f600", "_", "a_b", "x@y.z", "</w>", "&amp;"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 40))) for _ in range(2000)]
    with open(PATH, "rb") as f:
        encoder = packing.WordIds(f.read())
    encoder.known.limit = 20_000  # forgets often
    for at in range(0, len(texts), 100):
        got = encoder.encode([t.encode() for t in texts[at:at + 100]], struct.pack("<I", 1))
        assert [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in got] == library_ids(texts[at:at + 100])


def plain_round_robin(totals, quantum, granule):
    """(queue, place in the queue) of every id, served round by round."""
    left, credit, at, stream = list(totals), [0] * len(totals), [0] * len(totals), []
    while any(left):
        for k in range(len(totals)):
            credit[k] += int(quantum[k])
            while left[k] and credit[k] >= granule << packing.SHARE_BITS:
                credit[k] -= granule << packing.SHARE_BITS
                n = min(granule, left[k])
                stream += [(k, at[k] + i) for i in range(n)]
                at[k] += n
                left[k] -= n
    return stream


@pytest.mark.parametrize("seed", range(8))
def test_cut_is_deficit_round_robin(seed):
    rng = random.Random(seed)
    for _ in range(15):
        granule, window = rng.choice([1, 4, 64]), rng.choice([16, 64, 2048])
        texts = [[rng.randint(1, 300) for _ in range(rng.randint(1, 8))] for _ in range(rng.randint(1, 6))]
        totals = [sum(q) for q in texts]
        weights = None if rng.random() < 0.5 else [rng.random() + 0.1 for _ in texts]
        quantum = packing.quanta(totals, weights, window)
        rows = [(k, sum(q[:i]), n) for k, q in enumerate(texts) for i, n in enumerate(q)]
        rng.shuffle(rows)
        queue, start, n = (np.array(x, dtype=np.int64) for x in zip(*rows))
        got = {}
        for t, s, size, place in zip(*packing.cut(queue, start, n, quantum, np.array(totals), window, granule)):
            assert size > 0 and place // window == (place + size - 1) // window
            for i in range(size):
                assert place + i not in got
                got[place + i] = (queue[t], start[t] + s + i)
        assert [got.get(i) for i in range(sum(totals))] == plain_round_robin(totals, quantum, granule)


def check_pieces(pieces, docs, window=2048):
    """Every id lies in exactly one piece, and every sequence but the last is full and without gaps."""
    ids = library_ids([t for _, t in docs])
    whole = sorted(struct.pack(f"<{len(x)}I", *x) for x in ids)
    by_seq, by_doc = {}, {}
    for r in pieces:
        by_seq.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault((r.id, r.doc_tokens), []).append((r.start, bytes(r.ids), r.length))
    for seq, parts in by_seq.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or seq == max(by_seq)
    assert sorted(by_seq) == list(range(len(by_seq)))
    return whole, by_doc


def test_pack_keeps_every_id(spark, edge_docs):
    rows = [(100 + i, f"Some words, it's {i} o'clock " * (i % 40), f"s{i % 3}") for i in range(90)]
    rows += [(500, "<|endoftext|> İstanbul ΟΔΟΣ é 　x y 12345", None), (501, None, "s0")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(docs, PATH, window=256).collect()
    whole, by_doc = check_pieces(got, [(i, t) for i, t, _ in rows], 256)
    assert sorted(b"".join(x for _, x, _ in sorted(p)) for p in by_doc.values()) == whole
    seqs = packing.sequences(packing.pack(docs, PATH, window=256)).collect()
    assert sorted(len(bytes(r.ids)) // 4 for r in seqs)[1:] == [256] * (len(seqs) - 1)
    assert b"".join(sorted(whole)) and sum(len(bytes(r.ids)) for r in seqs) == sum(map(len, whole))


def test_pack_keeps_proportions(spark):
    rng = random.Random(2)
    rows = [(i, "word " * rng.randint(1, 400), rng.choice(["a", "a", "a", "b", "c"])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    got = packing.pack(docs, PATH).collect()
    total, share = sum(r.length for r in got), {}
    for r in got:
        share.setdefault(r.sequence_id, {}).setdefault(r.source, []).append(r.length)
    for s in "abc":
        want = 2048 * sum(r.length for r in got if r.source == s) / total
        for seq, found in share.items():
            if seq != max(share):
                assert abs(sum(found.get(s, [])) - want) <= 3 * packing.GRANULE
    # given weights: half of each window from b until it ends
    got = packing.pack(docs, PATH, weights={"b": 2, "a": 1, "c": 1}).collect()
    first = [r for r in got if r.sequence_id < 10]
    assert abs(sum(r.length for r in first if r.source == "b") - 10_240) <= 3 * packing.GRANULE
    assert sum(r.length for r in got) == total


def test_pack_of_edge_rows(spark, edge_docs, no_docs):
    assert packing.pack(no_docs, PATH).collect() == []
    docs = edge_docs.withColumn("offset", F.lit("x")).withColumn("ids", F.lit(1))
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = packing.pack(docs, PATH).collect()
    whole, _ = check_pieces(got, rows)
    assert sum(r.length for r in got) * 4 == sum(map(len, whole))
    assert sum(r.start == 0 for r in got) == len(rows)


def test_op13_on_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = dict(zip((i for i, _ in docs), library_ids([t for _, t in docs])))
    got = queries.op13_packing(spark, SF).collect()
    seen = {}
    for r in got:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert len(ids) == r.length and r.doc_tokens == len(want[r.doc_id])
        assert zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)) == r.ids_crc32
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {i: len(x) for i, x in want.items()}


def test_many_small_sources_share_queues(spark):
    rows = [(i, "a b c", f"host{i}") for i in range(3000)] + [(9999, "big " * 5000, "big")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = packing.pack(docs, PATH).collect()
    assert sum(r.length for r in got) == 3000 * 4 + 5001
    assert len({r.id for r in got}) == 3001
