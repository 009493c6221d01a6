"""SimHash and embedding near-duplicates, components, and the pipeline."""
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from medallion.llm import hnsw, pii, queries, simhash
from medallion.llm.components import components

SF = "/root/testdata/sf0.001"


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


# ---- components ----

@pytest.mark.parametrize("kind", ["chain", "star", "random", "none"])
def test_components(spark, kind):
    rng = random.Random(1)
    links = {"chain": [(i, i + 1) for i in range(200)], "star": [(500, i) for i in range(300)],
             "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(180)], "none": [(3, 3)]}[kind]
    u = Union()
    for a, b in links:
        if a != b:
            u.join(a, b)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: u.find(x) for x in list(u.up)}


# ---- SimHash ----

def _fingerprint(text, k=3):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    shingles = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64))


def test_fingerprint_against_brute_force():
    rng = random.Random(0)
    texts = [None, "", " \n", "one", "Two words", "É ÀB c", "a b c"] + [
        " ".join(rng.choices(["Ab", "cd", "éf", "GH", "x"], k=rng.randint(1, 40))) + rng.choice(["", "\x0b", "\n"]) for _ in range(200)]
    for t in texts:
        assert simhash.fingerprint(None if t is None else t.encode()) == _fingerprint(t)


def test_native_hash_is_the_same(spark):
    texts = ["a b c", "é à", "x" * 100]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(F.xxhash64("t")).collect()
    assert [r[0] & (2 ** 64 - 1) for r in got] == [xxhash.xxh64_intdigest(t.encode(), 42) for t in texts]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5])
def test_bit_slices_against_popcount(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2 ** 63, 20, dtype=np.uint64)
    fps = np.array([b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, rng.integers(0, 7), replace=False)))
                    for b in base for _ in range(15)], dtype=np.uint64)
    want = {(i, j) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(fps ^ fps[i]) <= radius).tolist()}
    got = {(i, int(j)) for i, found in simhash.within(fps, fps, radius) for j in found}
    assert got == want
    y = fps[rng.permutation(len(fps))]
    assert (simhash.lanes_within(fps, y, radius) == (np.bitwise_count(fps ^ y) <= radius)).all()


def test_links_with_hot_files_and_blocks(spark):
    """Many fingerprints that share parts, dealt into small blocks, against all pairs."""
    rng = np.random.default_rng(3)
    hot = [int(x) << 40 | 0x00ABCDEF01 for x in rng.integers(0, 2 ** 20, 300)]
    fps = sorted({*hot, *(h ^ 1 << int(b) for h, b in zip(hot[:80], rng.integers(0, 64, 80))),
                  *(int(x) for x in rng.integers(0, 2 ** 63, 200)), 0, 3, 2 ** 64 - 1})
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    u = Union()
    for i, a in enumerate(fps):
        u.find(signed[i])
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= 2:
                u.join(signed[i], signed[j])
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for block in (7, 1024):
        links = simhash.fingerprint_links(df, 2, block)
        roots = {r["node"]: r["root"] for r in components(links).collect()}
        assert {x: roots.get(x, x) for x in signed} == {x: u.find(x) for x in signed}


def test_simhash_edge_rows(spark, edge_docs, no_docs):
    out = simhash.near_duplicates(edge_docs).collect()
    assert len(out) == 13
    fps = Counter((r["id"], r["fp"] & (2 ** 64 - 1)) for r in out)
    assert fps == Counter((r["doc_id"], _fingerprint(r["text"])) for r in edge_docs.collect())
    comp = {r["id"]: r["component"] for r in out if r["id"] is not None}
    assert comp[1] == comp[2] == 1 and comp[3] == comp[4] == comp[5] == 3
    assert {r["component"] for r in out if r["id"] is None} == {None, 3}
    kept = simhash.dedup(edge_docs)
    assert kept.columns == edge_docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([1, 3, 6, None, 7, 8, 9])
    assert simhash.dedup(no_docs).count() == 0 and simhash.near_duplicates(no_docs).count() == 0


def test_one_row_stays_for_each_group(spark):
    docs = spark.createDataFrame([(5, "same text here now", "b")] * 40 + [(5, "same text here now", "a"), (6, "same text here now", "c"),
                                 (5, "another text altogether with words", "z")], "doc_id long, text string, extra string")
    kept = sorted((r["doc_id"], r["text"][:4]) for r in simhash.dedup(docs).collect())
    assert kept == [(5, "anot"), (5, "same")]


def test_op8_contract(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    fps = {d: _fingerprint(t) for d, t in texts.items()}
    u = Union()
    for a in fps:
        for b in fps:
            if a <= b and (fps[a] ^ fps[b]).bit_count() <= 2:
                u.join(a, b)
    for r in queries.op8_simhash(spark, SF).collect():
        assert r["fingerprint"] == f"{fps[r['doc_id']]:016x}" and r["component_id"] == u.find(r["doc_id"])


# ---- embeddings ----

def _vectors(seed=0, clusters=12, lone=400, dim=24):
    rng = np.random.default_rng(seed)
    out = [rng.normal(size=dim) for _ in range(lone)]
    for c in range(clusters):
        centre = rng.normal(size=dim)
        out += [centre + rng.normal(size=dim) * 0.08 for _ in range(3 + 12 * c)]
    return [v.astype(np.float32).tolist() for v in out]


def _truth(vectors):
    v = np.array(vectors, dtype=np.float64)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    s = v @ v.T >= 0.95
    np.fill_diagonal(s, False)
    u = Union()
    for i in range(len(v)):
        u.find(i)
        for j in np.flatnonzero(s[i]).tolist():
            u.join(i, j)
    return s.sum(axis=1), [u.find(i) for i in range(len(v))]


def test_embedding_links_against_brute_force(spark):
    vectors = _vectors()
    links, roots = _truth(vectors)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>")
    got = {r["id"]: r for r in hnsw.near_duplicates(df).collect()}
    found = sum(min(got[i]["n_links"], links[i]) for i in range(len(vectors)))
    assert found >= 0.99 * links.sum() and all(got[i]["n_links"] <= links[i] for i in range(len(vectors)))
    assert sum(got[i]["component"] == roots[i] for i in range(len(vectors))) >= 0.99 * len(vectors)


def test_recall_audit_widens_beams():
    """A beam of one node misses neighbours; the audit widens it until the recall is reached."""
    v = hnsw._unit(__import__("pandas").Series(_vectors(1, clusters=6, lone=200)))
    g = hnsw.build(v.astype(np.float32))
    hits, got, beam = hnsw.search(g, v, v, beam=1, recall=0.99)
    truth = [np.flatnonzero(r >= 0.95) for r in v @ v.T]
    assert got >= 0.99 and sum(len(np.intersect1d(a, b)) for a, b in zip(hits, truth)) >= 0.97 * sum(map(len, truth))
    broken = g._replace(layers=[np.full_like(x, -1) for x in g.layers])
    hits, got, _ = hnsw.search(broken, v, v, beam=1, recall=0.99)
    assert got == 1.0 and all((a == b).all() for a, b in zip(hits, truth))


def test_embedding_edge_rows(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.0]), (3, [1.0, 0.0]), (None, [1.0, 0.01]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [1.0, None]), (8, [float("nan"), 1.0]), (9, [float("inf"), 1.0]), (10, [1.0]), (11, [3.0]), (12, [1e30, 1e30]), (13, [-1.0, 0.0]),
            (14, [-0.0, 1.0]), (15, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("key", F.lit("clash"))
    out = sorted(((r["id"], r["n_links"], r["component"]) for r in hnsw.near_duplicates(df).collect()), key=str)
    want = [(1, 4, 1), (2, 4, 1), (3, 4, 1), (3, 4, 1), (None, 4, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7), (8, 0, 8), (9, 0, 9),
            (10, 1, 10), (11, 1, 10), (12, 0, 12), (13, 0, 13), (14, 1, 14), (15, 1, 14)]
    assert out == sorted(want, key=str)
    assert hnsw.near_duplicates(df.limit(0)).count() == 0


def test_wide_clusters_are_counted_in_tiles(spark, monkeypatch):
    """A third of the vectors in one cluster: no beam over the limit, no task with all its queries, exact counts."""
    rng = np.random.default_rng(5)
    centre = rng.normal(size=24)
    vectors = [(centre + rng.normal(size=24) * 0.02).tolist() for _ in range(500)] + rng.normal(size=(1000, 24)).tolist()
    widths, search = [], hnsw.beam_search
    v = hnsw._unit(__import__("pandas").Series(vectors))
    g = hnsw.build(v.astype(np.float32))
    with monkeypatch.context() as m:
        m.setattr(hnsw, "beam_search", lambda g, v, q, s, w: widths.append(w) or search(g, v, q, s, w))
        found = dict(hnsw._verified(g, v, v[:100], 0.95, 32, hnsw.LIMIT))
    assert max(widths) <= hnsw.LIMIT and all(found[i] is None for i in range(100))
    links, roots = _truth(vectors)
    blocks, compared = [], hnsw.compared_links
    monkeypatch.setattr(hnsw, "compared_links", lambda a, g, b, t: blocks.append(b) or compared(a, g, b, t))
    monkeypatch.setattr(hnsw, "SHARDS", 2)
    monkeypatch.setattr(hnsw, "WIDE_ROWS", 200)
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    got = {r["id"]: r for r in hnsw.near_duplicates(df).collect()}
    assert blocks == [3]
    assert [got[i]["n_links"] for i in range(1500)] == links.tolist()
    assert [got[i]["component"] for i in range(1500)] == roots


def test_audit_plants_links_where_they_are_rare(spark, monkeypatch):
    """Rare near copies: the audit asks a bounded number of queries, and plants as many beside stored vectors."""
    rng = np.random.default_rng(6)
    lone = rng.normal(size=(1200, 24))
    vectors = [*lone.tolist(), *(lone[:12] + rng.normal(size=(12, 24)) * 0.02).tolist()]
    df = spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")
    monkeypatch.setattr(hnsw, "AUDIT", 600)
    monkeypatch.setattr(hnsw, "SHARDS", 2)
    asked, true = [], hnsw.true_links
    monkeypatch.setattr(hnsw, "true_links", lambda *a: asked.append(a[0].count()) or true(*a))
    out = hnsw.near_duplicates(df)
    assert 500 < out.audit.planted < 760 and out.audit.part < 0.6 and out.audit.recall >= 0.99
    assert len(asked) == 2 and asked[0] == 2 * asked[1] and asked[1] < 700  # every shard; then one shard each
    links, _ = _truth(vectors)
    assert {r["id"]: r["n_links"] for r in out.collect()} == dict(enumerate(links.tolist()))


def test_planted_queries_lie_within_the_threshold(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.normal(size=10).tolist(), 10) for i in range(50)] + [(99, [3.0], 1)]
    some = spark.createDataFrame(rows, "key long, vec array<double>, dim int")
    got = hnsw.planted(some, 4, 0.95).join(some.select(F.xxhash64(F.lit("planted"), "key").alias("key"), F.col("vec").alias("v")), "key")
    cosines = [np.dot(r["vec"], r["v"]) / np.linalg.norm(r["vec"]) / np.linalg.norm(r["v"]) for r in got.collect()]
    assert len(cosines) == 51 and min(cosines) >= 0.95 and sum(c < 0.999999 for c in cosines) == 50


def test_vectors_that_share_a_hash_stay_apart(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "class_key", lambda vec: F.pmod(F.xxhash64(vec), F.lit(7)))
    vectors = _vectors(clusters=4, lone=60)
    links, roots = _truth(vectors)
    out = hnsw.near_duplicates(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"))
    assert [(r["n_links"], r["component"]) for r in out.orderBy("id").collect()] == list(zip(links.tolist(), roots))


def test_shards_are_bounded_by_values():
    assert hnsw._bounded(hnsw.ROWS_PER_SHARD, 24) == hnsw._bounded(hnsw.ROWS_PER_SHARD, 64) == 50_000
    assert hnsw._bounded(hnsw.ROWS_PER_SHARD, 1024) == 3125 and hnsw._bounded(hnsw.WIDE_ROWS, 1 << 30) == 1


def test_audit_compares_if_no_beam_finds_the_links(spark, monkeypatch):
    """Graphs without edges: the audit sees the missing links of all shards, and every vector is compared."""
    build = hnsw.build_graphs
    monkeypatch.setattr(hnsw, "SHARDS", 2)
    monkeypatch.setattr(hnsw, "build_graphs", lambda *a: build(*a).withColumn("layers", F.transform(
        "layers", lambda x: F.unhex(F.repeat(F.lit("FF"), F.length(x))))))
    vectors = _vectors(clusters=5, lone=300)
    links, roots = _truth(vectors)
    out = hnsw.near_duplicates(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>"))
    assert out.audit.beam == 0 and out.audit.links == links.sum()
    assert [(r["n_links"], r["component"]) for r in out.orderBy("id").collect()] == list(zip(links.tolist(), roots))


def test_queries_search_one_graph_of_hubs_whatever_the_shards(spark, monkeypatch):
    """The graph holds a few of the vectors, each shard holds its vectors once, and the links stay whole."""
    vectors = _vectors(3, clusters=8, lone=2200)
    links, roots = _truth(vectors)
    monkeypatch.setattr(hnsw, "CELL", 16)
    tables, hub_graphs, build = {}, hnsw.hub_graphs, hnsw.build_graphs
    monkeypatch.setattr(hnsw, "hub_graphs", lambda *a: tables.setdefault("hubs", hub_graphs(*a).cache()))
    monkeypatch.setattr(hnsw, "build_graphs", lambda *a: tables.setdefault("shards", build(*a).cache()))
    out = hnsw.near_duplicates(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<float>"))
    assert [(r["n_links"], r["component"]) for r in out.orderBy("id").collect()] == list(zip(links.tolist(), roots))
    hubs, rows, dim = tables["hubs"].collect(), tables["shards"].collect(), len(vectors[0])
    assert len(hubs) == 1 and hnsw.BEAM < len(hubs[0]["vectors"]) // (4 * dim) < len(vectors) // 10
    assert sum(len(r["keys"]) for r in rows) == 8 * len(vectors) and {r["shard"] for r in rows} == set(range(hnsw.SHARDS))
    assert sum(len(r["vectors"]) for r in rows) == 4 * dim * len(vectors)  # single precision holds them
    for t in tables.values():
        t.unpersist()


def test_cells_meet_the_queries_of_their_hubs():
    rng = np.random.default_rng(4)
    v = rng.normal(size=(300, 6))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    cells = np.argsort(rng.random((300, 9)), axis=1)[:, :hnsw.HOMES].astype(np.int32)
    cells[250:, 2:] = -1
    asked = [np.flatnonzero(rng.random(9) < 0.3).astype(np.int32) for _ in range(300)]
    found = hnsw.Routes(np.concatenate(asked), np.array([len(a) for a in asked]), np.arange(300) == 7)
    want = {i: [j for j in range(300) if v[i] @ v[j] >= 0.6 and set(asked[i]) & set(cells[j].tolist())] for i in range(300)}
    got = dict(hnsw._met(v, cells, v, found, 0.6, 1000))
    assert got.pop(7) is None and {i: h.tolist() for i, h in got.items()} == {i: w for i, w in want.items() if w and i != 7}
    few = dict(hnsw._met(v, cells, v, found, 0.6, 12))
    assert all(few[i] is None or few[i].tolist() == w for i, w in want.items() if w and i != 7)
    assert all(few[i] is None for i, w in want.items() if len(w) >= 12) and any(h is not None for h in few.values())


def test_beams_of_hubs_widen_in_dense_regions():
    """Beams that end within twice the threshold's angle are widened; those of a region with too many hubs are far."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(2, 24))
    some = [c + rng.normal(size=(n, 24)) * 0.04 for c, n in zip(centres, (60, 200))]
    v = hnsw._units(np.concatenate([*some, rng.normal(size=(400, 24))]))
    found = hnsw.routes(hnsw.build(v.astype(np.float32)), v, 0.95, 32, 128)
    assert not found.far[:60].any() and (found.sizes[:60] == 64).all()
    assert found.far[60:260].all() and (found.sizes[60:260] == hnsw.HOMES).all()
    assert not found.far[260:].any() and (found.sizes[260:] == 32).all()
    own = hnsw.homes(found)[:, 0] == np.arange(660)  # others link with far vectors too, so these hang on hubs as well
    assert own[:260].mean() > 0.9 and own[260:].mean() > 0.9
    alone = hnsw.routes(None, v, 0.95, 32, 128)
    assert alone.far.all() and not len(alone.hubs)


def test_packed_vectors_keep_their_values():
    for v in (np.array([[1.5, -0.25]]), np.array([[0.1, 1e300]]), np.array([[1e-310, 3.0]])):
        assert (hnsw._unpacked(hnsw._packed(v), 1, 2) == v).all()
    assert len(hnsw._packed(np.array([[1.5, -0.25]]))) == 8 and len(hnsw._packed(np.array([[0.1, 1.0]]))) == 16


# ---- pipeline ----

def test_pipeline_stages(spark, edge_docs):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    docs = source.unionByName(edge_docs.select(*source.columns))
    kept = docs
    for name, stage in corpus_pipeline.STAGES:
        before, kept = kept, corpus_pipeline.scratch(stage(spark, kept, SF), f"test-{name}")
        if name != "tokens":
            assert kept.columns == docs.columns
        if name == "language":
            gone = before.exceptAll(kept).collect()
            assert gone and all(not re.search(r"[^\W\d_]", r["text"] or "") for r in gone)
        elif name == "near_duplicates":
            rows = before.select("doc_id", "text").collect()
            groups = {}
            u = Union()
            fps = sorted({_fingerprint(r["text"]) for r in rows})
            for a in fps:
                for b in fps:
                    if a <= b and (a ^ b).bit_count() <= 2:
                        u.join(a, b)
            for r in rows:
                groups.setdefault(u.find(_fingerprint(r["text"])), []).append(r["doc_id"])
            want = Counter(min((i for i in ids if i is not None), default=None) for ids in groups.values())
            assert Counter(r["doc_id"] for r in kept.collect()) == want
        elif name == "personal_data":
            assert Counter(r["text"] for r in kept.collect()) == Counter(r["text"] for r in pii.pseudonymize(before).collect())
        elif name == "mixing":
            assert {(r["doc_id"], r["text"]) for r in kept.collect()} <= {(r["doc_id"], r["text"]) for r in before.collect()}
        else:
            n = before.count()
            assert kept.count() == n and kept.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]


def test_run_is_the_stages_in_order(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.scratch(stage(spark, docs, SF), f"test-{name}")
    assert Counter(map(str, out.collect())) == Counter(map(str, docs.collect()))


def test_pipeline_of_no_documents_and_clashing_names(spark, no_docs, edge_docs):
    """Empty tables and columns named like those the stages make pass through all stages."""
    for source in (no_docs, edge_docs):
        docs = source.withColumns({"fp": F.lit(1), "id": F.lit("x"), "text_": F.lit("y"), "lang_pred": F.lit("z"), "score": F.lit(0.5),
                                   "copies": F.lit(7), "n": F.lit(1), "root": F.lit(2), "th": F.lit(3), "kind": F.lit("k")})
        kept = docs
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = corpus_pipeline.scratch(stage(spark, kept, SF), "test-clash")
            assert kept.columns == docs.columns
        last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
        assert last.columns == ["doc_id", "source", "n_tokens", "ids", "decoded_sha256"]
        assert (last.count() == 0) == (source is no_docs)


def test_last_pipeline_stages_against_plain_code(spark, edge_docs):
    """Pseudonyms, mixing and tokens of the pipeline against what plain code makes of the rows before."""
    import hashlib

    import public_tokenizers
    import tiktoken

    from medallion.llm import bpe, mixing
    names = spark.read.parquet(f"{SF}/documents.parquet").columns
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(edge_docs.select(*names))
    kept = corpus_pipeline.scratch(corpus_pipeline.personal_data(spark, docs, SF), "test-plain")
    # pseudonyms: rows and columns stay, and a text changes exactly where a valid value stands
    assert kept.columns == docs.columns and kept.count() == docs.count()
    plain = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}(?![A-Za-z0-9])")
    before = {r.doc_id: r.text for r in docs.where("doc_id is not null").collect()}
    assert sum(len(plain.findall(t or "")) for t in before.values()) > 3
    for r in kept.where("doc_id is not null").collect():
        for old, new in zip(plain.findall(before[r.doc_id] or ""), plain.findall(r.text or "")):
            assert len(old) == len(new) and old != new and old.rsplit(".")[-1] == new.rsplit(".")[-1]
    # mixing: each row as often as the mix says
    mixed = corpus_pipeline.scratch(corpus_pipeline.mix_sources(spark, kept, SF), "test-plain")
    want = Counter()
    for r in mixing.mix(kept).collect():
        want[(r["id"], r["source"])] += r["copies"]
    assert Counter((r.doc_id, r.source) for r in mixed.collect()) == +want
    # tokens: the library's ids of exactly these rows, and the text's own digest
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.load_ranks(public_tokenizers.path(corpus_pipeline.VOCABULARY)))
    got = Counter((r.doc_id, r.source, tuple(r.ids), r.decoded_sha256) for r in corpus_pipeline.tokens(spark, mixed, SF).collect())
    assert got == Counter((r.doc_id, r.source, tuple(library.encode_ordinary(r.text or "")),
                           hashlib.sha256((r.text or "").encode()).hexdigest()) for r in mixed.collect())
