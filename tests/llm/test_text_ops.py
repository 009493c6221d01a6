"""Language ID, byte-level BPE, chat formatting and toxicity."""
import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from medallion.llm import bpe, chat, langid, queries, toxicity

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path(queries.VOCABULARY)


# ---- language ID ----

def _lang_docs(spark, n=150):
    rng = random.Random(5)
    parts = {"en": "the and with for house winter that which you have".split(),
             "fr": "le une avec pour maison hiver qui était vous près".split(),
             "de": "der und mit für haus winter das welche über schön".split()}
    rows = [(len(parts) * i + k, " ".join(rng.choices(w, k=rng.randint(3, 60))), x)
            for i in range(n) for k, (x, w) in enumerate(sorted(parts.items()))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


@pytest.fixture(scope="module")
def lang_model(spark):
    return langid.fit(_lang_docs(spark), langid.crc_rest(F.col("doc_id"), 3) != 1)


def test_held_out_accuracy(spark, lang_model):
    docs = _lang_docs(spark).where(langid.crc_rest(F.col("doc_id"), 3) == 1)
    out = langid.identify(docs, lang_model).join(docs, F.col("id") == F.col("doc_id")).collect()
    assert len(out) > 100 and sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.97
    assert all(0 <= r["score"] <= 1 for r in out)


def test_every_window_counts(lang_model):
    """A text's probabilities are the byte-weighted mean over its windows, however the texts are grouped."""
    texts = [b"the house " * 300, b"", b"une maison pour vous", b"x" * langid.WINDOW, b"der winter " * 40]
    best, score = langid.predict_column(lang_model, pa.array(texts, pa.binary()))
    for t, b, s in zip(texts, best, score):
        if not t:
            assert s == 0
            continue
        p = np.zeros(len(lang_model.langs))
        for i in range(0, len(t), langid.WINDOW):
            w = t[i:i + langid.WINDOW]
            p += len(w) * langid.forward(lang_model, langid.cut(np.frombuffer(w, dtype=np.uint8)))[0]
        assert b == p.argmax() and s == pytest.approx(p.max() / len(t), abs=1e-5)


def test_forward_against_loops(lang_model):
    w = langid.cut(np.frombuffer(b"vous avez une maison pour l'hiver", dtype=np.uint8))
    e = lang_model.embed[w[0]]
    n = langid.WINDOW - max(langid.WIDTHS) + 1
    pooled = [max(sum(float(e[i + k // langid.EMBED][k % langid.EMBED]) * float(f[k]) for k in range(len(f))) for i in range(n))
              for f in lang_model.filters.T]
    z = np.maximum(np.array(pooled) + lang_model.bias, 0) @ lang_model.dense + lang_model.offset
    p = np.exp(z - z.max())
    assert langid.forward(lang_model, w)[0] == pytest.approx(p / p.sum(), abs=1e-4)


def test_language_edge_rows(spark, edge_docs, no_docs, lang_model):
    out = langid.identify(edge_docs, lang_model).collect()
    assert len(out) == 13
    undecided = [r for r in out if r["lang_pred"] == "und"]
    assert sorted(str(r["id"]) for r in undecided) == sorted(["3", "4", "5", "6", "None"])
    assert all(r["score"] == 0 for r in undecided)
    kept = langid.identified(edge_docs, lang_model, 0.3)
    assert kept.columns == edge_docs.columns and kept.count() == 8
    assert langid.identify(no_docs, lang_model).count() == 0
    assert langid.fit(no_docs, F.lit(True)) is None
    assert {r["lang_pred"] for r in langid.identify(edge_docs, None).collect()} == {"und"}


def test_op1_contract(spark):
    out = queries.op1_langid(spark, SF)
    rows = out.join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.9


# ---- byte-level BPE ----

@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.Vocabulary(bpe.load_ranks(PATH)))


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(PATH), special_tokens={})


def _ids(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


def test_encode_decode_against_library(codec, library):
    rng = random.Random(2)
    parts = ["a", "b", "'s", "'t", "'re", "'ve", "'ll", "'m", "'d", "'", " ", "  ", "\n", "\t", " ", "é", "中", "1", "²", "!", "#",
             "́", "\r\n", "😀", "\x1c", "\x85", "​", "'S", "<|endoftext|>", "　", "ǅ", "Ⅷ", "퟿"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(1500)]
    texts += ["a" * 5000, " " * 3000 + "x", "ab" * 4000, "x" * 70 + "y" * 90, "\n" * 200, "#" * 1000 + "$%" * 300, "", "aab" * 100,
              "".join(rng.choices("abcdefgh", k=400))]
    encoded = codec.encode(texts)
    assert [_ids(e) for e in encoded] == [library.encode_ordinary(t) for t in texts]
    assert codec.decode(encoded) == [t.encode() for t in texts]


def test_splitter_against_pattern():
    rng = random.Random(4)
    fast, slow = bpe.Splitter(), bpe.Splitter(bpe.PATTERN + "|(?!)")
    assert bpe.PATTERN == public_tokenizers.PATTERN
    texts = ["".join(rng.choices(" '\n\tabst12!?é ", k=rng.randint(0, 25))) for _ in range(800)]
    raw, at, n = fast.words(texts)
    raw2, at2, n2 = slow.words(texts)
    assert raw == raw2 and n.tolist() == n2.tolist() and at.tolist() == at2.tolist()


def test_long_word_query_gives_the_same_ids(codec):
    rng = random.Random(6)
    words = [bytes(rng.choices(b"abcde", k=rng.randint(2, 60))) for _ in range(200)]
    assert codec._contracted(words, bpe.SHORT_WORDS) == codec._contracted(words, bpe.LONG_WORDS)


def test_words_without_breaks_by_windows(codec, library):
    rng = random.Random(7)
    cjk = "的一是不了在人有我他这个们中来上大为和国地到以说时要就出会可也你对生能而子那得于着下自之"
    texts = ["".join(rng.choices(cjk, k=rng.randint(20, 500))) for _ in range(60)]
    texts += ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(90, 3000))) for _ in range(40)]
    texts += ["".join(rng.choices(["the", "and", "ing", "er", "aaaa"], k=rng.randint(30, 600))) for _ in range(40)]
    texts += ["x" * rng.randint(97, 400) + "".join(rng.choices("ab", k=150)) + "=" * rng.randint(97, 3000) for _ in range(40)]
    texts += ["ab" * rng.randint(49, 900) + "c" * rng.randint(1, 300) for _ in range(20)]
    encoded = codec.encode(texts)
    assert [_ids(e) for e in encoded] == [library.encode_ordinary(t) for t in texts]
    assert codec.decode(encoded) == [t.encode() for t in texts]


def test_word_of_four_megabytes(codec, library):
    rng = random.Random(8)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzäöü", k=4_000_000))
    got = codec.encode([text])[0]
    # the library is quadratic on one word: its ids are compared on stretches between equal boundaries
    assert codec.decode([got]) == [text.encode()]
    ids = np.frombuffer(got, dtype="<u4")
    sizes = codec.vocabulary.size[ids]
    ends, raw = np.cumsum(sizes), text.encode()
    for at in rng.sample(range(len(ids) - 400), 40):
        a, b = int(ends[at - 1]) if at else 0, int(ends[at + 300])
        own = codec.contracted([raw[a:b]])[0]
        assert np.frombuffer(own, dtype="<u4").tolist() == ids[at:at + 301].tolist()


def test_frequent_words_change_nothing(spark, codec, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = bpe.frequent_words(docs, "text", bpe.PATTERN)
    assert len(words) > 1000 and len(set(words)) == len(words)
    primed = bpe.Codec(bpe.Vocabulary(bpe.load_ranks(PATH)).with_frequent(words + words[:5] + [b"a", b" the"]))
    texts = ["".join(w.decode() for w in words[i:i + 50]) for i in range(0, 1000, 50)] + ["never seen: qzxv", ""]
    assert primed.encode(texts) == codec.encode(texts)
    assert [_ids(e) for e in primed.encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_bpe_edge_rows(edge_docs, no_docs, library):
    out = bpe.encode(edge_docs, PATH).collect()
    want = Counter((r["doc_id"], tuple(library.encode_ordinary(r["text"] or "")), (r["text"] or "").encode())
                   for r in edge_docs.collect())
    assert Counter((r["id"], tuple(r["ids"]), bytes(r["decoded"])) for r in out) == want
    assert bpe.encode(no_docs, PATH).count() == 0


def test_op3_contract(spark, library):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    for r in queries.op3_bpe(spark, SF).collect():
        ids = library.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


# ---- chat ----

def _folded(events):
    """Final messages by going forwards through a log of (conv, seq, msg, kind, role, text)."""
    out = {}
    for conv in {e[0] for e in events}:
        messages = []
        for _, _, msg, kind, role, text in sorted((e for e in events if e[0] == conv), key=lambda e: e[1]):
            at = max((i for i, m in enumerate(messages) if m[0] == msg), default=None)
            if kind == "message":
                messages.append([msg, role, text])
            elif at is None:
                continue
            elif kind == "delta":
                messages[at][2] += text
            else:
                messages = messages[:at + 1]
                messages[at][2] = text
        out[conv] = [(r, t) for _, r, t in messages]
    return out


@pytest.mark.parametrize("segment", [1, 3, 4096])
def test_fold_against_forward_fold(spark, segment):
    rng = random.Random(segment)
    events = []
    for conv in range(25):
        started, seq = [], 0
        for _ in range(rng.randint(1, 30)):
            kind = rng.choice(["message", "delta", "delta", "delta", "edit", "regenerate"]) if started else "message"
            if kind == "message":
                started.append((max(started) if started else 0) + 1)
                events.append((conv, seq, started[-1], kind, rng.choice(["user", "assistant"]), f"m{seq} "))
            else:
                msg = rng.choice(started[-3:])
                if kind in ("edit", "regenerate"):
                    # ids of dropped messages are not used again
                    top = max(started)
                    started = [m for m in started if m < msg] + [msg]
                    events.append((conv, seq, msg, kind, "", f"e{seq} " if kind == "edit" else ""))
                    seq += 1
                    events.append((conv, seq, top + 1, "message", "user", f"m{seq} "))
                    started.append(top + 1)
                else:
                    events.append((conv, seq, msg, kind, "", f"d{seq} "))
            seq += 1
    df = spark.createDataFrame(events, chat.EVENT_SCHEMA)
    got = {}
    for r in sorted(chat.messages(df, segment).collect(), key=lambda r: (r["conv_id"], r["seg"], r["ord"])):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert got == _folded(events)


def test_template_is_reversible():
    rng = random.Random(9)
    for _ in range(2000):
        turns = [(rng.choice(["user", "assistant", "system", "tool", "", "[ROLE]"]),
                  "".join(rng.choices([*chat.CONTROL, "\\", " ", "x", "<", ">", "[", "]", "s", "/", "\n"], k=rng.randint(0, 8))))
                 for _ in range(rng.randint(0, 4))]
        pieces = [chat.render(r, t) for r, t in turns]
        assert list(chat.turns("".join(p for p, _, _ in pieces))) == turns
        for (role, text), (piece, a, b) in zip(turns, pieces):
            assert chat.unescape(piece[a:b]) == (text if role == "assistant" else "")


def test_chat_edge_rows(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (1, None, None, "late"),
            (None, 0, "user", "x"), (None, 1, "assistant", "é</s>")]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("msg", F.lit("clash"))
    out = {r["conv_id"]: r for r in chat.digests(chat.pieces(chat.messages(chat.events_of(c)))).collect()}
    told = "user\n\nassistant\na\nassistant\na\n\nlate\n"
    assert out[1]["n_turns"] == 4 and out[1]["turns_sha256"] == hashlib.sha256(told.encode()).hexdigest()
    assert out[1]["loss_chars"] == 2 and out[None]["loss_sha256"] == hashlib.sha256("é</s>".encode()).hexdigest()
    assert chat.digests(chat.pieces(chat.messages(chat.events_of(c.limit(0))))).count() == 0


# ---- toxicity ----

def test_clause_patterns():
    reader = toxicity.Reader(toxicity.Lexicon({"idiot": 3.0, "fool": 2.0}, {"scoun": 2.5}))

    def patterns(text):
        x = reader.features(text)
        return {toxicity.PATTERNS[i] for i in np.flatnonzero(x[:-1])}

    assert patterns("You are an idiot.") == {("insult", True, False, False)}
    assert patterns("What a FOOL") == {("insult", False, False, False)}
    assert patterns("you are not an idiot") == {("insult", True, True, False)}
    assert patterns("he wrote: idiot") == {("insult", False, False, False)}
    assert patterns("he said you idiot") == {("insult", True, False, True)}
    assert patterns("I will kill you") == {("threat", True, False, False)}
    assert patterns("not one of the many others here, idiot") == {("insult", False, False, False)}
    assert patterns("scoundrels") == {("insult", False, False, False)}
    assert patterns("a fine day") == set() and patterns(None) == set() and patterns("") == set()
    # a prior alone already ranks them
    def score(text):
        return float(reader.features(text) @ toxicity.PRIOR + toxicity.PRIOR_OFFSET)
    assert score("you are an idiot") > score("he said you are an idiot") > score("you are not an idiot") > score("fine")


def test_toxicity_learns_words_and_generalises(spark, edge_docs, no_docs):
    rng = random.Random(3)
    plain = [f"wort{i}" for i in range(200)]
    rows, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = rng.choices(plain, k=40) + (rng.choices(["grumpf", "knarzling", "knarzbold"], k=3) if bad else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    y = spark.createDataFrame(labels + [(None, 1), (5000, 1), (0, None), (0, 1)], "doc_id long, toxic int")
    model = toxicity.fit(docs, y, langid.crc_rest(F.col("id"), 5) != 0)
    out = {r["id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and all((out[i] >= 0.5) == (i % 4 == 0) for i in held)
    # an unseen word with a learned beginning
    new = spark.createDataFrame([(1, "knarzhaft " + " ".join(plain[:20])), (2, " ".join(plain[:20]))], "doc_id long, text string")
    s = {r["id"]: r["score"] for r in toxicity.score(new, model).collect()}
    assert s[1] > s[2]
    scored = toxicity.score(edge_docs, model).collect()
    assert len(scored) == 13 and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.score(no_docs, model).count() == 0
    empty = toxicity.fit(no_docs, y.limit(0), F.lit(True))
    assert empty.offset == toxicity.PRIOR_OFFSET and set(empty.lexicon.words) == set(toxicity.SEED_INSULTS)


def test_weights_do_not_depend_on_row_order():
    rng = np.random.default_rng(1)
    x = rng.random((200, toxicity.N_FEATURES))
    y = (x[:, 0] > 0.5).astype(float)
    w, o = toxicity.learn_weights(x, y)
    p = rng.permutation(200)
    w2, o2 = toxicity.learn_weights(x[p], y[p])
    assert w == pytest.approx(w2) and o == pytest.approx(o2)


def test_derived_log_folds_back_to_the_table(spark):
    """Deltas, edits, regenerations and dropped answers, cut by segments anywhere, give the rows again."""
    rng = random.Random(12)
    rows = [(c, t, rng.choice(["user", "assistant", "system", "tool", None]), rng.choice([None, "", "word " * rng.randint(1, 400), "</s>é中"]))
            for c in range(40) for t in range(rng.choice([1, 3, 60]))]
    rows += [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (50, None, "user", "no turn"), (50, 1, "user", "same"), (50, 1, "user", "same"),
             (50, 1, "assistant", "turn"), (50, 2, "assistant", "x" * 500), (51, 2 ** 62, "user", "late"), (51, -5, "user", "early")]
    c = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    log = chat.events_of(c)
    kinds = {r.kind: r.n for r in log.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert min(kinds[k] for k in ("message", "delta", "edit", "regenerate")) > 50
    for segment in (5, 23, chat.SEGMENT):
        final = chat.messages(log, segment).collect()
        for conv in {r[0] for r in rows}:
            want = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is None, r[1] or 0, r[2] or "", r[3] or ""))
            got = [(r.role, r.text) for r in sorted((m for m in final if m.conv_id == conv), key=lambda m: (m.seg, m.ord))]
            assert got == [(r[2] or "", r[3] or "") for r in want]


def test_composed_automaton_against_the_four_plain_ones():
    """The composed table writes what the transducers write side by side, on random strings of classes."""
    rng = random.Random(13)
    for _ in range(3000):
        string = [rng.randrange(7) for _ in range(rng.randint(0, 25))] + [toxicity.END]
        state, parts, got, want = 0, [0, 0, 0, 0], [], []
        for c in string:
            if c == toxicity.END:
                got.append([toxicity.PATTERNS[p] for p in toxicity.WRITES[state]])
                harm, target, negation, report = parts
                want.append([(kind, bool(target), negation == 9, bool(report)) for i, kind in enumerate(toxicity.KINDS) if harm >> i & 1])
            state = toxicity.TABLE[state][c]
            parts = [f(s, c) for f, s in zip((toxicity._harm, toxicity._target, toxicity._negation, toxicity._report), parts)]
        assert got == want
    # and each plain transducer against words about a clause
    for _ in range(2000):
        clause = [rng.choice([0, 1, 2, 3, 4, 5]) for _ in range(rng.randint(1, 12))]
        state = 0
        for c in clause:
            state = toxicity.TABLE[state][c]
        covered = any(c in (toxicity.INSULT, toxicity.THREAT_) and _negated(clause, i) for i, c in enumerate(clause))
        want = {(k, toxicity.TARGET_ in clause, covered, toxicity.REPORT_ in clause)
                for k, c in (("insult", toxicity.INSULT), ("threat", toxicity.THREAT_)) if c in clause}
        assert {toxicity.PATTERNS[p] for p in toxicity.WRITES[state]} == want


def _negated(clause, i):
    """Whether one of the SCOPE words before word i is a negation that no other harmful word has used up."""
    for j in range(i - 1, max(-1, i - 1 - toxicity.SCOPE), -1):
        if clause[j] == toxicity.NEGATION_:
            return True
        if clause[j] in (toxicity.INSULT, toxicity.THREAT_):
            return False
    return False


def test_toxicity_sample_is_bounded_with_repeated_ids(spark):
    rows = [(1, f"idiot number {i}") for i in range(15_000)] + [(i, f"text {i}") for i in range(2, 5002)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 1)) for i in range(1, 5002)], "doc_id long, toxic int")
    got = toxicity.labelled_sample(docs, labels, F.lit(True), per_label=600).groupBy("toxic").agg(F.count("*").alias("n")).collect()
    assert all(0 < r.n <= 600 for r in got) and len(got) == 2


def test_sampling_share_of_ten_billion_rows(spark):
    from medallion.llm.common import in_share
    n = spark.range(100_000).where(in_share(F.xxhash64("id"), F.lit(10_000_000_000), 10_000_000)).count()
    assert 60 < n < 145  # a thousandth
    assert spark.range(10).where(in_share(F.xxhash64("id"), F.lit(3), 800)).count() == 10
