"""Every operator against brute force, an exact round trip or held-out accuracy, and on odd rows."""

import hashlib
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from brute import base_scores, exact_items, linked, without_repeats, words
from cases import ODD, SF_SMALL, engine, odd, small  # noqa: F401 (fixtures)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import dayload.llm.ngram_join as J
from dayload.llm import bpe_lexicon, decontaminate, license_scan, lm_score, multi_index, toxicity, unit_cache, url_filter
from dayload.llm.bpe_lexicon import build_lexicon, compile_lexicon, decode_documents, encode_digests, encode_documents, frequent_pieces, Lexicon
from dayload.llm.components import components
from dayload.llm.multi_index import _walk, nearest
from dayload.llm.ngram_join import PrefixTree, linked_documents
from dayload.llm.substring_dedup import dedup_texts, kept_digests
from dayload.llm.token_files import open_part, read_documents, write_tokens
from dayload.session import scratch_dir

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- 1 ---------------------------------------------------------------------------
def family(seed=1, n=70):
    rng = np.random.default_rng(seed)
    base, out = [f"w{i}" for i in range(60)], []
    for i in range(20, 20 + n):
        w = list(base)
        for _ in range(rng.integers(0, 3)):
            w[rng.integers(60)] = f"z{rng.integers(5)}"
        out.append((i, " ".join(w[:rng.integers(50, 61)] if rng.random() < .3 else w)))
    return out


@pytest.mark.parametrize("block", [1000, 7])
def test_ngram_join_is_brute_force(engine, odd, monkeypatch, block):
    monkeypatch.setattr(J.tree_candidates, "__defaults__", (block,))
    rows = family() + ODD
    df = engine.createDataFrame(rows, "doc_id long, text string")
    assert bag(linked_documents(df)) == linked(rows)
    assert bag(linked_documents(odd)) == linked(ODD)


def test_ngram_join_on_documents(engine, small):
    df = engine.createDataFrame(small, "doc_id long, text string")
    assert bag(linked_documents(df)) == linked(small)
    assert linked_documents(df.where("false")).count() == 0


def test_prefix_tree_loses_no_pair():
    rng = np.random.default_rng(4)
    sets = []
    for i in range(120):
        s = sorted(set(rng.choice(40, size=rng.integers(12, 26)).tolist()) | {0})
        sets.append(s)
    tree, found = PrefixTree(), set()
    for i, s in enumerate(sets):  # all share member 0, which is first
        p = J.prefix_length(len(s), 85, 100)
        entry = (i, len(s), i, 0, s[1:p])
        found |= {(o[0], i) for o in tree.probe(entry, 85, 100)}
        tree.add(entry)
    for i in range(len(sets)):
        for j in range(i):
            a, b = set(sets[i]), set(sets[j])
            if 100 * len(a & b) >= 85 * len(a | b):
                assert (j, i) in found


def test_prefixes_keep_six_bytes_of_a_member(spark):
    rows = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(400)))], "doc_id long, text string")
    r = J.set_prefixes(rows, 4, 85, 100).first()
    members = J.prefix_length(397, 85, 100)
    assert (len(r["high"]), len(r["low"])) == (3 * members, 3 * members)
    keys = np.sort(np.random.default_rng(5).integers(1 << 64, size=500, dtype=np.uint64))
    high, low = J.halves(keys)
    assert np.array_equal(J._whole(high).astype(np.uint64) << np.uint64(24) | J._whole(low), keys >> np.uint64(16))


def test_members_that_become_equal_lose_no_pair():
    """Tails whose members share their upper bytes: at least as many are shared as before."""
    rng = np.random.default_rng(6)
    for few in (1, 3, 40):
        sets = [np.sort(rng.choice(np.arange(few * 8, dtype=np.uint64), min(few * 8, 12), replace=False)) for _ in range(6)]
        keys = [(s // np.uint64(8)) << np.uint64(40) | (s % np.uint64(8)) for s in sets]
        first = np.cumsum([0, *map(len, keys)])
        codes = J.tail_codes(np.frombuffer(b"".join(J.halves(k)[0] for k in keys), np.uint8), first)
        tails = [codes[a:b].tolist() for a, b in zip(first, first[1:])]
        for x, kx in zip(tails, keys):
            assert x == sorted(x) and len(set(x)) == len(x)
            for y, ky in zip(tails, keys):
                assert len(set(x) & set(y)) >= len(np.intersect1d(kx, ky))
    many = np.zeros(300 * 3, np.uint8)
    assert len(set(J.tail_codes(many, np.array([0, 300])).tolist())) == 300
    # two sets of five members, four of them shared, whose tails are of one value
    group = [(i, 5, i, 0, J.tail_codes(np.zeros(9, np.uint8), np.array([0, 3])).tolist()) for i in (1, 2)]
    assert list(J.tree_pairs(group, [0, 0], 60, 100)) == [(1, 2)]


def test_components(engine):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 50), (50, 70), (7, 7)]
    got = dict(tuple(r) for r in components(engine.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 1 for i in range(1, 41)}, 100: 50, 50: 50, 70: 50}


# ---- 2 ---------------------------------------------------------------------------
def test_lm_score(engine, small, odd):
    df = engine.createDataFrame(small, "doc_id long, text string")
    got = {r["doc_id"]: r for r in lm_score.scored(df).collect()}
    for i, held, n, known, total, base in base_scores(small):
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
    rows = lm_score.scored(odd).collect()
    want = base_scores(ODD)
    assert sorted((r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in rows) == sorted((w[2], w[3], round(w[5], 6)) for w in want)
    assert lm_score.scored(odd.where("false")).count() == 0


def lm_stream(v, n=5000, seed=0):
    ids = np.random.default_rng(seed).integers(0, v.size, n)
    ids[ids == lm_score.BEGIN] = lm_score.END
    return ids, np.r_[2, ids[:-1]], np.r_[2, 2, ids[:-2]]


def test_lm_normalised(monkeypatch):
    """Over two classes; BEGIN is never a next token."""
    monkeypatch.setattr(lm_score, "CLASS", 4)
    v = lm_score.Vocabulary(np.array([11, 22, 33, 44], np.uint64), np.array([50, 30, 20, 5]), 150, 10)
    assert (v.size, v.classes) == (7, 2)
    m = lm_score.Model(v, 6)
    ids, one, two = lm_stream(v)
    p = np.exp(m.log_probabilities(np.arange(7), one[:7], two[:7]))
    assert np.allclose(p, m.p, atol=1e-6)  # before the fit: the smoothed counts
    m.fit(iter([(None, ids, None, one, two)]))
    total = 0
    for t in range(7):
        p = np.exp(m.log_probabilities(np.full(50, t), one[:50], two[:50]))
        total = total + p
        assert (p < 1e-9).all() if t == lm_score.BEGIN else (p > 0).all()
    assert np.allclose(total, 1, atol=1e-5)


def test_lm_learns_the_context(monkeypatch):
    """A word that always follows another comes out likely after it, within and across classes."""
    monkeypatch.setattr(lm_score, "CLASS", 4)
    v = lm_score.Vocabulary(np.arange(10, 19, dtype=np.uint64), np.full(9, 100), 900, 10)
    rng = np.random.default_rng(3)
    ids = np.array([t for _ in range(4000) for t in (rng.integers(3, 8), 11)])
    ids[1::2] = np.where(ids[::2] == 3, 11, 9)
    m = lm_score.Model(v, 8)
    m.fit((None, ids, None, np.r_[2, ids[:-1]], np.r_[2, 2, ids[:-2]]) for _ in range(40))
    after = np.exp(m.log_probabilities(np.array([11, 9, 11, 9]), np.array([3, 3, 5, 5]), np.array([9, 9, 9, 9])))
    assert after[0] > .5 > after[1] and after[3] > .5 > after[2]


def test_lm_score_is_the_model_s_sum_whatever_the_tasks(engine, small, monkeypatch):
    """score against a sum over tokens by the softmax of the trained parts; 1, 5 and 16 tasks, several shards, give the same."""
    rows = small[:120]
    kept, train = {}, lm_score.train
    monkeypatch.setattr(lm_score, "train", lambda *a: kept.setdefault("m", train(*a)) if "m" not in kept else train(*a))
    runs = []
    for tasks in (1, 5, 16):
        df = engine.createDataFrame(rows, "doc_id long, text string").repartition(tasks, "text")
        runs.append({r["doc_id"]: r["score"] for r in lm_score.scored(df, shard_tokens=4000).collect()})
    for other in runs[1:]:
        assert all(other[i] == pytest.approx(s, rel=1e-5) for i, s in runs[0].items())
    m, counts, texts = kept["m"], {}, 0
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 10:
            texts += 1
            for w in words(t, lower=True):
                counts[w] = counts.get(w, 0) + 1
    size = len(m.parts[0])
    own = sorted(c for c in counts.values() if c >= lm_score.LEAST)
    assert len(own) == size - 3
    named = {w for w, c in counts.items() if c >= lm_score.LEAST}
    p = m.p * (sum(counts.values()) + texts + lm_score.SMOOTH * (size - 1))  # counts by id again, smoothed
    place = {}
    for w in named:  # ids of words whose count no other word has
        at = np.flatnonzero(np.abs(p - counts[w] - lm_score.SMOOTH) < 1e-3)
        if len(at[at > 2]) == 1:
            place[w] = int(at[at > 2][0])
    rest = sum(c for w, c in counts.items() if w not in named)
    others = rest + lm_score.SMOOTH * (len(counts) - len(named) + 1)
    checked = 0
    for i, t in rows:
        held = words(t, lower=True)
        if any(w in named and w not in place for w in held):
            continue
        checked += 1
        total, one, two = 0.0, lm_score.BEGIN, lm_score.BEGIN
        for w in [*held, None]:
            k = lm_score.END if w is None else place.get(w, lm_score.OTHER)
            q = np.r_[m.parts[0][one] + m.parts[1][two], 1].astype(float)
            c, a = m.parts[3].astype(float) @ q, k // lm_score.CLASS
            x = m.parts[2][a * lm_score.CLASS:(a + 1) * lm_score.CLASS].astype(float) @ q
            logp = c[a] - np.log(np.exp(c).sum()) + x[k - a * lm_score.CLASS] - np.log(np.exp(x).sum())
            total += logp / np.log(10)
            if k == lm_score.OTHER:
                total += np.log10((counts.get(w, 0) + lm_score.SMOOTH) / others)
            one, two = k, one
        assert runs[0][i] == pytest.approx(total, rel=1e-4)
    assert checked


def test_lm_most_frequent(engine, monkeypatch):
    """All words above a count threshold, never more than asked for."""
    rows = [(i, " ".join(f"w{j}" for j in range(i % 40 + 1))) for i in range(400)]
    df = engine.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", F.lit(False))
    counts = lm_score.word_counts(df)
    for n in (0, 1, 7, 40, 100):
        h, c = lm_score.most_frequent(counts, n)
        assert len(h) == min(n, 40) and (np.diff(c) <= 0).all()


# ---- 3 ---------------------------------------------------------------------------
def test_token_files(engine, small, odd):
    tok = Tokenizer.from_file(WORD)
    for rows, df in ((small[:80], engine.createDataFrame(small[:80], "doc_id long, text string")), (ODD, odd)):
        folder = scratch_dir(engine, "tokens")
        manifest = write_tokens(df, folder, WORD, vocabulary=49_408, end_id=1)
        want, start = [], 0
        for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
            ids = tok.encode(t or "", add_special_tokens=False).ids + [1]
            want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        assert bag(read_documents(manifest)) == sorted(want, key=str)
        part = manifest.orderBy("base").first()
        doc_ids, offsets, ids = open_part(part["path"])
        assert len(offsets) == part["n_docs"] + 1 and offsets[-1] == len(ids) == part["n_ids"] and ids.dtype.itemsize == 2
    assert read_documents(write_tokens(odd.where("false"), scratch_dir(engine, "tokens"), WORD, 49_408)).count() == 0


# ---- 4 ---------------------------------------------------------------------------
def neighbours(rows, k=20, every=20):
    ok = {}
    for i, v in rows:
        if i is None or v is None or None in v or not np.isfinite(v).all() or not np.any(v):
            continue
        ok[i] = min(ok.get(i, v), v)
    ids = np.array(sorted(ok))
    x = np.array([np.array(ok[i], np.float32).astype(float) for i in ids])
    out = []
    for n, i in enumerate(ids):
        if i % every == 0:
            s = (x * x[n]).sum(1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out += [(int(i), r + 1, int(ids[j]), float(s[j])) for r, j in enumerate(order)]
    return sorted(out, key=str)


def test_nearest_on_odd_vectors(engine):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [0.0, 0.0]), (60, None), (80, [1.0, None]), (100, [float("nan"), 1.0]), (None, [1.0, 1.0]),
            (7, [1.0, 0.0]), (3, [0.5, 0.5]), (140, [float("inf"), 0.0])] + [(200 + i, [2.0, 1.0]) for i in range(50)]
    df = engine.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({"cell": F.lit(1), "unit": F.lit("u")})
    assert bag(nearest(df)) == neighbours(rows)
    assert nearest(df.where("false")).count() == 0


def test_nearest_recall(engine):
    df = engine.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    want = {(q, v) for q, _, v, _ in neighbours([tuple(r) for r in df.select("vec_id", "embedding").collect()])}
    got = {(r["query_id"], r["vec_id"]) for r in nearest(df).collect()}
    assert len(got & want) >= 0.9 * len(want)


def test_nearest_of_one_component(engine):
    rows = [(20 * i, [x]) for i, x in enumerate((1.0, -2.0, 0.5, 3.0, 0.5))] + [(7, [2.5]), (9, [0.0]), (11, [float("nan")]), (13, None)]
    df = engine.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert bag(nearest(df)) == neighbours(rows)


def test_nearest_does_not_follow_the_batches(engine, monkeypatch):
    """Units whose vectors and queries come in many batches; a sample cut by hash before it is ordered."""
    monkeypatch.setattr(multi_index, "UNIT", 60)
    monkeypatch.setattr(multi_index, "SAMPLE", 90)
    df = engine.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    n = df.count()
    points = df.select(F.xxhash64("embedding").alias("h"))
    first = lambda d: [r["h"] for r in d.orderBy(F.xxhash64("h"), "h").limit(60).collect()]
    assert multi_index.by_hash(points, n).count() < n and first(multi_index.by_hash(points, n)) == first(points)
    want = bag(nearest(df, every=3))
    setting, old = "spark.sql.execution.arrow.maxRecordsPerBatch", engine.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    engine.conf.set(setting, "7")
    try:
        assert bag(nearest(df, every=3)) == want
    finally:
        engine.conf.set(setting, old)


def test_walk_is_by_falling_sums():
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=7), rng.normal(size=7)
    counts = rng.integers(0, 3, 49)
    order = [int(c) for c in np.argsort(-(a[:, None] + b[None, :]).ravel(), kind="stable") if counts[c]]
    assert _walk(a, b, counts, 10**9) == order
    some = _walk(a, b, counts, 9)
    assert some == order[:len(some)] and counts[some].sum() >= 9 > counts[some[:-1]].sum()


# ---- 5 ---------------------------------------------------------------------------
def test_decontaminate(engine, small, odd):
    docs = engine.createDataFrame(small, "doc_id long, text string")
    bench = engine.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()}
    assert got == exact_items(small, items)
    i, t = max(items, key=lambda x: len(x[1]))
    w = t.split()
    para = " ".join(x if n % 9 else "changed" for n, x in enumerate(w))
    planted = engine.createDataFrame([(1, "so it goes " + para + " and more"), (2, small[0][1]), (None, t), (3, None), (4, ""), (1, para.upper())], "doc_id long, text string")
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs.withColumn("doc_id", F.col("doc_id") + 100).union(planted), bench).collect()]
    assert sorted(found, key=str).count((1, i)) == 2 and (None, i) in found
    clean = decontaminate.clean_rows(planted.withColumn("c0", F.lit(5)), bench)
    assert clean.columns == ["doc_id", "text", "c0"] and None not in {r["doc_id"] for r in clean.collect()}
    assert decontaminate.contaminated(odd, bench).count() == 0
    assert decontaminate.contaminated(odd.where("false"), bench).count() == 0
    assert decontaminate.contaminated(odd, bench.where("false")).count() == 0
    assert decontaminate.clean_rows(odd, bench.where("false")).count() == len(ODD)


@pytest.mark.parametrize("table", [True, False])
def test_decontaminate_finds_every_paraphrase(engine, monkeypatch, table):
    if not table:
        monkeypatch.setattr(decontaminate, "TABLE", 0)
        monkeypatch.setattr(decontaminate, "TOGETHER", 7)
    d, rng = "/root/testdata/sf0.01", np.random.default_rng(5)
    docs, bench = engine.read.parquet(f"{d}/documents.parquet").select("doc_id", "text"), engine.read.parquet(f"{d}/benchmark.parquet")
    items = [tuple(r) for r in bench.select("item_id", "text").orderBy("item_id").collect()]
    corpus = " ".join(r["text"] or "" for r in docs.orderBy("doc_id").limit(200).collect()).split()
    rows, planted = [], set()
    for i, t in items:
        w = t.split()
        tail = len(decontaminate.Items._answer(t).split())
        for kept in (.5, .6, .7, .8, .9):
            body = np.arange(len(w) - tail)
            gone = rng.permutation(body)[:min(len(body), int(len(w) * (1 - kept)))]
            new = [corpus[rng.integers(len(corpus))] if x in gone else w[x] for x in range(len(w))]
            doc = 10**6 + len(rows)
            rows.append((doc, " ".join([corpus[x] for x in rng.integers(len(corpus), size=50)] + new + [corpus[x] for x in rng.integers(len(corpus), size=50)])))
            planted.add((doc, i))
    got = decontaminate.contaminated(docs.union(engine.createDataFrame(rows, "doc_id long, text string")), bench).select("doc_id", "item_id").collect()
    got = {tuple(r) for r in got}
    assert planted <= got
    # a scan of all stretches by brute force: nothing else is missed either
    held = decontaminate.Items([i for i, _ in items], [t for _, t in items])
    check = decontaminate.Searcher(held, np.zeros((len(held.known), 2), np.float32), np.ones(len(held.known)))
    for doc, text in rows[::10]:
        h = held._hashes(text).tolist()
        for n, i in enumerate(held.ids):
            span = int(1.5 * len(held.words[n]))
            if any(check.verify(h[a:a + span], n) for a in range(max(1, len(h) - span + 1))):
                assert (doc, i) in got, (doc, i)


@pytest.mark.parametrize("table", [1 << 23, 0])
def test_places_without_enough_of_an_items_words_are_not_compared(monkeypatch, table):
    """A word counts as often as item and text both have it: a place that repeats one word is no candidate."""
    monkeypatch.setattr(decontaminate, "TABLE", table)
    rng = np.random.default_rng(8)
    items = decontaminate.Items([1, 2], ["a b c d e f g h i j k l m n o p", "a a a b b c d e f q r s t u v w x y"])
    search = decontaminate.Searcher(items, np.zeros((len(items.known), 2), np.float32), np.ones(len(items.known)))
    lists, none = [items.features(h) for h in items.words], search.features
    for _ in range(30):
        words = rng.integers(0, none + 1, (5, 24))
        words[0] = words[0, 0]
        for item, own in enumerate(lists):
            here = np.where(np.isin(words, own), words, none)
            want = [sum(min((r == x).sum(), (own == x).sum()) for x in np.unique(own)) for r in here]
            assert search._in_common(np.full(5, item), here).tolist() == want
    compared = []
    monkeypatch.setattr(decontaminate, "_bit_lcs", lambda a, b: compared.append((a, b)) or 0)
    for text in ("a z a b z a a z a a z a b a z a z a b a a z a a", "x y a a y x a a a a x x y y a a a x a a a a b"):
        held = decontaminate._slices(pa.record_batch([pa.array([text])], names=["text"]), "text")
        assert not [x for _, _, w in held for x in search.hits(w)]
    assert not compared


def test_row_sums():
    rng = np.random.default_rng(9)
    values, many = rng.normal(size=(50, 7)), rng.integers(1, 33, 200)
    cut, at = np.r_[0, np.cumsum(many)[:-1]], rng.integers(0, 50, many.sum())
    assert np.allclose(decontaminate._row_sums(values, at, cut, many), np.add.reduceat(values[at], cut, axis=0))


def test_bit_lcs():
    rng = np.random.default_rng(1)
    for _ in range(50):
        a, b = rng.integers(0, 5, rng.integers(1, 20)).tolist(), rng.integers(0, 5, rng.integers(0, 30)).tolist()
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for x in range(len(a)):
            for y in range(len(b)):
                t[x + 1][y + 1] = t[x][y] + 1 if a[x] == b[y] else max(t[x][y + 1], t[x + 1][y])
        assert decontaminate._bit_lcs(a, b) == t[-1][-1]


# ---- 6 ---------------------------------------------------------------------------
HARD = ["", None, "  ", "a  b\n\n c   d  e", "x<|endoftext|>y <|endoftext|> z", "don't I'LL we've  \t 12ab34  q", "日本語 テスト　 終", "\x1c a\x1f b\x85 c", "\u00a0a", "a\u00a0 \u2003",
        "e\u0301 n\u0303 x\u200by", "'s 's", " " * 9 + "q" + " " * 5, "\n\n\n", "a \n b", "²½ Ⅷ x٣", "<|endoftext|>", "THBLENT!! 3.14,x"]


def digests(tok, t):
    ids = tok.encode(t or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_is_the_library(engine, small, odd):
    tok = Tokenizer.from_file(BYTE)
    rows = small[:80] + [(1000 + i, t) for i, t in enumerate(HARD)] + ODD
    df = engine.createDataFrame(rows, "doc_id long, text string")
    want = sorted(((i, *digests(tok, t)) for i, t in rows), key=str)
    path = build_lexicon(df, f"{scratch_dir(engine, 'lexicon')}/words.lex", BYTE, words=500)
    assert bag(encode_digests(df, BYTE, path)) == want
    assert bag(encode_digests(df, BYTE)) == want
    hard = engine.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    back = dict(tuple(r) for r in decode_documents(encode_documents(hard, BYTE, path), BYTE).collect())
    assert back == {i: t or "" for i, t in enumerate(HARD)}
    assert encode_digests(odd.where("false"), BYTE, path).count() == 0


def test_a_worker_holds_little_for_a_unit():
    n = 60_000
    text = pa.array([" ".join(f"w{i}x" for i in range(a, a + 100)) for a in range(0, n, 100)])
    tracemalloc.start()
    try:
        enc = bpe_lexicon.Encoder(bpe_lexicon.Merges(BYTE), None)
        before = tracemalloc.get_traced_memory()[0]
        for _ in bpe_lexicon._encoded(text, enc):
            pass
        held = tracemalloc.get_traced_memory()[0] - before
    finally:
        tracemalloc.stop()
    assert held < 100 * n  # 249 bytes for each number when units were Python objects


def test_units_outlive_blocks_and_a_full_cache(monkeypatch):
    monkeypatch.setattr(unit_cache, "BLOCK_UNITS", 7)
    cache = unit_cache.UnitCache(lambda units: [list(u) for u in units], 50)
    rng = np.random.default_rng(4)
    for _ in range(200):
        units = [bytes(rng.integers(0, 4, rng.integers(0, 4)).astype(np.uint8)) for _ in range(rng.integers(0, 40))]
        data, size = np.frombuffer(b"".join(units), np.uint8), np.array([len(u) for u in units], np.int64)
        ids, sizes = cache.gather(cache.index(data, np.cumsum(size) - size, np.cumsum(size)))
        assert ids.tolist() == list(b"".join(units)) and sizes.tolist() == size.tolist()
        assert cache.units == len(cache.keys) == len(set(cache.keys.tolist())) <= 50


def test_long_rows_are_printed_in_parts(monkeypatch):
    monkeypatch.setattr(bpe_lexicon, "PRINTED_IDS", 3)
    out = bpe_lexicon.Printed([b"", b"a", b"bcd", b"ef"])
    ids, first = np.array([2, 0, 1, 3, 3, 0, 0, 0, 2, 1]), np.array([0, 0, 4, 4, 5, 8, 10, 10])
    assert list(out.rows(ids, first)) == [b"", b"bcdaef", b"", b"ef", b"", b"bcda", b""]
    assert list(out.rows(ids[:0], np.zeros(3, np.int64))) == [b"", b""]


def test_frequent_pieces_stay_under_the_bound(engine):
    texts = ["a " * 5000, "bb " * 4100, "cc " * 900, "dd " * 900, "ee " * 30, "once"]
    df = engine.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    all_ = frequent_pieces(df, BYTE, 100)
    assert len(all_) == len(set(all_)) > 5 and not any(b"once" in p for p in all_)
    for bound in range(len(all_) + 1):
        cut = frequent_pieces(df, BYTE, bound)
        assert len(cut) <= bound and cut == all_[:len(cut)]
    assert frequent_pieces(df, BYTE, len(all_)) == all_
    assert frequent_pieces(df.where("false"), BYTE, 9) == []


def test_lexicon_is_minimal_and_exact():
    names = [a + b + c for a in ("th", "ing", "re") for b in ("", "x", "yy") for c in ("ed", "s", "")] + ["", "zz"]
    words_ = {w.encode(): [i, i + 1][:1 + i % 2] for i, w in enumerate(sorted(set(names)))}
    lex = Lexicon(compile_lexicon(words_))
    keys = sorted(words_)
    data = np.frombuffer(b"".join(keys) + b"nothingthx", np.uint8)
    size = np.array([len(k) for k in keys] + [7, 3])
    rank = lex.rank(data, np.cumsum(size) - size, size)
    assert rank[:-2].tolist() == list(range(len(keys))) and rank[-2] == -1
    assert lex.words(rank[:-2]) == [words_[k] for k in keys]
    assert len(lex.final) < sum(map(len, keys)) / 2  # shared prefixes and suffixes


# ---- 7 ---------------------------------------------------------------------------
def test_toxicity_held_out(engine):
    d = "/root/testdata/sf0.1"
    docs, labels = engine.read.parquet(f"{d}/documents.parquet"), engine.read.parquet(f"{d}/labels.parquet")
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out("doc_id")).select("toxic", "score").collect()
    right = sum((r["score"] >= .5) == (r["toxic"] == 1) for r in scored)
    assert right >= .95 * len(scored)
    found = toxicity.offending_sentences("the cat sat on it. you worthless idiot, loser and scum! the end of it.", model)
    assert [(a, b) for a, b, _ in found] == [(18, 55)]


def test_toxicity_knows_words_no_clean_text_holds():
    rng = np.random.default_rng(2)

    def texts(n, insult):
        return [" ".join(f"w{x}" for x in rng.integers(0, 3000, 40)) + (". clown. " if insult(i) else ". ") for i in range(n)]

    for toxic, clean, holding in ((40, 280, 15), (400, 1200, 34)):  # the word is in 15 of 40, 34 of 400 toxic texts and in no clean one
        rows = texts(toxic, lambda i: i < holding) + texts(clean, lambda i: False)
        model = toxicity.fit(pa.array(rows), np.arange(len(rows)) < toxic)
        new = pa.array(["all is well. what a clown he is.", "all is well. what a day it is.", "w1 w2 w3. w4 w5."])
        score = np.concatenate([model.rows(*s) for s in toxicity.sentences(new)])
        assert score[0] >= .5 and (score[1:] < .5).all(), (toxic, score)
    # the test itself: 18 of 45 toxic and 0 of 284 clean texts; both splits of two in four; the bound on false finds
    assert toxicity.by_chance(np.array([18]), np.array([18]), 45, 329)[0] < 1e-15
    assert np.allclose(toxicity.by_chance(np.array([2, 2]), np.array([2, 1]), 2, 4), [1 / 3, 1])
    assert toxicity.telling(np.array([.5, .001, .04, .9])).tolist() == [False, True, False, False] and not len(toxicity.telling(np.zeros(0)))


def test_toxicity_recall_on_small_tables(engine):
    d = "/root/testdata/sf0.01"
    docs, labels = engine.read.parquet(f"{d}/documents.parquet"), engine.read.parquet(f"{d}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where(toxicity.held_out("doc_id")).select("toxic", "score").collect()
    toxic = [r["score"] >= .5 for r in scored if r["toxic"] == 1]
    assert sum(toxic) >= .6 * len(toxic) and not any(r["score"] >= .5 for r in scored if r["toxic"] == 0)


def test_toxicity_on_odd_rows(engine, odd):
    labels = engine.createDataFrame([(1, 0), (4, 1), (4, 0), (7, None), (None, 1)], "doc_id long, toxic int")
    model = toxicity.train(odd, labels)
    out = toxicity.score(odd, model, to="how").collect()
    assert len(out) == len(ODD) and all(0 <= r["how"] <= 1 for r in out)
    none = toxicity.train(odd, labels.where("false"))
    assert {r["how"] for r in toxicity.score(odd, none, to="how").collect()} == {0.0}
    assert toxicity.score(odd.where("false"), model, to="how").count() == 0


# ---- 8 ---------------------------------------------------------------------------
def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def test_license_scan(engine, odd):
    texts = [t for t in license_scan.TEMPLATES.values()] + ["x\n" + license_scan.TEMPLATES["mit"].upper() + "\nReleased under MIT License", "line one\n\nPermission is hereby\ngranted", "the quick", None, "",
                                                            license_scan.TEMPLATES["mit-text"].replace(". ", ".\n").replace(", to", ",\nto")]
    df = engine.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = {k: set(license_scan.template_bigrams(t)) for k, t in license_scan.TEMPLATES.items()}
    import re
    for r in license_scan.scanned(df).collect():
        t = texts[r["doc_id"]] or ""
        units = t.split("\n") + [b for b in re.split(r"\n[ \t\r]*\n", t) if "\n" in b]
        hits = [(dice(s, set(license_scan.template_bigrams(u))), k) for u in units for k, s in sets.items() if re.search(r"[A-Za-z0-9]", u)]
        hits = [(-d, k) for d, k in hits if d >= license_scan.ALIKE]
        best = min(hits) if hits else (None, None)
        assert (r["license"], r["dice"], r["n_hits"]) == (best[1], None if best[0] is None else -best[0], len(hits)), t
    plan = license_scan.scanned(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    assert license_scan.scanned(odd).where("n_hits > 0").count() == 0 and license_scan.scanned(odd).count() == len(ODD)


# ---- 9 ---------------------------------------------------------------------------
def test_url_filter(engine):
    urls = {"HTTP://WWW.Example.COM/en/x?q#f": ("www.example.com", "/en/x", "www.example.com/en/", "allow"), "https://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
            "https://b.example.com/de": ("b.example.com", "/de", "com/", "allow"), "x://notexample.net/fr/1": ("notexample.net", "/fr/1", "net/fr/", "block"), "x://h.com": ("h.com", "", None, "allow"),
            "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"), "": ("", "", None, "allow"), "a://": ("", "", None, "allow"), "https://ex.org?x=http://q.net/fr/": ("ex.org", "", None, "allow")}
    df = engine.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] + [(None, None, "h")], "page_id long, url string, host string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judged(df).collect()}
    assert got == {**dict(enumerate(urls.values())), None: ("", "", None, "allow")}
    assert url_filter.judged(df.where("false")).count() == 0
    many = engine.createDataFrame([(i, f"https://bad.net/{'es' if i % 2 else 'xx'}/{i}") for i in range(200)] + [(500 + i, f"https://c{i}.com/a") for i in range(100)]
                                  + [(1000 + i, f"https://w{i}.org/a") for i in range(5)], "page_id long, url string")
    verdicts = {r["page_id"]: r["verdict"] for r in url_filter.judged(many).collect()}
    assert verdicts[0] == "block" and verdicts[1000] == "allow"


# ---- 10 --------------------------------------------------------------------------
def test_substring_dedup(engine, small, odd):
    base = " ".join(f"w{i}" for i in range(40))
    rows = [(1, base), (2, base), (2, base + " x y z"), (2, None), (None, base), (4, " ".join(["a"] * 60)), (5, " ".join(["a"] * 30)), (6, "q " + base[10:] + "\t\nend"), (2, base), (9, base + " " + base)]
    for r in (rows, ODD):
        assert bag(kept_digests(engine.createDataFrame(r, "doc_id long, text string"))) == without_repeats(r)
    assert bag(kept_digests(engine.createDataFrame(small, "doc_id long, text string"))) == without_repeats(small)
    assert kept_digests(odd.where("false")).count() == 0
    cut = dedup_texts(odd)
    assert cut.columns == odd.columns and cut.count() == len(ODD)
    texts = {r["doc_id"]: r["text"] for r in dedup_texts(engine.createDataFrame([(1, base), (3, "one  two\n" + base + "\nend")], "doc_id long, text string")).collect()}
    assert texts == {1: base, 3: "one  two end"}
    assert len(words(texts[3])) == 3
