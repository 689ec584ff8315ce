"""Packing, periodic runs and whitening against brute force, and on odd rows."""

import hashlib
import math
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from brute import words
from cases import ODD, engine, odd, small  # noqa: F401 (fixtures)
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayload.llm import packing, periodic_runs, whitening
from dayload.llm.words import mix

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ---- 11 --------------------------------------------------------------------------
def pieces_of(rows, capacity):
    tok, out = Tokenizer.from_file(BYTE), []
    tok.no_truncation()
    tok.no_padding()
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            out.append((i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return sorted(out, key=str)


def check_packed(rows, df, capacity, **kw):
    got = packing.pack_documents(df, BYTE, capacity, **kw).collect()
    assert sorted((tuple(r)[:5] for r in got), key=str) == pieces_of(rows, capacity)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return got, len(bins)


@pytest.mark.parametrize("capacity,items", [(2048, 1 << 16), (64, 40), (1, 5)])
def test_packing(engine, small, odd, capacity, items):
    rows = small if capacity > 1 else small[:10]
    df = engine.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got, n = check_packed(rows, df, capacity, group_items=items)
    total = sum(r["length"] for r in got)
    if capacity == 2048:
        whole = len(packing.best_fit([r["length"] for r in got], capacity))
        assert n <= 1.03 * whole + 1 and n <= 1.05 * math.ceil(total / capacity) + 1
    check_packed(ODD, odd, capacity, group_items=items)
    assert packing.pack_documents(odd.where("false"), BYTE).count() == 0


def test_best_fit_takes_the_tightest_bin():
    assert packing.best_fit([5, 6, 4, 5, 10], 10) == [[4], [1, 2], [0, 3]]
    rng = np.random.default_rng(3)
    for _ in range(20):
        sizes = rng.integers(1, 40, 200).tolist()
        bins, want = packing.best_fit(sizes, 50), []
        for i in sorted(range(200), key=lambda i: (-sizes[i], i)):  # the plain rule
            fit = [b for b in want if b[0] >= sizes[i]]
            if fit:
                min(fit, key=lambda b: b[0])[0] -= sizes[i]
            else:
                want.append([50 - sizes[i]])
        assert sorted(50 - sum(sizes[i] for i in b) for b in bins) == sorted(b[0] for b in want)


def test_no_two_bins_of_the_tree_fit_together(engine):
    rows = [(i, "tok " * (i * 37 % 90)) for i in range(400)]
    df = engine.createDataFrame(rows, "doc_id long, text string").repartition(16)
    got, n = check_packed(rows, df, 100, group_items=1 << 16)
    fill = defaultdict(int)
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    least = sorted(fill.values())[:2]
    assert sum(least) > 100 - packing.SLACK


def test_sequences_hold_the_ids(engine, odd):
    tok = Tokenizer.from_file(BYTE)
    got = packing.packed_sequences(odd, BYTE, 512).collect()
    assert all(len(r["ids"]) <= 512 and sum(r["lengths"]) == len(r["ids"]) for r in got)
    flat = sorted(i for r in got for i in r["ids"])
    assert flat == sorted(i for _, t in ODD for i in tok.encode(t or "", add_special_tokens=False).ids + [0])


# ---- 12 --------------------------------------------------------------------------
def plain_runs(w, least=12):
    """Every run by trying every period."""
    n, out = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((a, b - a, q) for (a, b), q in out.items())


def found_runs(texts):
    """The operator's core on lists of small integers."""
    first = np.cumsum([0] + [len(x) + 1 for x in texts])
    t = np.zeros(first[-1], np.uint64)
    for k, (a, x) in enumerate(zip(first, texts)):
        t[a:a + len(x)] = mix(np.array(x, np.uint64) + np.uint64(1))
        t[a + len(x)] = mix(np.array([10 ** 9 + k], np.uint64))[0]
    out = [[] for _ in texts]
    for lo, hi, q in periodic_runs.find_runs(t, first[:-1]).T.tolist():
        r = int(np.searchsorted(first, lo, "right")) - 1
        out[r].append((lo - int(first[r]), hi - lo, q))
    return [sorted(x) for x in out]


def structured():
    """Texts with many runs: random over few letters, powers, nested powers, Fibonacci and Thue-Morse words, touching regions."""
    rng, out = np.random.default_rng(12), [[], [1], [2] * 11, [2] * 12, [2] * 300]
    for k in (1, 2, 3, 5):
        out += [rng.integers(0, k + 1, rng.integers(10, 260)).tolist() for _ in range(40)]
    for _ in range(60):
        root = rng.integers(0, 3, rng.integers(1, 50)).tolist()
        for _ in range(rng.integers(1, 4)):
            root = root * int(rng.integers(1, 5)) + rng.integers(0, 3, rng.integers(0, 4)).tolist()
        out.append(root[:700])
    for p in (1, 2, 3, 4, 7):  # highly periodic first periods: (r^k s)^2 in all rotations, and regions that touch
        r = rng.integers(0, 9, p).tolist()
        for k in (12, 20, 33):
            for s in ([77], r[:p // 2], [77, 78], r[1:]):
                u = (r * (1 + k // p)) + s
                for turn in (0, 1, len(u) // 2, len(u) - 1):
                    v = u[turn:] + u[:turn]
                    out += [v * 2, [99] + v * 2 + [98], v * 3 + v[:5]]
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    out.append(b)
    out.append([bin(i).count("1") % 2 for i in range(1024)])
    return out


def test_runs_are_brute_force():
    texts = structured()
    for x, got in zip(texts, found_runs(texts)):
        assert got == plain_runs(x), x
    alone = [texts[i] for i in range(0, len(texts), 9)]
    assert [found_runs([x])[0] for x in alone] == [plain_runs(x) for x in alone]


def plain_digest(i, text, planted):
    w = words(text)
    n, h = len(w), None if i is None else zlib.crc32(str(i).encode())
    if planted and h is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[j] if j < a else w[a + (j - a) % p] for j in range(n)]
    runs = fast_runs(w)
    gone = set()
    for s, length, q in runs:
        gone.update(range(s + q, s + length))
    best = min(((-m, s, q) for s, m, q in runs), default=None)
    return (i, len(runs), *((best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4),
            hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(x for j, x in enumerate(w) if j not in gone)).hexdigest())


def fast_runs(w):
    """As ``plain_runs``, with numpy for the comparisons."""
    code = {x: k for k, x in enumerate(dict.fromkeys(w))}
    t, out = np.array([code[x] for x in w], np.int64), {}
    for q in range(1, len(t) // 2 + 1):
        edge = np.flatnonzero(np.diff(np.r_[0, (t[q:] == t[:-q]).astype(np.int8), 0]))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if b + q - a >= max(12, 2 * q):
                out.setdefault((a, b + q), q)
    return sorted((a, b - a, q) for (a, b), q in out.items())


@pytest.mark.parametrize("planted", [True, False])
def test_run_digests(engine, small, odd, planted):
    short = [(i, t if len(t or "") < 60_000 else t[:60_000]) for i, t in small]
    df = engine.createDataFrame(short, "doc_id long, text string")
    assert bag(periodic_runs.run_digests(df, planted)) == sorted((plain_digest(i, t, planted) for i, t in short), key=str)
    few = [r for r in ODD if len(r[1] or "") < 10_000]
    df = odd.where(F.coalesce(F.length("text"), F.lit(0)) < 10_000)
    assert bag(periodic_runs.run_digests(df, planted)) == sorted((plain_digest(i, t, planted) for i, t in few), key=str)
    assert periodic_runs.run_digests(odd).count() == len(ODD)
    assert periodic_runs.run_digests(odd.where("false")).count() == 0


def test_runs_and_collapsed_text(engine):
    rows = [(1, "x " + "a b c " * 9 + "y"), (2, None), (3, "q" + " q" * 40), (4, "one two three")]
    df = engine.createDataFrame(rows, "doc_id long, text string")
    assert bag(periodic_runs.document_runs(df)) == [(1, 1, 27, 3), (3, 0, 41, 1)]
    assert bag(periodic_runs.collapsed_texts(df)) == [(1, "x a b c y"), (2, ""), (3, "q"), (4, "one two three")]


def test_very_long_text(engine):
    w = [f"w{i}" for i in range(30_000)]
    df = engine.createDataFrame([(1, " ".join(w * 4))], "doc_id long, text string")
    r = periodic_runs.run_digests(df).first()
    assert (r["n_runs"], r["start"], r["length"], r["period"], r["exponent_milli"]) == (1, 0, 120_000, 30_000, 4000)
    assert r["collapsed_sha256"] == hashlib.sha256(" ".join(w).encode()).hexdigest()


# ---- 13 --------------------------------------------------------------------------
def plain_whitening(rows):
    """{id: deviation}, covariance, mean of the x-vectors, in exact arithmetic where the contract is exact."""
    ok = [(i, [math.floor(1024 * float(c)) + 100_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n, d = len(ok), len(ok[0][1])
    sums = [sum(x[j] for _, x in ok) for j in range(d)]
    dev = [(i, sum((n * x[j] - sums[j]) ** 2 for j in range(d))) for i, x in ok]
    c = np.array([[float(Fraction(n * x[j] - sums[j], n)) for j in range(d)] for _, x in ok])
    return ok, n, dev, c, c.T @ c / n


def check_whitened(rows, got, tol=1e-9):
    ok, n, dev, c, cov = plain_whitening(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(8, len(values))
    by = defaultdict(dict)
    for r in got:
        by[r["vec_id"]][r["component"]] = r
    assert len(got) == k * n
    y = np.array([[by[i][j + 1]["whitened"] for j in range(k)] for i, _ in ok])
    want = c @ vectors[:, :k] / np.sqrt(values[:k])
    for j in range(k):
        sign = np.sign((y[:, j] * want[:, j]).sum())
        assert np.abs(sign * y[:, j] - want[:, j]).max() < tol
    for (i, v), _ in zip(dev, ok):
        assert by[i][1]["deviation"] == v and by[i][1]["n"] == n
    assert [by[ok[0][0]][j + 1]["explained"] for j in range(k)] == pytest.approx((values[:k] / values.sum()).tolist(), rel=1e-9)
    assert all(r["identity_error"] < 1e-9 for r in got)


def test_whitening(engine):
    df = engine.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    check_whitened(rows, whitening.whitened(df.repartition(5)).collect())


def test_whitening_odd_rows(engine):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=5).tolist()) for i in range(50)]
    rows += [(50, None), (51, [1.0, None, 2.0, 3.0, 4.0]), (52, [float("nan")] * 5), (53, [float("inf"), 0.0, 0.0, 0.0, 0.0]), (54, [])]
    extra = [(55, [1.0, 2.0]), (56, [3.0])]
    df = engine.createDataFrame(rows + extra, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("v", F.lit(1))
    check_whitened(rows, whitening.whitened(df).collect())
    twice = whitening.whitened(engine.createDataFrame([(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0])], "vec_id long, embedding array<float>")).collect()
    assert len(twice) == 6 and sorted(r["whitened"] is None for r in twice) == [False] * 3 + [True] * 3
    one = whitening.whitened(engine.createDataFrame([(1, [1.0, 1e300])], "vec_id long, embedding array<double>")).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, None, 0.0)] * 2
    far = whitening.whitened(engine.createDataFrame([(1, [1.0, 1e300]), (2, [2.0, -1e300])], "vec_id long, embedding array<double>")).collect()
    assert all(r["deviation"] is None for r in far) and len(far) == 4
    assert whitening.whitened(df.where("false")).count() == 0
    assert whitening.whitened(df.where("vec_id = 50")).count() == 0


@pytest.mark.parametrize("values", [[5, 4, 3, 2, 1], [1, 1, 1, 1, 1], [9, 1 + 1e-9, 1, 1 - 1e-9, 1e-3], [1e6, 1e6 * (1 + 1e-12), 1, 1 + 1e-7, 1 + 2e-7], [3, 3, 0, 0, 0]])
def test_refinement(values):
    rng = np.random.default_rng(1)
    q = np.linalg.qr(rng.normal(size=(5, 5)))[0]
    a = q @ np.diag(values) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refined(a)
    top = max(abs(v) for v in values)
    assert np.allclose(e, np.linalg.eigvalsh(a)[::-1], rtol=0, atol=2e-15 * top)
    assert np.abs(x.T @ x - np.eye(5)).max() < 1e-14
    assert np.abs(a @ x - x * e).max() < 4e-15 * top


def test_refinement_of_a_large_cluster():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    a = q @ np.diag(np.r_[np.full(30, 1.0) + np.arange(30) * 1e-8, np.arange(2, 36)]) @ q.T
    a = (a + a.T) / 2
    e, x = whitening.refined(a)
    assert np.abs(x.T @ x - np.eye(64)).max() < 1e-14
    assert np.abs(a @ x - x * e).max() < 1e-13


# ---- 10: windows that share a hash, and few different words ----------------------
@pytest.mark.parametrize("bits", [64, 12])
def test_windows_that_share_a_hash_are_told_apart(engine, monkeypatch, bits):
    from brute import without_repeats
    from dayload.llm import substring_dedup
    monkeypatch.setattr(substring_dedup, "NARROW", bits)
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 3, 300))) for i in range(120)]
    rows += [(200 + i, f"a{i} " + rows[i][1][30:400]) for i in range(20)]
    df = engine.createDataFrame(rows, "doc_id long, text string")
    assert bag(substring_dedup.kept_digests(df, k=13)) == without_repeats(rows)
