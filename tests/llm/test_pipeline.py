"""The pipeline's stages against what their operators must do, and the registered queries."""

import duckdb
import pytest
from brute import exact_items, linked, without_repeats
from cases import ODD, SF_SMALL, engine, odd, small  # noqa: F401 (fixtures)

import corpus_pipeline as P
from dayload.llm import queries as Q


@pytest.fixture(scope="module")
def stages(engine):
    out = [engine.read.parquet(f"{SF_SMALL}/documents.parquet")]
    for name, f in P.STAGES:
        out.append(P.saved(f(engine, out[-1], SF_SMALL), f"test-{name}"))
    return out


def test_stages(stages):
    raw, clean, unlike, cut, fair, encoded = stages
    assert all(s.columns == raw.columns for s in stages[1:5])
    rows = lambda df: [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    assert {i for i, _ in rows(unlike)} == {i for i, _, c in linked(rows(clean)) if i == c}
    removed = {i: n for i, _, n, _ in without_repeats(rows(unlike))}
    before = dict(rows(unlike))
    for i, t in rows(cut):
        assert len(t.split()) == len(before[i].split()) - removed[i] and (removed[i] or t == before[i])
    items = [(r["item_id"], r["text"]) for r in raw.sparkSession.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert {i for i, _ in rows(fair)} == {i for i, _ in rows(cut)} - {d for d, _ in exact_items(rows(cut), items)}
    assert encoded.count() == fair.count()
    assert all(r["n_chars"] == len(r["text"]) for r in cut.collect())


def test_ngram_join_stage_links_by_five_words_and_four_fifths(engine):
    # one of 50 words changed, shingles shared of all: 41 of 51 (5 words, 0.804) and 43 of 51 (4 words, 0.843)
    base = [f"a{i}" for i in range(50)]
    rows = [(1, " ".join(base)), (2, " ".join("new" if i == 20 else w for i, w in enumerate(base))), (3, " ".join(f"b{i}" for i in range(50)))]
    docs = engine.createDataFrame([(i, t, None, None, None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r["doc_id"] for r in P.ngram_join(engine, docs, SF_SMALL).collect()) == [1, 3]


def test_stages_on_odd_rows(engine):
    docs = engine.createDataFrame([(i, t, None, None, None) for i, t in ODD], "doc_id long, text string, lang string, source string, n_chars long")
    for d in (docs, docs.where("false")):
        for _, f in P.STAGES[:4]:
            out = f(engine, d, SF_SMALL)
            assert out.columns == d.columns and out.count() <= d.count()
        assert P.STAGES[4][1](engine, d, SF_SMALL).count() == d.count()


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_oracles(engine, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    df = Q.QUERIES[name](engine, SF_SMALL)
    cur = con.execute(Q.ORACLES[name])
    cols = [c[0] for c in cur.description]
    want = sorted((tuple(dict(zip(cols, r))[c] for c in df.columns) for r in cur.fetchall()), key=str)
    assert sorted((tuple(r) for r in df.collect()), key=str) == want


def test_names():
    assert sorted(int(n.split("_")[0][2:]) for n in Q.QUERIES) == list(range(1, 11))
