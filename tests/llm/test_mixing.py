import hashlib
import random

import numpy as np

from barflow.llm import mixing as M
from barflow.llm import queries

SF = "/root/testdata/sf0.01"


def test_raking_meets_the_marginals():
    rng = np.random.default_rng(1)
    tokens = rng.integers(1000, 5000, size=(4, 3, 2)).astype(float)
    targets = [np.array([0.3, 0.3, 0.2, 0.2]), np.array([0.4, 0.3, 0.3]), np.array([0.55, 0.45])]
    kept, miss = M.rake(tokens, targets, 0.5)
    assert miss < 1e-6 and (kept <= tokens + 1e-9).all() and (kept >= M.LEAST * tokens - 1e-9).all()
    for axis, target in enumerate(targets):
        sums = kept.sum(axis=tuple(k for k in range(3) if k != axis))
        assert np.allclose(sums / kept.sum(), target, atol=1e-6)
    assert abs(kept.sum() - 0.5 * tokens.sum()) < 1e-3 * tokens.sum()


def test_plain_raking_equals_the_classic_iteration():
    """Where no bound is reached it is plain iterative proportional fitting."""
    rng = np.random.default_rng(2)
    tokens = rng.integers(900, 1100, size=(3, 3)).astype(float)
    targets = [np.array([0.36, 0.33, 0.31]), np.array([0.3, 0.33, 0.37])]
    kept, _ = M.rake(tokens, targets, 0.4)
    w = tokens * 0.4
    total = w.sum()
    for _ in range(200):
        w = w * (total * targets[0] / w.sum(axis=1))[:, None]
        w = w * (total * targets[1] / w.sum(axis=0))[None, :]
    assert np.allclose(kept, w, rtol=1e-6)


def test_targets_out_of_reach_and_empty_cells():
    tokens = np.array([[10.0, 0.0], [0.0, 1000.0]])
    kept, miss = M.rake(tokens, [np.array([0.9, 0.1]), np.array([0.1, 0.9])], 0.8)
    assert miss > 0.1 and (kept <= tokens).all() and kept[0, 1] == 0
    kept, miss = M.rake(np.zeros((2, 2)), [np.array([0.5, 0.5])] * 2, 0.5)
    assert kept.sum() == 0 and miss == 0


def test_documents_against_brute_force(spark):
    rows = queries.op1_mixing(spark, SF).collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    names = [[*getattr(M.MIX, d), M.OTHER] for d in M.DIMENSIONS]
    at = lambda r: tuple(n.index(r[d]) if r[d] in n else len(n) - 1 for n, d in zip(names, M.DIMENSIONS))
    tokens = np.zeros([len(n) for n in names])
    for r in rows:
        text = docs[r["doc_id"]]["text"]
        assert r["n_tokens"] == len(text.split())
        tokens[at(r)] += r["n_tokens"]
    kept, _ = M.rake(tokens, [np.array([getattr(M.MIX, d).get(x, 0.0) for x in n]) for n, d in zip(names, M.DIMENSIONS)], M.MIX.keep)
    # The largest miss, from the probabilities that were returned.
    sums = np.zeros(tokens.shape)
    for r in rows:
        sums[at(r)] += r["probability"] * r["n_tokens"]
    misses = []
    for axis, (n, d) in enumerate(zip(names, M.DIMENSIONS, strict=True)):
        others = tuple(k for k in range(3) if k != axis)
        goal = np.array([getattr(M.MIX, d).get(x, 0.0) for x in n]) * (tokens.sum(axis=others) > 0)
        misses.append(np.abs(sums.sum(axis=others) - M.MIX.keep * tokens.sum() * goal / goal.sum()).max())
    assert all(abs(r["residual"] - max(misses) / (M.MIX.keep * tokens.sum())) < 1e-6 for r in rows)
    for r in rows:
        p = kept[at(r)] / tokens[at(r)]
        u = int(hashlib.md5(f"mix:{r['doc_id']}".encode()).hexdigest()[:8], 16) / 2**32
        assert abs(r["probability"] - p) < 1e-9 and (r["sampled"] == (u < p) or abs(u - p) < 1e-9)


def test_edge_cases(spark):
    rnd = random.Random(4)
    rows = [(k, "some words " * rnd.randint(1, 40), rnd.choice(["src0", "src1", "new", None]), rnd.choice(["en", None, "xx"]), "mine", 5) for k in range(60)]
    rows += [(None, None, None, None, None, None), (3, "", "src0", "en", "mine", 0), rows[5], rows[5]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, _source string, n_chars long").drop("_source")
    got = M.mix_documents(docs).collect()
    assert len(got) == len(rows) and all(0 <= r["probability"] <= 1 and r["sampled"] is not None for r in got)
    again = {str(r["doc_id"]): r["sampled"] for r in M.mix_documents(docs.repartition(7)).collect()}
    assert all(again[str(r["doc_id"])] == r["sampled"] for r in got)
    assert M.mix_documents(docs.limit(0)).count() == 0


def test_unnamed_categories_are_kept_like_the_rest(spark):
    rnd = random.Random(8)
    rows = [(k, "some plain words " * 60, rnd.choices([*M.MIX.source, "new", None], [*M.MIX.source.values(), 0.06, 0.06])[0],
             rnd.choices([*M.MIX.lang, "xx", None], [*M.MIX.lang.values(), 0.03, 0.03])[0]) for k in range(3000)]
    got = M.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")).collect()
    for d in ("source", "lang"):
        named = [r["probability"] for r in got if r[d] in getattr(M.MIX, d)]
        for unnamed in ("new" if d == "source" else "xx", None):
            some = [r["probability"] for r in got if r[d] == unnamed]
            assert some and abs(np.mean(some) - np.mean(named)) < 0.05
    explicit = M.Mix(M.MIX.source | {M.OTHER: 0.02}, M.MIX.lang, M.MIX.topic, 0.5)
    got = M.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, lang string"), explicit).collect()
    share = sum(r["probability"] for r in got if r["source"] in ("new", None)) / sum(r["probability"] for r in got)
    assert abs(share - 0.02 / (sum(M.MIX.source.values()) + 0.02)) < 0.01
