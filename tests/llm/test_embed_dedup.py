import numpy as np

from barflow.llm import embed_dedup as D
from barflow.llm import queries
from barflow.llm.components import connected_components


def brute(rows, least=0.9):
    """(vec_id, n_links, component_id, kept) by all pairs."""
    ok = [v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = [np.asarray(v, float) / np.linalg.norm(np.asarray(v, float)) if o else None for (_, v), o in zip(rows, ok)]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if ok[i] and ok[j] and len(units[i]) == len(units[j]) and units[i] @ units[j] >= least - 1e-12:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[root(i)] = min(low.get(root(i), k), k)
    return sorted(((k, links[i], low.get(root(i)), k == low.get(root(i))) for i, (k, _) in enumerate(rows)), key=str)


def balls(seed, n_random, groups, noise, width=24):
    rng = np.random.default_rng(seed)
    x = [rng.normal(size=width) for _ in range(n_random)]
    for size in groups:
        center = rng.normal(size=width)
        x += [center + noise * rng.normal(size=width) for _ in range(size)]
    order = rng.permutation(len(x))
    return [(int(k), [float(np.float32(v)) for v in x[i]]) for k, i in enumerate(order)]


def spark_rows(spark, rows):
    table = spark.createDataFrame([(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<float>, label int, shard string").repartition(4)
    return sorted((tuple(r) for r in D.link_vectors(table).collect()), key=str)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(D, "SHARD", 150)
    monkeypatch.setattr(D, "MAX_SHARD", 260)
    rows = balls(1, 500, [60, 40, 9, 5, 3, 2], 0.12)
    want, got = brute(rows), spark_rows(spark, rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)
    assert all(a[1] <= b[1] for a, b in zip(got, want))  # no link that is none
    assert sum(a[2] == b[2] for a, b in zip(got, want)) >= 0.99 * len(want)


def test_graph_and_search_in_one_shard():
    rows = balls(2, 300, [80, 20, 4], 0.1)
    x = D.unit([v for _, v in rows])
    edges = D.build_graph(x)
    assert edges.shape == (len(x), D.DEGREE) and all(i not in set(e) for i, e in enumerate(edges))
    found = {(int(a), int(b)) for q, v in D.range_search(x, D._both_ways(edges), np.arange(len(x))) for a, b in zip(q, v)}
    want = {(int(a), int(b)) for q, v in D.exact_search(x, np.arange(len(x))) for a, b in zip(q, v)}
    assert found <= want and len(found) >= 0.99 * len(want)


def test_edge_cases(spark):
    v, w = [1.0, 0.0, 2.0], [0.0, 1.0, 0.0]
    rows = [(1, v), (2, v), (2, v), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 2.0]), (6, [float("nan"), 1.0, 1.0]), (7, w), (8, [float("inf"), 1.0, 1.0]),
            (9, []), (10, [1.0, 0.0, 2.01]), (None, w), (11, [1.0, 2.0]), (12, [-0.0, 1.0, 0.0])]
    assert spark_rows(spark, rows) == brute(rows)
    assert spark_rows(spark, [(1, v)]) == [(1, 0, 1, True)]
    assert D.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in queries.op9_embeddings(spark, "/root/testdata/sf0.01").collect()), key=str) == brute(rows)


def test_components(spark):
    edges = [(k, k + 1) for k in range(50, 90)] + [(1, 2), (2, 3), (7, 7), (100, 1)] + [(200, k) for k in range(201, 260)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 50 for k in range(50, 91)} | {1: 1, 2: 1, 3: 1, 100: 1} | {k: 200 for k in range(200, 260)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_count_at_both_ends(spark, monkeypatch):
    """A pair that shares two shards counts once, a pair that meets away from one end's home counts at both ends."""
    rows = balls(3, 0, [2, 2, 2], 0.05)
    rows.sort(key=lambda r: r[1])
    x = D.unit([v for _, v in rows])
    near = {i: int(np.argsort(-(x @ x[i]))[1]) for i in range(len(x))}
    a = 0
    b = near[a]
    c = next(i for i in near if i not in (a, b))
    d = near[c]
    # a's home has b, b's home lacks a; c and d share both shards.
    dealt = [(a, "0", True), (a, "1", False), (b, "2", True), (b, "0", False), (c, "3", True), (c, "4", False), (d, "4", True), (d, "3", False)]
    table = spark.createDataFrame([(i, rows[i][1], 1, s, h) for i, s, h in dealt], "cls long, vec array<double>, copies long, shard string, home boolean")
    got = D._search_shards(table, 0.9).groupBy("cls").sum("n").collect()
    assert {r[0]: r[1] for r in got} == {a: 1, b: 1, c: 1, d: 1}


def test_links_between_shards(spark, monkeypatch):
    """Pairs of random directions that two shards of many would part."""
    monkeypatch.setattr(D, "SHARD", 15)
    rows = balls(5, 300, [2] * 150, 0.2)
    want, got = brute(rows), spark_rows(spark, rows)
    assert sum(r[1] for r in want) >= 200
    assert all(a[1] <= b[1] for a, b in zip(got, want))
    assert sum(r[1] for r in got) >= 0.97 * sum(r[1] for r in want)


def test_lengths_apart_link_among_themselves(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.05]), (3, [1.0, 0.0, 0.0]), (4, [0.0, 1.0, 0.0]), (5, [0.0, 0.0, 1.0]), (6, [0.0, 0.02, 1.0]), (7, [5.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in D.link_vectors(df).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (1, 5), 6: (1, 5), 7: (0, 7)}
