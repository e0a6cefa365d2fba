"""Near-duplicate embeddings by a robust-pruned flat graph over overlapping cluster shards.

1. Vectors that are equal are one class; null, zero or non-finite ones are set aside.
2. Shards: centroids are fitted on a bounded sample (``SAMPLE`` classes), those too
   close to an earlier one are dropped, and every class goes to its nearest shard
   (its home) and the second nearest (more if the audit asks for it). A shard above ``MAX_SHARD`` is cut again the same
   way, by centroids of its own, for ``ROUNDS`` rounds at most; one whose vectors are nearly
   all in range of each other stays whole (its links are as many as its pairs, however it
   is dealt).
3. Build: in every shard each vector's nearest others are robust-pruned to ``DEGREE``
   out-edges, and edges get their reverse.
4. Union: a vector's adjacency lists from its shards are joined.
5. Search: in each of its shards every vector runs a greedy search from the medoid and
   its own neighbours, which widens to every neighbour within range (less a margin)
   until none is left. What it meets is verified by the exact cosine and counts at both
   ends, in the first shard that has both.
6. Audit: in every shard the searches of a fixed part of the vectors are compared with
   an exact scan; a shard below ``LEAST_RECALL`` is searched again with a wider beam
   and margin, and scanned in blocks if that fails too. Against what lies between the
   shards, the links of ``AUDIT`` fixed vectors are counted by a scan of all vectors;
   while fewer than ``LEAST_RECALL`` of them are found, every vector is dealt to twice as
   many shards, in the end all to one.
7. Components of all links, from one label a vector and shard, never from all pairs.

Edge cases: vectors set aside have no links and are their own component; equal vectors
link with each other; a null id is an id of its own rows only, with a null component if
alone; vectors link with those of their own length only, each length being searched by itself;
an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.components import connected_components
from barflow.session import materialize

LEAST_COSINE = 0.9
SAMPLE = 20_000
SHARD = 1_000
MAX_SHARD = 8_000
MAX_CENTROIDS = 128
ROUNDS = 6
POOL = 48
DEGREE = 24
ALPHA = 1.2
BEAM = 4
HOPS = 12
MARGIN = 0.05
LEAST_RECALL = 0.97
AUDIT_EVERY = 50
AUDIT = 1_000
_BLOCK = 256
# Ends the name of a shard that centroids cannot cut.
WHOLE = "!"


def unit(rows) -> np.ndarray:
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def fit_centroids(x: np.ndarray, k: int, rounds: int = 5, seed: int = 1) -> np.ndarray:
    """k spherical centroids at most; of centroids within range of each other the first stays."""
    rng = np.random.default_rng(seed)
    centers = x[rng.choice(len(x), min(k, len(x)), replace=False)]
    for _ in range(rounds):
        nearest = (x @ centers.T).argmax(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centers = np.where(size > 0, sums / np.maximum(size, 1e-300), centers)
    kept: list[int] = []
    near = centers @ centers.T
    for i in range(len(centers)):
        if all(near[i, j] < LEAST_COSINE - 0.1 for j in kept):
            kept.append(i)
    return centers[kept]


def _nearest(x: np.ndarray, centers: np.ndarray, places: int) -> np.ndarray:
    return np.argsort(-(x @ centers.T), axis=1, kind="stable")[:, :places]


def deal_shards(vectors: DataFrame, places: int = 2) -> DataFrame:
    """(cls, vec, copies, shard, home): every class in its ``places`` nearest shards, the first its home; in one if that is all of them."""
    n = vectors.count()
    k = min(MAX_CENTROIDS, max(1, -(-n // SHARD)))
    if places > 2 and places >= k:
        return vectors.select("cls", "vec", "copies", F.lit(WHOLE).alias("shard"), F.lit(True).alias("home"))
    sample = unit([r["vec"] for r in vectors.orderBy(F.xxhash64("cls")).limit(SAMPLE).select("vec").collect()])
    centers = fit_centroids(sample, k)

    def first(frames):
        for f in frames:
            near = _nearest(unit(f["vec"]), centers, places)
            for place in range(near.shape[1]):
                yield f.assign(shard=[str(c) for c in near[:, place]], home=place == 0)

    schema = "cls long, vec array<double>, copies long, shard string, home boolean"
    rows = materialize(vectors.mapInPandas(first, schema), "shards")
    finished = None
    for _ in range(ROUNDS):
        sizes = materialize(rows.groupBy("shard").agg(F.count("*").alias("size")), "shard_sizes")
        cut = (F.col("size") > MAX_SHARD) & ~F.endswith("shard", F.lit(WHOLE))
        large = sizes.where(cut)
        if not large.limit(1).count():
            return rows if finished is None else finished.unionAll(rows)
        small = rows.join(sizes.where(~cut).select("shard"), "shard").select(rows.columns)
        finished = small if finished is None else finished.unionAll(small)
        rows = materialize(_cut_again(rows.join(large, "shard"), places), "shards")
    return finished.unionAll(rows)


def _cut_again(rows: DataFrame, places: int = 2) -> DataFrame:
    """Shards that are too large, each dealt to centroids fitted on a bounded part of it."""
    salts = 32

    def fit(key, f):
        centers = fit_centroids(unit(f["vec"]), min(64, max(8, int(f["size"].iloc[0]) // SHARD)))
        return pd.DataFrame({"shard": [key[0]], "centers": [centers.ravel().tolist()], "width": [centers.shape[1]]})

    some = rows.where(F.pmod(F.xxhash64("cls"), F.greatest(F.col("size") / 4000, F.lit(1)).cast("long")) == 0)
    centers = some.groupBy("shard").applyInPandas(fit, "shard string, centers array<double>, width int")
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("cls"), F.lit(salts))).join(
        centers.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))), ["shard", "salt"])

    def deal(frames):
        for f in frames:
            for shard, part in f.groupby("shard"):
                own = np.asarray(part["centers"].iloc[0]).reshape(-1, int(part["width"].iloc[0]))
                out = part[["cls", "vec", "copies"]]
                if len(own) < 4:  # two shards each of three would hold nearly all: such a ball stays whole
                    yield out.assign(shard=f"{shard}{WHOLE}", home=part["home"])
                    continue
                near = _nearest(unit(part["vec"]), own, min(places, len(own) // 2))
                for place in range(near.shape[1]):
                    yield out.assign(shard=[f"{shard}.{c}" for c in near[:, place]], home=part["home"] & (place == 0))

    return salted.mapInPandas(deal, "cls long, vec array<double>, copies long, shard string, home boolean")


def robust_prune(x: np.ndarray, pool: np.ndarray, sims: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Rows of ``pool`` (nearest first) thinned: a candidate goes if a kept one is ``alpha`` times nearer to it than the vertex.

    All vertices of a block advance together; -1 fills a list that ends early.
    """
    n, width = pool.shape
    alive = pool >= 0
    out = np.full((n, degree), -1, dtype=np.int64)
    far = 1.0 - sims
    for place in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        chosen = np.where(some, pool[np.arange(n), first], -1)
        out[:, place] = chosen
        between = 1.0 - np.einsum("nwd,nd->nw", x[np.maximum(pool, 0)], x[np.maximum(chosen, 0)])
        alive &= ~((alpha * between <= far) & some[:, None])
        alive[np.arange(n), first] = False
    return out


def build_graph(x: np.ndarray) -> np.ndarray:
    """Out-edges (rows of vertex numbers, -1 for none) of the flat graph over the unit vectors ``x``."""
    n = len(x)
    width = min(POOL, n - 1)
    edges = np.full((n, DEGREE), -1, dtype=np.int64)
    if width < 1:
        return edges
    for at in range(0, n, _BLOCK):
        rows = np.arange(at, min(n, at + _BLOCK))
        near = x[rows] @ x.T
        near[np.arange(len(rows)), rows] = -np.inf
        pool = np.argpartition(-near, width - 1, axis=1)[:, :width]
        sims = np.take_along_axis(near, pool, axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")
        edges[rows] = robust_prune(x, np.take_along_axis(pool, order, 1), np.take_along_axis(sims, order, 1))
    return edges


def _both_ways(edges: np.ndarray) -> list[np.ndarray]:
    n = len(edges)
    src, dst = np.repeat(np.arange(n), edges.shape[1]), edges.ravel()
    ok = dst >= 0
    pairs = np.unique(np.concatenate([src[ok] * n + dst[ok], dst[ok] * n + src[ok]]))
    return np.split(pairs % n, np.searchsorted(pairs // n, np.arange(1, n)))


def range_search(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, beam: int = BEAM, margin: float = MARGIN,
                 least: float = LEAST_COSINE):
    """(query, vertex) arrays of verified links, a block of queries at a time."""
    n = len(x)
    start = np.concatenate([[0], np.cumsum([len(a) for a in lists])])
    flat = np.concatenate(lists) if n else np.empty(0, np.int64)
    medoid = int((x @ x.mean(axis=0)).argmax())
    for at in range(0, len(queries), _BLOCK):
        some = queries[at:at + _BLOCK]
        m = len(some)
        seen = np.full((m, n), -np.inf)
        done = np.zeros((m, n), dtype=bool)
        lane = np.arange(m)
        seen[lane, some] = 1.0
        seen[lane, medoid] = x[some] @ x[medoid]
        for hop in range(n):
            # In range and not yet expanded; for the first hops also the best ones of each lane.
            go = (seen >= least - margin) & ~done
            if hop < HOPS:
                open_ = np.where(done, -np.inf, seen)
                best = np.argpartition(-open_, min(beam, n - 1), axis=1)[:, :beam]
                good = np.take_along_axis(open_, best, 1) > -np.inf
                go[np.repeat(lane, best.shape[1])[good.ravel()], best.ravel()[good.ravel()]] = True
            row, vertex = np.nonzero(go)
            if not len(row):
                break
            done[row, vertex] = True
            size = start[vertex + 1] - start[vertex]
            into = flat[np.repeat(start[vertex] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            cell = np.unique(np.repeat(row, size) * n + into)
            row, into = cell // n, cell % n
            fresh = np.isneginf(seen[row, into])
            row, into = row[fresh], into[fresh]
            seen[row, into] = np.einsum("pd,pd->p", x[some[row]], x[into])
        row, vertex = np.nonzero(seen >= least)
        keep = vertex != some[row]
        yield some[row[keep]], vertex[keep]


def exact_search(x: np.ndarray, queries: np.ndarray, least: float = LEAST_COSINE):
    """The same by a block-wise scan of all vectors."""
    for at in range(0, len(queries), _BLOCK):
        some = queries[at:at + _BLOCK]
        row, vertex = np.nonzero(x[some] @ x.T >= least)
        keep = vertex != some[row]
        yield some[row[keep]], vertex[keep]


def search_shard(x: np.ndarray, lists: list[np.ndarray], queries: np.ndarray, least: float = LEAST_COSINE):
    """Links of the shard's queries by the audited search; see the module's step 6."""
    audit = queries[::AUDIT_EVERY]
    truth = sum(len(v) for _, v in exact_search(x, audit, least))
    for beam, margin in ((BEAM, MARGIN), (4 * BEAM, 3 * MARGIN)):
        found = sum(len(v) for _, v in range_search(x, lists, audit, beam, margin, least))
        if found >= LEAST_RECALL * truth:
            return range_search(x, lists, queries, beam, margin, least)
    return exact_search(x, queries, least)


def link_vectors(table: DataFrame, key: str = "vec_id", vector: str = "embedding", least: float = LEAST_COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every vector."""
    rows = table.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    finite = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    usable = F.coalesce(F.col("embedding").isNotNull() & finite & F.exists("embedding", lambda v: v != 0), F.lit(False))
    plain = F.transform("embedding", lambda v: v.cast("double") + F.lit(0.0))  # -0.0 and 0.0 are one
    rows = rows.select("vec_id", F.when(usable, plain).alias("vec"))
    classes = rows.where("vec is not null").groupBy("vec").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))
    classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "vector_classes")
    widths = classes.groupBy(F.size("vec").alias("w")).agg(F.count("*").alias("n")).where("n > 1").orderBy("w").collect()  # a row a length
    linked = classes.select("cls", "low", "copies").limit(0).select("cls", F.col("copies").alias("n"), F.col("low").alias("component_id"))
    for row in widths:  # only vectors of one length link
        linked = linked.unionAll(_link_classes(classes.where(F.size("vec") == row["w"]).select("cls", "vec", "copies"), classes, least))
    named = (classes.join(linked, "cls", "left")
             .select("vec", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                     F.coalesce("component_id", "low").alias("component_id")))
    out = rows.join(named, "vec", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("vec").isNotNull(), F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _link_classes(vectors: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """(cls, n linked vectors outside the class, component_id) of classes with links."""
    truth, places = _audit(vectors, least), 2
    while True:
        found = _search_shards(deal_shards(vectors, places), least)
        if recall(found, truth) >= LEAST_RECALL or places >= MAX_CENTROIDS:
            break
        places *= 2
    labels = connected_components(found.where("cls != mate").select(F.col("cls").alias("a"), F.col("mate").alias("b")))
    labels = labels.withColumnsRenamed({"node": "cls"})
    lowest = labels.join(classes.select("cls", "low"), "cls").groupBy("component").agg(F.min("low").alias("component_id"))
    of_class = labels.join(lowest, "component").select("cls", "component_id")
    return found.groupBy("cls").agg(F.sum("n").alias("n")).join(of_class, "cls")


def _audit(vectors: DataFrame, least: float) -> DataFrame:
    """(cls, links) of a fixed part of the classes, by a scan of every vector."""
    some = vectors.orderBy(F.xxhash64("cls")).limit(AUDIT).select("cls", "vec").collect()
    names, queries = np.array([r["cls"] for r in some], dtype=np.int64), unit([r["vec"] for r in some])

    def scan(frames):
        links = np.zeros(len(names), dtype=np.int64)
        for f in frames:
            x, cls, copies = unit(f["vec"]), f["cls"].to_numpy(), f["copies"].to_numpy()
            for at in range(0, len(x), _BLOCK):
                near = (queries @ x[at:at + _BLOCK].T >= least) & (names[:, None] != cls[at:at + _BLOCK])
                links += near @ copies[at:at + _BLOCK]
        yield pd.DataFrame({"cls": names, "links": links})

    return materialize(vectors.mapInPandas(scan, "cls long, links long").groupBy("cls").agg(F.sum("links").alias("links")), "audit")


def recall(found: DataFrame, truth: DataFrame) -> float:
    """Share of the audited links that were found."""
    met = found.groupBy("cls").agg(F.sum("n").alias("n"))
    row = truth.join(met, "cls", "left").agg(F.sum("links").alias("all"), F.sum(F.least("links", F.coalesce("n", F.lit(0)))).alias("met")).collect()[0]
    return row["met"] / row["all"] if row["all"] else 1.0


def _search_shards(dealt: DataFrame, least: float) -> DataFrame:
    """(cls, n, mate) for every class and shard; a link counts at both ends, in the first shard that both ends are in."""
    dealt = materialize(dealt.withColumn("code", F.xxhash64("shard")), "shards")
    every = dealt.groupBy("cls").agg(F.collect_set("code").alias("codes"))
    shards = materialize(dealt.join(every, "cls").withColumn("earlier", F.filter("codes", lambda c: c < F.col("code"))).drop("codes"), "shards")

    def build(f: pd.DataFrame) -> pd.DataFrame:
        names = f["cls"].to_numpy()
        lists = _both_ways(build_graph(unit(f["vec"])))
        return pd.DataFrame({"cls": names, "near": [names[a] for a in lists]})

    graph = (shards.groupBy("shard").applyInPandas(build, "cls long, near array<long>")
             .groupBy("cls").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    graph = materialize(graph, "graph")

    def search(f: pd.DataFrame) -> pd.DataFrame:
        names, copies = f["cls"].to_numpy(), f["copies"].to_numpy()
        order = np.argsort(names)
        lists = []
        for near in f["near"]:
            near = np.asarray(near, dtype=np.int64)
            at = np.minimum(np.searchsorted(names, near, sorter=order), len(names) - 1)
            at = order[at]
            lists.append(at[names[at] == near])
        x, n = unit(f["vec"]), len(names)
        links, label = np.zeros(n, dtype=np.int64), np.arange(n)
        earlier = _members(f["earlier"].tolist())

        def root(i):
            while label[i] != i:
                label[i] = label[label[i]]
                i = label[i]
            return i

        # What one end meets counts at the other end too; an exact scan meets both ways by itself.
        met = np.zeros((n, n), dtype=bool) if n <= 2 * MAX_SHARD else None
        everyone = np.arange(n)
        pairs = exact_search(x, everyone, least) if met is None else search_shard(x, lists, everyone, least)
        for query, vertex in pairs:
            own = _apart(earlier, query, vertex)
            query, vertex = query[own], vertex[own]
            if met is None:
                np.add.at(links, query, copies[vertex])
            else:
                met[query, vertex] = met[vertex, query] = True
            for a, b in zip(query.tolist(), vertex.tolist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    label[max(a, b)] = min(a, b)
        if met is not None:
            for at in range(0, n, _BLOCK):
                links[at:at + _BLOCK] = met[at:at + _BLOCK] @ copies
        group = names[[root(i) for i in range(n)]]
        kept = f["home"].to_numpy() | (group != names) | (links > 0)
        return pd.DataFrame({"cls": names, "n": links, "mate": group})[kept]

    return materialize(shards.join(graph, "cls").groupBy("shard").applyInPandas(search, "cls long, n long, mate long"), "links")


def _members(sets: list) -> np.ndarray:
    """One row for each set, one column for each code of any, 1 where the set has it."""
    codes = np.unique(np.concatenate([np.asarray(s, dtype=np.int64) for s in sets])) if sets else np.empty(0, np.int64)
    out = np.zeros((len(sets), len(codes)), dtype=np.float32)
    for row, s in zip(out, sets, strict=True):
        row[np.searchsorted(codes, np.asarray(s, dtype=np.int64))] = 1
    return out


def _apart(members: np.ndarray, query: np.ndarray, vertex: np.ndarray) -> np.ndarray:
    """Whether the sets of the two have nothing in common; queries come a block at a time."""
    some, lane = np.unique(query, return_inverse=True)
    return (members[some] @ members.T)[lane, vertex] == 0
