"""Exact n-gram Jaccard join by set-relation skipping.

Two documents link if their sets of word 5-shingles have a Jaccard similarity of at
least 0.75. Every link between different sets is found:

1. Sets: one pass over the texts gives each document's set size and a 64-bit key of
   its set. Documents with equal sizes and keys are one class; from here on a class is handled once.
2. Index: shingles are ordered globally, the most repeated last, then by hash. Two
   sets that link share a shingle among the first ``n - ceil(0.75 n) + 1`` of each, so
   only those are indexed, with set size and position. Last come the shingles of passages that documents of all sizes share,
   counted in one class of ``HEADS`` among those that would be indexed by hash alone, and the shingles that repeat most often
   inside blocks of texts, as those of large groups of near copies do. They leave the index, so they bring no
   documents together. (Any order gives the same links; it only decides how long the lists are.)
3. Clusters: lists of one class are dropped, and entries that no neighbour in size can link with make no member. A list's pivot
   is its least class; the classes of all lists with one pivot are a cluster, one row a class however many lists it shares. Near copies
   share most of their lists, so they are together in few clusters, and two sets that link are together in one at least.
4. Units: a cluster is compared in one task; one that is too large is cut by sizes, and then into blocks, each two of which meet.
5. Counts first: by the indexed shingles alone (those of lists of several classes), only the members stay that share with another
   as many of them as a link needs. Sets are read and moved for these only.
6. Inside a unit the sets are taken by size. Its exact counts order the shingles again, the rarest first; a set meets the earlier ones
   with which it shares some of the first, is compared first with those that share most, and whole parts are skipped: those out of the size ratio,
   those whose shared first shingles leave no room for the overlap a link needs, and all sets of a component that it has joined,
   whose answers it takes over. The others are compared in exact counts. What comes out is fewer links than there are sets.
7. Components of all links by min-label propagation, on classes, then members.

No list of pairs is stored: what is moved grows with the classes in clusters. No text is kept for the driver.

Edge cases: null, empty and word-less texts have size 0, link with nothing and are
their own component; texts with fewer words than a shingle are one shingle; a text without an id
takes part like any other, also between two others, and has a null component if no linked text has
an id; repeated rows (same id and text) are one class and are all returned; ties do not occur, as a component's name is its least id; very long texts are read whole; an empty
table gives no rows; extra columns are ignored (``one_of_each`` returns them), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barflow.llm.common import giving_back
from barflow.llm.components import connected_components
from barflow.llm.shingles import blocks, mix64, shingle_sets
from barflow.session import materialize

SIZE = 5
PERCENT = 75
# The order of shingles counts them in the heads of one class in ``HEADS`` and knows those that at least ``LEAST_REPEATED`` of them
# have, the ``MAX_REPEATED`` most repeated at most (8 bytes each to every task). What it does not know costs longer lists only.
HEADS, LEAST_REPEATED, LEAST_STEPS, MAX_REPEATED, MAX_COPIED = 8, 3, 3, 100_000, 50_000
# A unit of a cluster holds at most two blocks of so many sets and shingles (a larger set is a block by itself).
BLOCK_SETS, BLOCK_SHINGLES = 4000, 500_000
# Bound of the filter that finds the texts of candidate sets (8 bytes each).
MAX_FILTER_WORDS = 1 << 21
_KEY = np.uint64(0xA24BAED4963EE407)


def set_keys(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A 64-bit key of each set of shingles (a sum over its members, so in any order)."""
    out = np.zeros(len(counts), dtype=np.uint64)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(mix64(values ^ _KEY), starts)
    return out.view(np.int64)


def prefix_sizes(counts: np.ndarray, percent: int) -> np.ndarray:
    """How many of a set's shingles, in the global order, are indexed."""
    return counts - -(-percent * counts // 100) + 1


def read_sets(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Rows of two kinds in one pass. 0: (id, n, key, head): set size, set key, and for one class in ``HEADS`` the least shingles by
    value, as many as are indexed (null for the others, and for copies inside a block). 1: (null, repeats in a block, shingle, null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for first, part in blocks(batch.column(1).to_pylist()):
                values, counts = shingle_sets(part, size)
                keys = set_keys(values, counts)
                once = np.zeros(len(part), dtype=bool)
                once[np.unique(keys, return_index=True)[1]] = True
                starts, wanted = np.cumsum(counts) - counts, prefix_sizes(counts, percent)
                some = once & (counts > 0) & (keys.view(np.uint64) % np.uint64(HEADS) == 0)
                heads = [values[s:s + w].tobytes() if h else None for h, s, w in zip(some.tolist(), starts.tolist(), wanted.tolist(), strict=True)]
                shingles, seen = np.unique(values[np.repeat(once, counts)], return_counts=True)
                shingles, seen = shingles[seen > 1], seen[seen > 1]
                more = len(shingles)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array([0, 1], dtype=np.int32), [len(part), more])),
                     pa.concat_arrays([ids.slice(first, len(part)).cast(pa.int64()), pa.nulls(more, pa.int64())]),
                     pa.array(np.concatenate([counts, seen]).astype(np.int64)), pa.array(np.concatenate([keys, shingles.view(np.int64)])),
                     pa.array([*heads, *[None] * more], pa.binary())], names=["kind", "id", "n", "key", "head"])

    return docs.mapInArrow(giving_back(run), "kind int, id bigint, n bigint, key bigint, head binary")


def repeated_shingles(read: DataFrame, percent: int) -> np.ndarray:
    """The shingles that come last in the order: first those that classes of ``LEAST_STEPS`` or more ranges of size have, counted in the
    heads of one class in ``HEADS`` (sets of a range are within the size ratio of a link; a passage stands in texts of all
    sizes, most of which cannot link); then the ``MAX_COPIED`` that repeat most often inside blocks of texts, the most repeated last.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(0).to_pylist()
            values = np.frombuffer(b"".join(raw), dtype=np.int64)
            step = (np.log(batch.column(1).to_numpy()) / np.log(100.0 / percent)).astype(np.int64) % 63
            steps = np.repeat(np.int64(1) << step, [len(h) // 8 for h in raw])
            order = np.argsort(values, kind="stable")
            values, first, n = np.unique(values[order], return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(n), pa.array(np.bitwise_or.reduceat(steps[order], first))], names=["shingle", "n", "steps"])

    heads = read.where("head is not null").groupBy("key").agg(F.first("head").alias("head"), F.first("n").alias("n"))  # equal keys, equal heads
    counted = (heads.select("head", "n").mapInArrow(run, "shingle bigint, n bigint, steps bigint")
               .groupBy("shingle").agg(F.sum("n").alias("n"), F.bit_count(F.bit_or("steps")).alias("steps")))
    counted = materialize(counted.where((F.col("n") >= LEAST_REPEATED) & (F.col("steps") >= LEAST_STEPS)), "repeated_shingles")
    # The least count of which all fit.
    how_many, least = 0, None
    for row in counted.groupBy("n").agg(F.count("*").alias("shingles")).orderBy(F.desc("n")).limit(MAX_REPEATED).toLocalIterator():
        how_many += row["shingles"]
        if how_many > MAX_REPEATED:
            break
        least = row["n"]
    passages = np.empty(0, dtype=np.int64)
    if least is not None:
        passages = np.sort(counted.where(F.col("n") >= least).select("shingle").toArrow().column(0).to_numpy())  # at most MAX_REPEATED
    copied = (read.where("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key")
              .limit(MAX_COPIED).collect())  # at most MAX_COPIED rows
    copied = np.array([r["key"] for r in reversed(copied)], dtype=np.int64)
    return np.concatenate([passages[~np.isin(passages, copied)], copied]).view(np.uint64)


def least_overlap(a, b, percent: int = PERCENT):
    """Least common members of sets of sizes a and b that link."""
    return -(-percent * (a + b) // (100 + percent))


def index_entries(docs: DataFrame, size: int, percent: int, repeated: np.ndarray) -> DataFrame:
    """(shingle, key, place): the indexed shingles of every class, place = set size << 32 | position.

    ``repeated`` are shingles in the order in which they come last.
    """
    by_value = np.argsort(repeated)
    values_sorted = repeated[by_value]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for _, part in blocks(batch.column(0).to_pylist()):
                values, counts = shingle_sets(part, size)
                keys = set_keys(values, counts)
                fresh = np.zeros(len(part), dtype=bool)
                for i, key in enumerate(keys.tolist()):
                    fresh[i] = counts[i] > 0 and key not in done
                    done.add(key)
                if len(done) > 1_000_000:  # only spares copies within the task
                    done.clear()
                owner = np.repeat(np.arange(len(part)), counts)
                rank = np.zeros(len(values), dtype=np.int64)
                if len(repeated):
                    at = np.minimum(np.searchsorted(values_sorted, values), len(repeated) - 1)
                    rank = np.where(values_sorted[at] == values, by_value[at] + 1, 0)
                order = np.lexsort((values, rank, owner))
                values = values[order]
                position = np.arange(len(values)) - np.repeat(np.cumsum(counts) - counts, counts)
                take = (position < prefix_sizes(counts, percent)[owner]) & fresh[owner]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values[take].view(np.int64)), pa.array(keys[owner[take]]),
                     pa.array((counts[owner[take]] << 32) | position[take])], names=["shingle", "key", "place"])

    return docs.select("text").mapInArrow(giving_back(run), "shingle bigint, key bigint, place bigint")


def may_link(one: Column, other: Column, percent: int) -> Column:
    """Whether sizes and positions of two entries of a list leave room for the overlap a link needs."""
    n, m = (F.shiftright(x, 32) for x in (one, other))
    left, right = (F.shiftright(x, 32) - x.bitwiseAND(2**32 - 1) for x in (one, other))
    needed = F.ceil(percent * (n + m) / (100 + percent))
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.least(left, right) >= needed)


def shared_entries(entries: DataFrame, percent: int) -> DataFrame:
    """(shingle, key, n, pivot): one entry a class and list, of lists of several classes; the pivot is the list's least class.

    It is null for an entry that no other of the list can be the first to link with: in a list sorted by size the neighbours are the
    nearest in size, so an entry with none of them within the size ratio has no partner; in a list of two the positions
    decide as well.
    """
    beside = Window.partitionBy("shingle")
    row = beside.orderBy("place", "key")
    once = entries.withColumn("before", F.lag("key").over(row)).where("before is null or before != key").drop("before")
    around = once.select("*", F.lag("place").over(row).alias("below"), F.lead("place").over(row).alias("above"),
                         F.count("*").over(beside).alias("n")).where("n > 1")
    size = F.shiftright("place", 32)
    near = ((100 * F.shiftright("below", 32) >= percent * size) | (100 * size >= percent * F.shiftright("above", 32)))
    pair = may_link(F.col("place"), F.coalesce("below", "above"), percent)
    useful = F.coalesce(F.when(F.col("n") == 2, pair).otherwise(near), F.lit(False))
    return (around.select("shingle", "key", size.alias("n"), useful.alias("useful"))
            .select("shingle", "key", "n", F.when(F.col("useful"), F.min(F.when(F.col("useful"), F.col("key"))).over(beside)).alias("pivot")))


def _slots(ids: np.ndarray, words: int) -> list[np.ndarray]:
    return [mix64(ids.view(np.uint64) ^ np.uint64(salt)) & np.uint64(64 * words - 1) for salt in (1, 2, 3)]


def _passes(wanted: np.ndarray, words: int, ids: np.ndarray) -> np.ndarray:
    out = np.ones(len(ids), dtype=bool)
    for slot in _slots(ids, words):
        out &= (wanted[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return out


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bloom filter of the column ``id``: 16 bits an id, at most ``MAX_FILTER_WORDS`` 64-bit words.

    With more ids than that it lets more others through, which costs time only.
    """
    words = 1 << max(4, (ids.count() // 4).bit_length())
    words = min(words, MAX_FILTER_WORDS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(words, dtype=np.uint64)
        for batch in batches:
            for slot in _slots(batch.column(0).to_numpy(zero_copy_only=False), words):
                np.bitwise_or.at(bits, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(bits[used].view(np.int64))], names=["word", "bits"])

    rows = ids.select("id").mapInArrow(build, "word bigint, bits bigint").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, dtype=np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def sets_of(docs: DataFrame, size: int, wanted: np.ndarray) -> DataFrame:
    """(key, members) of the documents whose id passes the filter, without copies inside a task; members are 64-bit hashes, ascending."""
    words = len(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            # Rows without an id cannot be told by it and are all read.
            unnamed = pa.compute.is_null(batch.column(0)).to_numpy(zero_copy_only=False)
            ids = pa.compute.fill_null(batch.column(0), 0).to_numpy(zero_copy_only=False)
            for _, part in blocks(batch.filter(pa.array(unnamed | _passes(wanted, words, ids))).column(1).to_pylist()):
                values, counts = shingle_sets(part, size)
                keys = set_keys(values, counts).tolist()
                ends = np.cumsum(counts)
                fresh = [i for i, key in enumerate(keys) if counts[i] and key not in done and not done.add(key)]
                if len(done) > 1_000_000:
                    done.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in fresh], pa.int64()),
                     pa.array([values[ends[i] - counts[i]:ends[i]].tobytes() for i in fresh], pa.binary())], names=["key", "members"])

    return docs.select("doc_id", "text").mapInArrow(run, "key bigint, members binary")


def deal_clusters(clusters: DataFrame, percent: int) -> DataFrame:
    """(pivot, band, one, two, side, guest, n, key): the classes of each unit, one row a class and unit.

    A cluster of at most ``BLOCK_SETS`` sets and ``BLOCK_SHINGLES`` shingles is one unit. A larger one is cut into bands
    of sizes with the same logarithm to the base 100 / percent: a set links only into its own band and the next, so it goes to its
    own and, as a guest, to the next smaller one. A band that is still too large is cut into blocks, and each two of them are a unit.
    """

    def parts(*by: str) -> Column:
        whole = Window.partitionBy(*by)
        return F.greatest(F.ceil(F.count("*").over(whole) / BLOCK_SETS), F.ceil(F.sum("n").over(whole) / BLOCK_SHINGLES))

    own = F.floor(F.log("n") / float(np.log(100.0 / percent)) + 1e-9)
    banded = (clusters.select("*", parts("pivot").alias("parts"), own.alias("own"))
              .select("pivot", "key", "n", "own", F.explode(F.when(F.col("parts") == 1, F.array(F.lit(-2).cast("long"))).otherwise(F.array("own", F.col("own") - 1))).alias("band")))
    cut = banded.select("*", parts("pivot", "band").alias("parts")).withColumn("side", F.pmod(F.xxhash64("key"), "parts"))
    return (cut.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("with"))
            .select("pivot", "band", F.least("side", "with").alias("one"), F.greatest("side", "with").alias("two"), "side",
                    ((F.col("band") != -2) & (F.col("band") != F.col("own"))).alias("guest"), "n", "key"))


def meetings(ids: np.ndarray, owner: np.ndarray, many: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, others): for each of ``many`` owners the earlier ones, once for each id that they share, if there are any."""
    listed = np.lexsort((owner, ids))
    of, who = ids[listed], owner[listed]
    begin = np.flatnonzero(np.append(True, of[1:] != of[:-1])) if len(of) else np.empty(0, dtype=np.int64)
    begin = np.repeat(begin, np.diff(np.append(begin, len(of))))
    mine = np.argsort(who, kind="stable")  # the entries of each owner
    upto = np.searchsorted(who[mine], np.arange(many + 1))
    for i in range(many):
        at = mine[upto[i]:upto[i + 1]]
        before = at - begin[at]  # what stands before an entry came earlier
        if total := int(before.sum()):
            yield i, who[np.repeat(begin[at] - (np.cumsum(before) - before), before) + np.arange(total)]


def with_room(i: int, others: np.ndarray, n: np.ndarray, sides: np.ndarray, guests: np.ndarray, crossing: bool, percent: int) -> np.ndarray:
    """The distinct ``others`` (one for each shingle shared among the first of both) that may link with i, those that share most first.

    Common shingles are among the first of both sets, or behind the first of the one whose first end earlier. Two guests are
    compared in their own unit, as are, if ``crossing``, two sets of one side.
    """
    others, common = np.unique(others[100 * n[others] >= percent * n[i]], return_counts=True)
    behind = np.maximum(n[i] - prefix_sizes(n[i], percent), n[others] - prefix_sizes(n[others], percent))
    room = (common + behind >= least_overlap(n[i], n[others], percent)) & ~(guests[others] & guests[i])
    if crossing:
        room &= sides[others] != sides[i]
    return others[room][np.argsort(-common[room], kind="stable")]


def possible(n: np.ndarray, sides: np.ndarray, guests: np.ndarray, firsts: list, crossing: bool, percent: int) -> np.ndarray:
    """Which sets of a unit, given by size, may link with another, by the indexed shingles that both have."""
    out = np.zeros(len(n), dtype=bool)
    ids = np.unique(np.concatenate(firsts), return_inverse=True)[1]
    for i, others in meetings(ids, np.repeat(np.arange(len(n)), [len(f) for f in firsts]), len(n)):
        if out[i]:
            others = others[~out[others]]
        others = with_room(i, others, n, sides, guests, crossing, percent)
        if len(others):
            out[i] = out[others] = True
    return out


def spanning_links(keys: list, sides: np.ndarray, guests: np.ndarray, sets: list, crossing: bool, percent: int) -> list:
    """Links (key, key) that join the sets of one unit, given by size, to the components that all their links make.

    The unit's own order of shingles, the rarest first, brings sets together; a set that links with one of a component
    has the answers of the others, which are not compared with it.
    """
    n = np.array([len(s) for s in sets])
    many = len(n)
    starts = np.cumsum(n) - n
    distinct, ids, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    rank = np.empty(len(distinct), dtype=np.int64)
    rank[np.argsort(df, kind="stable")] = np.arange(len(distinct))
    owner = np.repeat(np.arange(many), n)
    order = np.lexsort((rank[ids], owner))
    first = order[(np.arange(len(ids)) - np.repeat(starts, n) < np.repeat(prefix_sizes(n, percent), n)) & (df[ids[order]] > 1)]
    component = np.arange(many)
    marked = np.zeros(len(distinct), dtype=bool)
    links = []
    for i, others in meetings(ids[first], owner[first], many):
        others = with_room(i, others[component[others] != component[i]], n, sides, guests, crossing, percent)
        if not len(others):
            continue
        marked[ids[starts[i]:starts[i] + n[i]]] = True
        step = 8
        while len(others):
            some, others, step = others[:step], others[step:], 4 * step
            ends = np.cumsum(n[some])
            members = ids[np.repeat(starts[some] - (ends - n[some]), n[some]) + np.arange(ends[-1])]
            shared = np.add.reduceat(marked[members].astype(np.int64), ends - n[some])
            for j in some[100 * shared >= percent * (n[i] + n[some] - shared)].tolist():
                if component[j] != component[i]:
                    component[component == component[j]] = component[i]
                    links.append((keys[j], keys[i]))
            others = others[component[others] != component[i]]
        marked[ids[starts[i]:starts[i] + n[i]]] = False
    return links


def in_units(clusters: DataFrame, values: DataFrame, percent: int, work, schema: str) -> DataFrame:
    """``work(pivot, keys, n, sides, guests, values, crossing)`` of every unit of two sets or more, given by size; it returns rows.

    ``values``: (key, value), a list or the bytes of 64-bit numbers; of several rows of a key one is taken.
    """
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, rows = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if len(rows) > 1:
                keys, n, sides, guests, held = zip(*rows, strict=True)
                found = work(unit[0], keys, np.array(n), np.array(sides), np.array(guests), held, unit[2] != unit[3])
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=names)

        for batch in batches:
            column = batch.column(batch.num_columns - 1)
            if pa.types.is_list(column.type):
                numbers, ends = column.values.to_numpy(), column.offsets.to_numpy()
                held = (numbers[a:b].copy() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True))
            else:
                held = (np.frombuffer(x.as_py(), dtype=np.uint64) for x in column)
            for *at, side, guest, n, key, value in zip(*(c.to_pylist() for c in batch.columns[:-1]), held, strict=True):
                if at != unit:
                    yield from done()
                    unit, rows = at, []
                if not rows or rows[-1][0] != key:
                    rows.append((key, n, side, guest, value))
        yield from done()

    unit = ["pivot", "band", "one", "two"]
    rows = deal_clusters(clusters, percent).join(values, "key").repartition(*unit).sortWithinPartitions(*unit, "n", "key")
    return rows.select(*unit, "side", "guest", "n", "key", "value").mapInArrow(run, schema).distinct()


def possible_members(shared: DataFrame, percent: int) -> DataFrame:
    """(pivot, key, n): the classes of all lists with one pivot (its cluster) that may link with another of them."""

    def work(pivot, keys, n, sides, guests, firsts, crossing) -> list:
        return [(pivot, keys[i], int(n[i])) for i in np.flatnonzero(possible(n, sides, guests, firsts, crossing, percent))]

    clusters = materialize(shared.where("pivot is not null").select("pivot", "key", "n").distinct(), "clusters")
    firsts = shared.groupBy("key").agg(F.collect_list("shingle").alias("value"))
    return in_units(clusters, firsts, percent, work, "pivot bigint, key bigint, n bigint")


def cluster_links(clusters: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): links enough to make the components of each unit, fewer than it has classes."""

    def work(pivot, keys, n, sides, guests, members, crossing) -> list:
        return spanning_links(keys, sides, guests, members, crossing, percent)

    return in_units(clusters, sets.withColumnRenamed("members", "value"), percent, work, "a bigint, b bigint")


def label_documents(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n, key, label, component_id) of every document: key of its set, key of a set that names its component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    read = materialize(read_sets(docs, size, percent), "sets_read")
    repeated = repeated_shingles(read, percent)
    members = read.where("kind = 0").select(F.col("id").alias("doc_id"), "n", "key")
    classes = members.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first"))
    shared = materialize(shared_entries(index_entries(docs, size, percent, repeated), percent), "index_lists")
    clusters = materialize(possible_members(shared, percent), "possible_members")
    wanted = clusters.select("key").distinct().join(classes, "key").where("first is not null")
    sets = sets_of(docs, size, id_filter(materialize(wanted.select(F.col("first").alias("id")), "wanted_ids")))
    labels = connected_components(materialize(cluster_links(clusters, sets, percent), "links"))
    named = classes.join(labels.withColumnsRenamed({"node": "key"}), "key").groupBy("component").agg(F.min("first").alias("component_id"))
    of_class = labels.withColumnsRenamed({"node": "key"}).join(named, "component").select("key", "component_id")
    found = (classes.join(of_class, "key", "left").join(labels.select(F.col("node").alias("key"), F.col("component").alias("label")), "key", "left")
             .select("key", F.coalesce("label", "key").alias("label"), F.coalesce("component_id", "first").alias("component_id")))
    return (members.join(found, "key", "left")
            .select("doc_id", "n", "key", "label", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def join_documents(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return label_documents(docs, size, percent).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Documents without those that are near copies of one with a smaller id; repeated rows become one.

    Of a component the text of the smallest id stays (of several under that id the one of the least set key; without
    ids, the one of the least key); texts without words all stay. An id whose rows have one set tells them; the rows of
    other ids, and those without an id, are told by id and set.
    """
    rows = materialize(label_documents(docs, size, percent).select("doc_id", "n", "key", "label"), "labelled")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("best")
    kept = (rows.where("n > 0").groupBy("label").agg(best).select(F.col("best.doc_id").alias("_id"), F.col("best.key").alias("_key"))
            .unionAll(rows.where("n = 0").select("doc_id", "key")).distinct())
    several = rows.groupBy("doc_id").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low != high").select(F.col("doc_id").alias("_id"))
    several = materialize(several, "ids_of_several")
    row_id = docs["doc_id"].cast("long")
    plain = (docs.join(several, row_id.eqNullSafe(several["_id"]), "left_anti"))
    plain = plain.join(kept, row_id.eqNullSafe(kept["_id"]), "left_semi")
    if several.isEmpty():
        return plain.dropDuplicates(["doc_id", "text"])
    told = with_set_key(docs.join(several, row_id.eqNullSafe(several["_id"]), "left_semi"), size)
    told = told.join(kept, F.col("row.doc_id").cast("long").eqNullSafe(kept["_id"]) & (F.col("set") == kept["_key"]), "left_semi")
    return plain.unionAll(told.select("row.*")).dropDuplicates(["doc_id", "text"])


def with_set_key(docs: DataFrame, size: int) -> DataFrame:
    """(row, set): each row as a struct and the key of its text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            keys = [set_keys(*shingle_sets(part, size)) for _, part in blocks(texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate(keys) if keys else np.empty(0, dtype=np.int64))], names=["row", "set"])

    rows = docs.select(F.struct("*").alias("row"), docs["text"].alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("set", T.LongType())]))
