"""Ranked lexical search by bag deduplication.

1. Items in blocks of at most ``BLOCK_ITEMS``: only the block's distinct terms, its vocabulary,
   are searched in the texts.
2. One pass over the texts restricts each document to its bag: the counts of the vocabulary's
   terms, beside the number of all its terms. Sums over all bags give N, L and every df.
3. A score depends on the document's bag and its integer m alone. So documents with the same m and
   bag are one class: classes are met by a 64-bit hash and verified by the whole m and bag, and
   keep their smallest doc_id. Copies are summed up before the shuffle, so a group with a
   third of all documents is no hot spot.
4. Every class is scored once, in 64-bit integers; a task keeps ``k`` classes for each item, by score
   and smallest doc_id, which no result outside can beat: each of them holds a document before it.
5. The ``k`` classes of an item left over all tasks are expanded to their members, by hash and verified
   again, ascending doc_id, of which at most ``k`` a class and item are taken before the shuffle.

To the driver go a block's item texts and N, L and the df of its vocabulary, never documents.

Edge cases: null and empty texts have no terms and are in no result, nor in N; an item without terms,
or whose terms no document holds, gives no rows; very long texts are read whole, piece by piece; repeated
rows are documents of their own and count each; a null doc_id comes last among equal scores; ties of
score go to the smaller doc_id, equal ones in any order; an empty table of documents or items gives no rows; extra
columns are ignored, whatever their names; a repeated or null item_id is answered for each of its rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barflow.llm.common import lower_ascii, pieces
from barflow.llm.lm_score import pack, unpack
from barflow.session import materialize

K = 10
BLOCK_ITEMS = 2000
# Classes that are scored at once.
BLOCK_CLASSES = 256

_TERM = re.compile("[0-9a-z\u0080-\U0010ffff]+")


def terms_of(text: str | None) -> Iterator[list[str]]:
    """The terms of a whole text, a piece at a time."""
    for piece in pieces(lower_ascii(text), _TERM):
        yield _TERM.findall(piece)


def read_bags(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """(doc_id, n, terms, counts): places in the vocabulary ascending and their counts, as packed arrays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.__contains__
        for batch in batches:
            sizes, places, counts = [], [], []
            for text in batch.column(1).to_pylist():
                n, bag = 0, Counter()
                for terms in terms_of(text):
                    n += len(terms)
                    bag.update(filter(known, terms))
                found = sorted((vocabulary[t], c) for t, c in bag.items())
                sizes.append(n)
                places.append(pack(np.array([p for p, _ in found], dtype=np.int64)))
                counts.append(pack(np.array([c for _, c in found], dtype=np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(places, pa.binary()), pa.array(counts, pa.binary())],
                                             names=["doc_id", "n", "terms", "counts"])

    return docs.mapInArrow(run, "doc_id bigint, n bigint, terms binary, counts binary")


def document_frequencies(bags: DataFrame, size: int) -> np.ndarray:
    """df of every term of the vocabulary; a task sends one row for each term it met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                total[unpack(raw)] += 1
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], names=["term", "df"])

    rows = bags.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, dtype=np.int64)
    out[rows.column("term").to_numpy()] = rows.column("df").to_numpy()
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


def best_classes(classes: DataFrame, item_terms: list[np.ndarray], weights: np.ndarray, k: int) -> DataFrame:
    """(item, score, class columns): the k classes of every item and task, by score and first doc_id.

    ``item_terms``: of each item, its distinct terms' places in the vocabulary.
    """
    size = len(weights)
    # The items of a term stand back to back in ``items``; term t has those from starts[t] to starts[t + 1].
    of_term = np.concatenate([np.empty(0, dtype=np.int64), *item_terms])
    order = np.argsort(of_term, kind="stable")
    items = np.repeat(np.arange(len(item_terms)), [len(t) for t in item_terms])[order]
    starts = np.searchsorted(of_term[order], np.arange(size + 1))

    def scores(m: np.ndarray, terms: list[np.ndarray], counts: list[np.ndarray]) -> np.ndarray:
        per = [len(t) for t in terms]
        term, tf = np.concatenate(terms).astype(np.int64), np.concatenate(counts).astype(np.int64)
        row = np.repeat(np.arange(len(terms)), per)
        part = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
        wide = starts[term + 1] - starts[term]
        at = np.repeat(starts[term] - np.cumsum(wide) + wide, wide) + np.arange(wide.sum())
        out = np.zeros(len(terms) * len(item_terms), dtype=np.int64)
        np.add.at(out, np.repeat(row, wide) * len(item_terms) + items[at], np.repeat(part, wide))
        return out.reshape(len(terms), len(item_terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # For each item the kept classes: (-score, id is null, id, row), and the rows by number.
        kept: list[list[tuple]] = [[] for _ in item_terms]
        for batch in batches:
            for first in range(0, batch.num_rows, BLOCK_CLASSES):
                part = batch.slice(first, BLOCK_CLASSES)
                rows = part.to_pylist()
                found = scores(part.column("m").to_numpy(), [unpack(r["terms"]) for r in rows], [unpack(r["counts"]) for r in rows])
                ids = [(r["first"] is None, r["first"] or 0) for r in rows]
                for item in np.flatnonzero(found.max(axis=0) > 0).tolist():
                    column = found[:, item]
                    least = max(1, -kept[item][-1][0]) if len(kept[item]) == k else 1
                    some = np.flatnonzero(column >= least)
                    if len(some):
                        kept[item] += [(-s, *ids[r], n, rows[r]) for n, (r, s) in enumerate(zip(some.tolist(), column[some].tolist(), strict=True))]
                        kept[item] = sorted(kept[item], key=lambda x: x[:3])[:k]
        out = [(item, -found[0], found[4]) for item, those in enumerate(kept) for found in those]
        for first in range(0, len(out), 10_000):
            some = out[first:first + 10_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in some], pa.int32()), pa.array([x[1] for x in some], pa.int64()),
                 *(pa.array([x[2][c] for x in some], t) for c, t in (("key", pa.int64()), ("first", pa.int64()), ("m", pa.int64()),
                                                                    ("terms", pa.binary()), ("counts", pa.binary())))],
                names=["item", "score", "key", "first", "m", "terms", "counts"])

    return classes.select("key", "first", "m", "terms", "counts").mapInArrow(
        run, "item int, score bigint, key bigint, first bigint, m bigint, terms binary, counts binary")


def search_block(docs: DataFrame, items: list[tuple], item_type: str, k: int) -> DataFrame:
    """(item_id, rank, doc_id, score) for the items (item_id, text) of one block."""
    spark = docs.sparkSession
    texts = [sorted({t for terms in terms_of(text) for t in terms}) for _, text in items]
    vocabulary = {t: i for i, t in enumerate(sorted({t for terms in texts for t in terms}))}
    item_terms = [np.array([vocabulary[t] for t in terms], dtype=np.int64) for terms in texts]
    bags = materialize(read_bags(docs, vocabulary), "bags")
    n_docs, length = bags.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    weights = term_weights(document_frequencies(bags, len(vocabulary)), n_docs)
    m = F.lit(10) + F.expr(f"(90 * n * {n_docs}L) div {length or 1}L")
    named = (bags.where(F.octet_length("terms") > 1).withColumn("m", m.cast("long"))
             .withColumn("key", F.xxhash64("m", "terms", "counts")))
    same = ["key", "m", "terms", "counts"]
    classes = named.groupBy(*same).agg(F.min("doc_id").alias("first"))
    of_item = Window.partitionBy("item")
    best = best_classes(classes, item_terms, weights, k)
    rank = F.row_number().over(of_item.orderBy(F.desc("score"), F.asc_nulls_last("first"), "key"))
    best = materialize(best.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank", "first"), "best_classes")
    # At most k x BLOCK_ITEMS hashes; what passes by chance is told apart by the whole class.
    some = named.join(F.broadcast(best.select("key").distinct()), "key", "left_semi")
    in_class = F.row_number().over(Window.partitionBy(*same).orderBy(F.asc_nulls_last("doc_id")))
    members = some.select("doc_id", *same, in_class.alias("place")).where(F.col("place") <= k)
    place = F.row_number().over(of_item.orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    found = members.join(best, same).select("item", "score", "doc_id", place.alias("rank")).where(F.col("rank") <= k)
    ids = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], f"item int, item_id {item_type}")
    return found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")  # at most BLOCK_ITEMS rows


def search(docs: DataFrame, items: DataFrame, k: int = K, block: int = BLOCK_ITEMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of every item with the highest scores above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    item_type = items.schema["item_id"].dataType.simpleString()
    out, part = None, []

    def add(out: DataFrame | None, part: list[tuple]) -> DataFrame:
        found = search_block(docs, part, item_type, k)
        return found if out is None else out.unionAll(found)

    for row in items.select("item_id", "text").toLocalIterator():
        part.append((row["item_id"], row["text"]))
        if len(part) == block:
            out, part = add(out, part), []
    if part:
        out = add(out, part)
    if out is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id long, score long")
    return out
