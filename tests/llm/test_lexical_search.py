import math
import random
import re
from collections import Counter

import numpy as np

from barflow.llm import lexical_search as L
from barflow.llm.common import pieces

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(docs, items, k=10):
    bags = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    n_docs, length = sum(1 for _, b in bags if b), sum(sum(b.values()) for _, b in bags)
    out = []
    for item_id, text in items:
        terms = set(TERM.findall(lower(text)))
        w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * sum(t in b for _, b in bags) + 1))) for t in terms}
        scored = []
        for doc_id, bag in bags:
            n = sum(bag.values())
            m = 10 + (90 * n * n_docs) // length if length else 0
            score = sum(w[t] * ((10**9 * bag[t]) // (1000 * bag[t] + 8 * m)) for t in terms if t in bag)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out += [(item_id, r + 1, s[2], -s[0]) for r, s in enumerate(scored[:k])]
    return out


def run(spark, docs, items, **more):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    return [tuple(r) for r in L.search(d, q, **more).collect()]


def key(rows):
    return sorted(rows, key=repr)


def test_equals_brute_force_with_copies_ties_and_blocks(spark):
    rnd = random.Random(3)
    words = ["Alpha", "beta", "GAMMA", "été", "naïve", "x9", "of", "the", "a_b", "end.", "中文", "10"]
    docs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))) for i in range(150)]
    docs += [(1000 + i, "the beta of été the the") for i in range(60)]  # more copies than places
    docs += [(7, docs[7][1]), (500, None), (501, ""), (502, "... --"), (None, "beta x9")]
    items = [(1, "Beta été"), (2, "the the of X9"), (3, "nowhere"), (4, None), (5, "a b 10"), (2, "gamma"), (6, "")]
    want = key(brute(docs, items))
    assert key(run(spark, docs, items)) == want
    assert key(run(spark, docs, items, block=2)) == want
    assert key(run(spark, docs, items, k=3)) == key(brute(docs, items, 3))


def test_very_long_text_is_read_whole(spark):
    long = "filler " * 400_000 + "needle" + " filler" * 10
    docs = [(1, long), (2, "needle filler"), (3, "x" * 3_000_000), (4, "é" * 1_500_000)]
    items = [(1, "needle filler"), (2, "x" * 3_000_000)]
    assert key(run(spark, docs, items)) == key(brute(docs, items))


def test_pieces_cut_no_term():
    rnd = random.Random(5)
    for _ in range(300):
        text = "".join(rnd.choice("ab  é.") for _ in range(rnd.randint(0, 60)))
        parts = list(pieces(text, L._TERM, rnd.randint(1, 9)))
        assert "".join(parts) == text
        assert [t for p in parts for t in L._TERM.findall(p)] == L._TERM.findall(text)


def test_empty_tables_and_extra_columns(spark):
    docs = spark.createDataFrame([(1, "a b", 5, "q", 7, 9)], "doc_id int, text string, score int, terms string, item int, key int")
    items = spark.createDataFrame([("p", "B", 3)], "item_id string, text string, doc_id int")
    out = L.search(docs, items)
    assert [r.asDict() for r in out.collect()] == [{"item_id": "p", "rank": 1, "doc_id": 1, "score": brute([(1, "a b")], [("p", "B")])[0][3]}]
    assert L.search(docs.limit(0), items).collect() == []
    assert L.search(docs, items.limit(0)).columns == out.columns and L.search(docs, items.limit(0)).count() == 0


def test_weights_are_exact():
    assert L.term_weights(np.array([0, 1, 5, 9]), 10).tolist() == [math.floor(1000 * math.log(22 / d)) for d in (1, 3, 11, 19)]
