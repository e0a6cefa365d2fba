import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow.parquet as pq
import pytest

from barflow.llm import queries
from barflow.llm import spelling as S
from tests.conftest import SF001

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_words(docs, least=6, count=5):
    total = Counter()
    for doc_id, text in docs:
        for run in RUN.findall(text or ""):
            low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 199 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            total[low] += 1
    return {w: n for w, n in total.items() if len(w) >= least and n >= count}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_near(words):
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    return {w: [x for k in (-1, 0, 1) for x in by_length.get(len(w) + k, []) if is_near(w, x)] for w in words}


def brute(docs):
    n = brute_words(docs)
    near = brute_near(n)
    form = {}
    for w, those in near.items():
        best = min(those, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def run(spark, docs):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    return sorted((tuple(r) for r in S.spelling_variants(df).collect()), key=repr)


def crowded(rnd, n):
    """Words with many near ones: few letters, long runs of the same, common beginnings and ends."""
    out = set()
    while len(out) < n:
        w = "".join(rnd.choice("aabé") for _ in range(rnd.randint(5, 11)))
        w = rnd.choice(["", "", "ing", "inter"]) + w + rnd.choice(["", "", "tion"])
        out.add(w)
        at = rnd.randrange(len(w))
        out.add(rnd.choice([w[:at] + w[at + 1:], w[:at] + "z" + w[at:], w[:at] + "x" + w[at + 1:]]))
    return sorted(w for w in out if len(w) >= 6)


@pytest.mark.parametrize("frequent", [0, 3, 32, 10**9])
def test_untouched_grams_are_shared_by_near_words(frequent):
    words = crowded(random.Random(1), 500)
    counts = Counter(x for cls, _, letters in S.by_class(words, 6) for q, h in S.grams(letters, cls).items() for x in h.ravel().tolist())
    held = np.array([x for x, n in counts.items() if n > frequent], dtype=np.uint64)
    filled = np.zeros(1 << 14, dtype=np.uint64)
    for slot in S_slots(held, len(filled)):
        np.bitwise_or.at(filled, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
    keys = {}
    for cls, places, letters in S.by_class(words, 6):
        for i, left, right in zip(places.tolist(), *S.list_keys(letters, cls, filled), strict=True):
            keys[words[i], cls] = (int(left), int(right))
    near = brute_near(words)
    assert sum(map(len, near.values())) > 500
    for w, those in near.items():
        for x in those:
            cls = min(len(w), len(x))
            a, b = keys[w, cls], keys[x, cls]
            common = next((i for i, (p, q) in enumerate(zip(w, x)) if p != q), cls)  # noqa: B905
            assert a[0] == b[0] if common >= S.left_half(cls) - 1 else a[1] == b[1]


def S_slots(ids, words):
    from barflow.llm.jaccard import _slots

    return _slots(ids.view(np.int64), words)


@pytest.mark.parametrize("bound", [S.LIST, 3])
def test_equals_brute_force_on_crowded_words(spark, monkeypatch, bound):
    monkeypatch.setattr(S, "LIST", bound)
    rnd = random.Random(2)
    words = crowded(rnd, 500)
    often = {w: rnd.choice([1, 1, 2, 12, 90]) for w in words}
    docs = [(i, " ".join(w for w in rnd.sample(words, 200) for _ in range(often[w]))) for i in range(20)]
    docs += [(None, " ".join(words[:50])), (None, None), (90, ""), (91, "1234 -- ß×÷"), (92, "ÉCLAIRS Éclairs éclairs " * 7), docs[3], docs[3]]
    docs += [(93, ("inter" + "a" * 30 + " ") * 6 + ("inter" + "a" * 31 + ".") * 60)]
    want = brute(docs)
    assert sum(r[1] is not None for r in want) > 50 and any(r[1] != r[2] for r in want if r[1])
    assert run(spark, docs) == want


def test_given_documents(spark):
    t = pq.read_table(f"{SF001}/documents.parquet", columns=["doc_id", "text"])
    want = brute(list(zip(*(c.to_pylist() for c in t.columns), strict=True)))
    got = sorted((tuple(r) for r in queries.op11_spelling(spark, SF001).collect()), key=repr)
    assert got == want and len(want) > 300


def test_very_long_texts_and_words(spark):
    long = "abcdefghij" * 20_000
    docs = [(i, f"{long} {long[:-1]} " + "plainword " * 150_000) for i in range(5)] + [(9, long + "q")]
    assert run(spark, docs) == brute(docs)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "planet planet planet planet planet", "x", 3, 4)], "doc_id long, text string, word string, n int, list int")
    assert [tuple(r) for r in S.spelling_variants(df).collect()] == [("planet", None, "planet", 5, 0, None)]
    assert S.spelling_variants(df.limit(0)).collect() == []
