import math
import re
from collections import Counter

from barflow.llm import lm_score as L
from barflow.llm import queries

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def model(texts, index, size):
    pairs, first = Counter(), Counter()
    for t in texts:
        row = [1, *(index.get(w, 0) for w in words(t)), 1]
        pairs.update(zip(row, row[1:]))
    single = Counter()
    for (a, b), n in pairs.items():
        single[b] += n
        first[a] += n
    total, kinds = sum(single.values()), len(single)
    follow = Counter(a for a, _ in pairs)

    def loss(a, b):
        uni = (single[b] + kinds / size) / (total + kinds) if total else 1 / size
        return -math.log((pairs[a, b] + follow[a] * uni) / (first[a] + follow[a]) if first[a] else uni)

    return loss


def brute(docs, target, n_words):
    count = Counter(w for _, t in docs for w in words(t)) + Counter(w for t in target for w in words(t))
    top = sorted(sorted(count, key=lambda w: (-count[w], w))[:n_words])
    index = {w: k + 2 for k, w in enumerate(top)}
    size = len(top) + 2
    a, b = model(target, index, size), model([t for _, t in docs], index, size)
    out = []
    for doc, text in docs:
        row = [1, *(index.get(w, 0) for w in words(text)), 1]
        n = len(row) - 2
        la, lb = (sum(m(x, y) for x, y in zip(row, row[1:])) / (n + 1) if n else 0.0 for m in (a, b))
        out.append((doc, n, la, lb, la - lb))
    return sorted(out, key=lambda r: (str(r[0]), r[1]))


def same(got, want):
    got = sorted((tuple(r) for r in got), key=lambda r: (str(r[0]), r[1]))
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert all(abs(x - y) < 1e-4 for a, b in zip(got, want) for x, y in zip(a[2:], b[2:]))


def test_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    same(queries.op7_lm_score(spark, sf).collect(), brute(docs, target, L.WORDS))
    same(L.score_documents(queries.documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"), words=30).collect(), brute(docs, target, 30))


def test_edge_cases(spark):
    rows = [(1, "The cat the dog"), (2, None), (3, ""), (None, "a b"), (1, "The cat the dog"), (4, "the é cat " * 9000)]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n long")
    target = spark.createDataFrame([("the cat",), (None,)], "text string")
    same(L.score_documents(docs, target).collect(), brute(rows, ["the cat", None], L.WORDS))
    same(L.score_documents(docs, target.limit(0)).collect(), brute(rows, [], L.WORDS))
    assert L.score_documents(docs.limit(0), target).count() == 0


def test_model_grows_with_the_corpus(spark, monkeypatch):
    """Every word is told apart, over many blocks and buckets and with words that are dealt by both words."""
    monkeypatch.setattr(L, "BLOCK", 3000)
    monkeypatch.setattr(L, "BUCKET", 5000)
    monkeypatch.setattr(L, "HOT", 8)
    rows = [(k, " ".join(f"w{k * 31 + j} the v{j * k % 97}" for j in range(60))) for k in range(40)] + [(7, "w7 w8"), (None, None)] * 2
    target = ["w1 the w2", " ".join(f"w{j}" for j in range(0, 500, 3)), None]
    assert len({w for _, t in rows for w in words(t)}) > 1022
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = L.score_documents(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    same(got.collect(), brute(rows, target, None))
