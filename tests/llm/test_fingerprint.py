import hashlib
import random

from barflow.llm import fingerprint as P
from barflow.llm.common import documents


def words(seed, n):
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice("abcdefghij") for _ in range(rnd.randint(2, 9))) for _ in range(n))


def test_equal_texts_and_blocks():
    texts = [words(1, 300), "", "aaaa", words(1, 300), "ab" * 5000, "x", words(2, 50), "é🙂" * 30]
    alone = [P.fingerprints([t])[0][1] for t in texts]
    assert [h for _, h in P.fingerprints(texts)] == alone
    assert alone[0] == alone[3] and len(set(alone)) == len(texts) - 1


def test_shared_parts_share_names_at_any_offset():
    a = words(3, 600)
    (x, _), (y, _), (z, _) = P.fingerprints([a, "some other start 123 " + a, words(4, 600)])
    assert P.likeness(x, y) > 0.95 and P.likeness(x, z) < 0.1
    half = a[len(a) // 4:]
    assert 0.6 < P.likeness(x, P.fingerprints([half])[0][0]) < 0.95
    (e, _), (f, _) = P.fingerprints(["", ""])
    assert P.likeness(e, f) == 1.0 and P.likeness(e, x) == 0.0


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    out = []
    for k, (doc, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(text) // 4
        changed = text[:len(text) - n] + after[:n]
        (a, ha), (b, hb), (c, _) = P.fingerprints([text, changed, after])
        out.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), ha, hb, P.likeness(a, b), P.likeness(a, c)))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    want = brute([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    for parts in (1, 7):
        assert sorted((tuple(r) for r in P.compare_with_edits(docs, parts).collect()), key=str) == want


def test_edge_cases(spark):
    rows = [(5, "abc" * 50), (None, "null id"), (2, None), (9, ""), (2, "tie of two"), (7, words(5, 20000)), (5, "abc" * 50)]
    docs = spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, part int, last string")
    for parts in (1, 3):
        assert sorted((tuple(r) for r in P.compare_with_edits(docs, parts).collect()), key=str) == brute(rows)
    assert P.compare_with_edits(docs.limit(0), 3).count() == 0
    assert P.compare_with_edits(docs.where("doc_id = 9"), 2).count() == 1
    assert P.fingerprint_documents(docs).count() == 7
