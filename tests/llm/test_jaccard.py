import random
from collections import defaultdict

import re

import pytest

from barflow.llm import jaccard as J
from barflow.llm import shingles
from barflow.llm.shingles import shingle_sets
from barflow.llm.common import documents
from barflow.session import materialize

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def sets_of(rows):
    out = []
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        out.append((doc, frozenset(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    return out


def brute(rows):
    sets = sets_of(rows)
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    lists = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        for x in s:
            lists[x].append(i)
    common = defaultdict(int)
    for many in lists.values():
        for k, a in enumerate(many):
            for b in many[:k]:
                common[b, a] += 1
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a][1]) + len(sets[b][1]) - n):
            up[root(a)] = root(b)
    least = {}
    for i, (doc, _) in enumerate(sets):
        r = root(i)
        if doc is not None:
            least[r] = min(least.get(r, doc), doc)
    return sorted(((doc, len(s), least.get(root(i))) for i, (doc, s) in enumerate(sets)), key=str)


def spark_rows(spark, rows, **kw):
    docs = spark.createDataFrame([(k, t, "x", 7) for k, t in rows], "doc_id long, text string, key string, n int").repartition(5)
    return sorted((tuple(r) for r in J.join_documents(docs, **kw).collect()), key=str)


def made(seed, n_groups, size, edits):
    """Groups of near copies with up to ``edits`` changed words, chains among them, and a passage many share."""
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(n_groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(4, 90))]
        for _ in range(rnd.randint(1, size)):
            own = list(base)
            for _ in range(rnd.randint(0, edits)):
                own[rnd.randrange(len(own))] = rnd.choice(vocabulary)
            base = own if rnd.random() < 0.2 else base
            own = own + passage if rnd.random() < 0.3 else own
            rows.append((len(rows), " ".join(own).upper() if rnd.random() < 0.1 else "  ".join(own)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = made(seed, 40, 14, 6)
    assert spark_rows(spark, rows) == brute(rows)


def test_links_beyond_the_pivot(spark, monkeypatch):
    """Chains: members that do not link with the pivot but with others, and blocks of two partners."""
    monkeypatch.setattr(J, "BLOCK_SETS", 2)
    rows = made(9, 12, 40, 3)
    assert spark_rows(spark, rows) == brute(rows)


def test_edge_cases(spark):
    long = " ".join(f"t{k}" for k in range(30000))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (9, "A  b"), (5, "a b c d e"), (6, long), (7, long + " end"), (7, long + " end"),
            (None, "only here with null id today"), (8, "  x"), (10, "a b c d e"), (10, "another text for the same id here now")]
    assert spark_rows(spark, rows) == brute(rows)
    assert spark_rows(spark, [(1, "x")]) == [(1, 1, 1)]
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert J.join_documents(docs).count() == 0


def test_table(spark):
    docs = documents(spark, "/root/testdata/sf0.001")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted((tuple(r) for r in J.join_documents(docs).collect()), key=str) == want
    kept = {r["doc_id"] for r in J.one_of_each(docs).collect()}
    assert kept == {c for _, _, c in want}


def test_blocks_of_few_words(spark):
    """A block of any number of words, in one text or in several, has the sets that the texts have by themselves."""
    words = [f"w{i}" for i in range(8)]
    for n in range(9):
        for cut in range(n + 1):
            texts = [" ".join(words[:cut]).encode(), b"", " ".join(words[cut:n]).encode()]
            values, counts = shingle_sets(texts)
            assert counts.tolist() == [max(k - 4, min(k, 1)) for k in (cut, 0, n - cut)]
            alone = [shingle_sets([t])[0].tolist() for t in texts]
            assert values.tolist() == [v for one in alone for v in one]
    rows = [(1, "one two"), (2, "three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert sorted((tuple(r) for r in J.join_documents(docs).collect()), key=str) == brute(rows)
    assert J.one_of_each(docs).count() == 2


def chain(n=60):
    """Three texts of which the first and the last link with the middle one alone."""
    words = [f"w{i}" for i in range(n)]
    return " ".join(words), " ".join([*words[:-3], "x1", "x2", "x3"]), " ".join(["y1", "y2", "y3", *words[3:-3], "x1", "x2", "x3"])


def test_a_text_without_an_id_links_two_others(spark):
    a, middle, b = chain()
    rows = [(1, a), (None, middle), (2, b), (None, "quite another text of its own here"), (5, "and one more text that is alone")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in J.join_documents(docs).collect()), key=str)
    assert got == [(1, 1), (2, 1), (5, 5), (None, 1), (None, None)]
    kept = sorted(r["text"] for r in J.one_of_each(docs).collect())
    assert kept == sorted([a, rows[3][1], rows[4][1]])


def test_one_of_each_with_ids_of_several_texts_and_clashing_columns(spark):
    a, middle, b = chain()
    other = "a text that nobody else has in this table"
    rows = [(1, a), (1, other), (3, middle), (3, "one more that is alone in here"), (4, b), (4, b), (None, a + " end"), (6, None), (6, "")]
    docs = spark.createDataFrame([(*r, 0, "k", 1, 2) for r in rows], "doc_id long, text string, n int, key string, _id int, component int")
    out = J.one_of_each(docs)
    assert out.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == sorted([(1, a), (1, other), rows[3], (6, None), (6, "")], key=str)


def test_rows_of_a_large_group_grow_with_its_members(spark, monkeypatch):
    """Texts of which many pairs are near the threshold: what is stored behind the lists is rows of members, not of pairs."""
    rnd = random.Random(4)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for doc in range(120):
        own = list(base)
        for at in rnd.sample(range(len(own)), 4):
            own[at] = f"x{doc}-{at}"
        rows.append((doc, " ".join(own)))
    stored = {}

    def counted(df, name="table"):
        out = materialize(df, name)
        stored[name] = max(out.count(), stored.get(name, 0))
        return out

    monkeypatch.setattr(J, "materialize", counted)
    assert spark_rows(spark, rows) == brute(rows)
    assert max(n for name, n in stored.items() if name not in ("sets_read", "index_lists")) <= 5 * len(rows), stored


def test_words_hashed_in_parts(monkeypatch):
    texts = [b"", b"one Two three", b"  ", b"four five six seven eight nine " * 9, b"ten"]
    whole, counts = shingles.word_hashes(texts)
    monkeypatch.setattr(shingles, "WORD_BYTES", 8)
    parts, n = shingles.word_hashes(texts)
    assert whole.tolist() == parts.tolist() and counts.tolist() == n.tolist()
    assert [len(x) for x in shingles.word_hashes([])] == [0, 0]
