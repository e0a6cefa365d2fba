from pyspark.sql import functions as F

from barflow.llm import queries
from barflow.llm import toxicity as T

SF = "/root/testdata/sf0.01"


def weight(text, lexicon):
    return T.weigh(lexicon.automaton(), T.Folder()(text))


def test_folding():
    fold = T.Folder()
    assert fold("Lоsеr, IDI0T! m0r0n; ѕcum ｌｏｓｅｒ lo\u200bser") == " loser idiot moron scum loser loser "
    assert fold("room 101 in 1999, a 4 b") == " room in a b "
    assert fold("") == "  "


def test_weights_exceptions_and_word_ends():
    lexicon = T.Lexicon({" idiot ": 4.0, " trash ": 3.0, " lowei": 5.0, " loweix ": 6.0}, {"trash can": 3.0}, T.SEED_COEFFICIENTS)
    assert weight("an idiot", lexicon) == 4.0
    assert weight("idiotic words", lexicon) == 0.0
    assert weight("the trash can", lexicon) == 0.0
    assert weight("trash, the trash can", lexicon) == 3.0
    assert weight("loweiabc", lexicon) == 5.0
    assert weight("loweix loweix", lexicon) == 12.0  # a word counts with its heaviest term


def brute_weight(folded, lexicon):
    """Every term at every place, without the automaton."""
    words = folded.split()
    total = sum(max([w for t, w in lexicon.terms.items() if f" {x} ".startswith(t)], default=0.0) for x in words)
    total -= sum(w * sum(f"{a} {b}" == p for a, b in zip(words, words[1:])) for p, w in lexicon.exceptions.items())
    return max(0.0, total)


def test_learnt_lexicon_against_brute_force_and_labels(spark):
    lexicon = queries.toxicity_lexicon(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: r["weight"] for r in T.score_documents(docs, lexicon).collect()}
    fold = T.Folder()
    for r in docs.limit(150).collect():
        assert abs(got[r["doc_id"]] - brute_weight(fold(r["text"]), lexicon)) < 1e-9
    rows = queries.op6_toxicity(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["toxic"] for r in held) >= 0.9 * len(held)
    assert not any(r["predicted"] and not r["toxic"] for r in rows)
    clean = {r["doc_id"] for r in T.without_toxic(docs, lexicon).collect()}
    assert clean == {r["doc_id"] for r in T.score_documents(docs, lexicon).where("score < 0.5").collect()}


def test_held_out_labels_do_not_matter(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    apart = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    changed = labels.withColumn("toxic", F.when(apart, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert T.learn(docs, changed.where(~apart)) == queries.toxicity_lexicon(spark, SF)


def test_edge_cases(spark):
    rows = [(1, None, 1.0), (2, "", 2.0), (3, "you idiot scum " * 20000, None), (None, "pond scum", 1.0), (3, "fine", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, weight double")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    lexicon = T.learn(docs, none)
    assert lexicon == T.seed_lexicon()
    got = T.score_documents(docs, lexicon).collect()
    assert sorted(r["score"] >= 0.5 for r in got) == [False, False, False, False, True]
    assert all(0 <= r["score"] <= 1 for r in got)
    assert T.score_documents(docs.limit(0), lexicon).count() == 0
    assert T.without_toxic(docs, lexicon).count() == 4
    assert T.learn(docs, spark.createDataFrame([(1, 1), (None, 0), (2, None), (9, 0)], "doc_id long, toxic int")) == T.seed_lexicon()
