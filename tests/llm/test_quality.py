import math

from barflow.llm import quality as Q
from barflow.llm import queries

SF = "/root/testdata/sf0.01"


def test_rules_of_a_tree():
    tree = """DecisionTreeClassificationModel: uid=x, depth=2, numNodes=5
  If (feature 0 <= 1.5)
   If (feature 2 <= -2.0E-4)
    Predict: 0.0
   Else (feature 2 > -2.0E-4)
    Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 0.0
"""
    rules = [r.parts for r in Q.paths(tree, ["a", "b", "c"])]
    assert rules == [(("a", False, 1.5),), (("a", False, 1.5), ("c", False, -2e-4)), (("a", False, 1.5), ("c", True, -2e-4)), (("a", True, 1.5),)]


def test_statistics(spark):
    docs = spark.createDataFrame([(1, "Aa aa aa!\n\nx | 12\nx | 12\n"), (2, None), (3, "")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in Q.with_statistics(docs)[0].collect()}
    one = got[1]
    assert abs(one["log_chars"] - math.log1p(25)) < 1e-12 and one["line_length"] == 3.0
    assert one["distinct_words"] == 6 / 9 and one["distinct_lines"] == 2 / 3 and one["repeats"] == 0.0 and one["bar_share"] == 2 / 9
    assert abs(one["upper_share"] - 1 / 25) < 1e-12 and abs(one["digit_share"] - 4 / 25) < 1e-12
    assert all(v == 0.0 for k, v in got[2].asDict().items() if k != "doc_id") and got[2][1:] == got[3][1:]


def test_scores_against_brute_force_and_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    apart = queries.held_out(labels["doc_id"], 3, 1)
    model = Q.learn(docs.select("doc_id", "text"), labels.where(~apart))
    assert 0 < len(model.rules) < 100
    for r in Q.score_documents(docs.limit(200), model).collect():
        total = model.intercept
        for rule, weight in model.rules:
            if all((r[n] > t) if above else (r[n] <= t) for n, above, t in rule.parts):
                total += weight
        assert abs(r["score"] - 1 / (1 + math.exp(-total))) < 1e-9
    rows = queries.op10_quality(spark, SF).join(labels, "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == r["quality"] for r in held) >= 0.95 * len(held)


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (2, "", 1.0), (None, "x " * 50000, 2.0)], "doc_id long, text string, repeats double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in Q.score_documents(docs, Q.learn(docs, none)).collect()] == [0.5] * 4
    only = Q.learn(docs, spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id long, quality int"))
    assert all(r["score"] > 0.5 for r in Q.score_documents(docs, only).collect())
    assert Q.score_documents(docs.limit(0), only).count() == 0
