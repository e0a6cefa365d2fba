"""Quality classifier: a sparse rule ensemble over text statistics.

1. Statistics of each whole text are Spark column expressions (``statistics``).
2. A random forest of shallow trees is grown on a sample of labelled rows; every path
   from a root to a node is a rule, a conjunction of thresholds on statistics.
3. A logistic regression with a lasso penalty weighs the rules' 0/1 columns; most
   weights are zero.
4. The rules left are compiled into one Spark column expression, so scoring all
   documents is a single projection without Python.

Learning uses at most ``MAX_LABELLED`` labelled rows (those with the least hash of
their id). Everything else covers all rows.

Edge cases: a null text is empty; statistics of empty texts are 0, so they get a
defined score; without labelled rows of both kinds the score is the share of ones
(0.5 without any); very long texts count whole; repeated rows are scored each.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import log

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barflow.session import materialize

MAX_LABELLED = 20_000
TREES = 20
DEPTH = 3
LASSO = 0.002
SEED = 7


@dataclass(frozen=True)
class Rule:
    """All of ``parts`` hold: (statistic, is it above, threshold)."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self) -> Column:
        tests = [F.col(name) > bound if above else F.col(name) <= bound for name, above, bound in self.parts]
        out = tests[0]
        for test in tests[1:]:
            out = out & test
        return out


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Rule, float], ...]

    def score(self) -> Column:
        total = F.lit(float(self.intercept))
        for rule, weight in self.rules:
            total = total + F.when(rule.column(), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-total))


def statistics() -> dict[str, Column]:
    """Numbers that describe a whole text, from the columns ``_text``, ``_words`` and ``_lines``; 0 where there is nothing to count."""
    text, words, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    chars, n_words, n_lines = F.length(text), F.size(words), F.size(lines)
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(F.lit(0.0))
    left = lambda drop: F.length(F.translate(text, drop, ""))
    same = F.filter(F.zip_with(F.slice(words, 2, F.greatest(n_words - 1, F.lit(0))), words, lambda a, b: a == b), lambda x: x)
    return {
        "log_chars": F.log1p(chars.cast("double")),
        "word_length": share(left(" \n\t"), n_words),
        "upper_share": share(chars - left("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), chars),
        "digit_share": share(chars - left("0123456789"), chars),
        "sign_share": share(chars - left("#$%&*+/<=>@[\\]^_`{|}~"), chars),
        "shout_share": share(chars - left("!?"), chars),
        "stop_share": share(chars - left(".,;:"), chars),
        "bar_share": share(chars - left("|"), n_words),
        "line_length": share(n_words, n_lines),
        "distinct_words": share(F.size(F.array_distinct(words)), n_words),
        "distinct_lines": share(F.size(F.array_distinct(lines)), n_lines),
        "repeats": share(F.size(same), n_words),
    }


def with_statistics(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """``docs`` without its text, with a column for each statistic.

    Words and lines are columns of a projection of their own, so a text is split once.
    """
    numbers = statistics()
    kept = [c for c in docs.columns if c != text and c not in numbers]
    whole = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(*kept, whole.alias("_text"), F.filter(F.split(whole, r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_words"),
                        F.filter(F.split(whole, "\n"), lambda x: F.trim(x) != "").alias("_lines"))
    return split.select(*kept, *(v.cast("double").alias(n) for n, v in numbers.items())), list(numbers)


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> RuleModel:
    """Rules and weights from labelled documents (docs: doc_id, text; labels: doc_id, quality 0/1)."""
    marked = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    sample, names = with_statistics(docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id"))
    sample = materialize(sample.dropDuplicates(["doc_id"]).coalesce(4), "quality_sample")
    n = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones, zeros = n.get(1.0, 0), n.get(0.0, 0)
    if not ones or not zeros:
        return RuleModel(log((ones + 0.5) / (zeros + 0.5)) if ones + zeros else 0.0, ())
    balance = F.when(F.col("label") == 1, 0.5 * (ones + zeros) / ones).otherwise(0.5 * (ones + zeros) / zeros)
    vectors = VectorAssembler(inputCols=names, outputCol="statistics").transform(sample.withColumn("balance", balance))
    forest = RandomForestClassifier(featuresCol="statistics", labelCol="label", weightCol="balance", numTrees=TREES, maxDepth=DEPTH,
                                    subsamplingRate=0.5, featureSubsetStrategy="sqrt", seed=SEED).fit(vectors)
    rules = list(dict.fromkeys(r for tree in forest.trees for r in paths(tree.toDebugString, names)))
    met = sample.select("label", *(r.column().cast("double").alias(f"r{k}") for k, r in enumerate(rules)))
    rows = VectorAssembler(inputCols=[f"r{k}" for k in range(len(rules))], outputCol="rules").transform(met).select("label", "rules")
    fitted = LogisticRegression(featuresCol="rules", labelCol="label", regParam=LASSO, elasticNetParam=1.0, standardization=False,
                                maxIter=60).fit(materialize(rows, "quality_rules"))
    kept = tuple((r, float(w)) for r, w in zip(rules, fitted.coefficients, strict=True) if w)
    return RuleModel(float(fitted.intercept), kept)


_TEST = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)$")


def paths(tree: str, names: list[str]) -> list[Rule]:
    """Every path from the root to a node of a tree's printed form, as rules."""
    out, held = [], []
    for line in tree.splitlines():
        if m := _TEST.match(line):
            depth = len(m[1])
            held = [h for h in held if h[0] < depth]
            held.append((depth, (names[int(m[3])], m[4] == ">", float(m[5]))))
            out.append(Rule(tuple(sorted({part for _, part in held}))))
    return out


def score_documents(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` without its text, with the statistics and ``score``."""
    return with_statistics(docs)[0].withColumn("score", model.score())
