"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding lower-cases, turns look-alike letters of other scripts and digits or signs
inside words into the plain letters they stand for, and drops zero-width marks, so
disguised spellings meet the lexicon. Terms are whole words, and word beginnings of
five letters or more, so that inflected forms count too; each has a weight, its
log-odds between toxic and other labelled texts (add-half smoothing). Exception
phrases (a term with a neighbouring word that makes it harmless) take their term's
weight back; some are given and others are learnt from the labels the same way.

The score is a logistic function of two sums over a whole text: the weights met
(log), and the weights met per thousand characters. Its three coefficients are fitted
on the labelled rows. One pass over a text finds all terms and phrases.

Learning reads at most ``MAX_LABELLED`` labelled rows (those with the least hash of
their id); all counting of words is done by Spark and only terms that pass the
thresholds, at most ``MAX_TERMS``, come to the driver.

Edge cases: null and empty texts match nothing and score as such; without labelled
rows of both kinds the built-in terms and coefficients are used; very long texts are
scanned whole; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barflow.llm.common import giving_back
from barflow.session import materialize

MAX_LABELLED = 20_000
MAX_TERMS = 20_000
# A term is kept if its log-odds reach LEAST_WEIGHT and its counts, were it unrelated to the
# label, would have a probability below exp(-LEAST_EVIDENCE).
LEAST_WEIGHT = 3.0
LEAST_EVIDENCE = 11.5
# A phrase becomes an exception if it was in so many clean texts.
LEAST_CLEAN = 3
STEM_LETTERS = (5, 6, 7, 8)

# Insults every lexicon starts with, and harmless phrases with such words.
SEED_TERMS = ("disgusting", "idiot", "loser", "moron", "pathetic", "scum", "stupid", "worthless")
SEED_WEIGHT = 4.0
SEED_EXCEPTIONS = ("pond scum", "trash can", "trash bag", "trash bin", "clown fish", "circus clown", "sore loser rule")
# intercept, log weight, weight per thousand characters
SEED_COEFFICIENTS = (-3.0, 3.0, 0.2)

# Look-alikes and the plain letters they are read as (fixed values).
HOMOGLYPHS = {
    # Cyrillic
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "м": "m", "н": "h",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "ѵ": "v", "х": "x", "у": "y",
    # Greek
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "γ": "y",
    # Latin variants
    "ı": "i", "ɑ": "a", "ɡ": "g", "ʟ": "l", "ɩ": "i", "ⅼ": "l", "ⅰ": "i", "ſ": "s",
}
# Digits and signs read as letters when a letter stands beside them (fixed values).
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
INVISIBLE = "​‌‍⁠﻿­"


def _fold_table() -> dict[int, str]:
    table = {ord(k): v for k, v in HOMOGLYPHS.items()}
    table |= {ord(k.upper()): v for k, v in HOMOGLYPHS.items() if len(k.upper()) == 1 and ord(k.upper()) > 127}
    table |= {0xFF21 + i: chr(97 + i) for i in range(26)} | {0xFF41 + i: chr(97 + i) for i in range(26)}  # full width
    table |= {0xFF10 + i: chr(48 + i) for i in range(10)}
    return table | {ord(c): "" for c in INVISIBLE}


class Folder:
    """Folds texts; words come out as runs of letters."""

    def __init__(self):
        import regex

        table = _fold_table()
        self.seen = regex.compile("[" + "".join(regex.escape(chr(c)) for c in table) + "]")
        self.table = table
        self.mixed = regex.compile(r"(?<=\p{L})[0134578@$!]+(?=\p{L})|\b[0134578@$]+(?=\p{L}{2})|(?<=\p{L}{2})[01345780@$]+\b")
        self.letters = str.maketrans(SUBSTITUTES)
        self.gaps = regex.compile(r"[^\p{L}]+")

    def __call__(self, text: str) -> str:
        """Lower-case words with one space before, between and after them."""
        if not text.isascii() and self.seen.search(text):
            text = text.translate(self.table)
        text = self.mixed.sub(lambda m: m[0].translate(self.letters), text.lower())
        return f" {self.gaps.sub(' ', text).strip()} "


@dataclass(frozen=True)
class Lexicon:
    """``terms``: pattern to weight, with a space where a word ends; ``exceptions``: phrase to the weight it takes back."""

    terms: dict[str, float]
    exceptions: dict[str, float]
    coefficients: tuple[float, float, float]

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for pattern, weight in [*self.terms.items(), *((f" {p} ", -w) for p, w in self.exceptions.items())]:
            found.add_word(pattern, (pattern, weight))
        found.make_automaton()
        return found


def seed_lexicon() -> Lexicon:
    terms = {f" {t} ": SEED_WEIGHT for t in SEED_TERMS}
    return Lexicon(terms, {p: SEED_WEIGHT for p in SEED_EXCEPTIONS}, SEED_COEFFICIENTS)


def weigh(automaton, folded: str) -> float:
    """Sum of weights met in a folded text; a word counts with its heaviest term only."""
    total, best, word = 0.0, 0.0, -1
    for end, (pattern, weight) in automaton.iter(folded):
        if weight < 0:
            total += weight
            continue
        start = end - len(pattern) + 1
        if start != word:
            total, best, word = total + best, 0.0, start
        best = max(best, weight)
    return max(0.0, total + best)


def sums(weight, length):
    """The two inputs of the score from the weights met and the text's length."""
    return np.log1p(weight), 1000.0 * weight / np.maximum(length, 200)


def weigh_documents(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` without its text, with ``weight`` (of all terms met) and ``chars`` of every whole text."""
    kept = [f for f in docs.schema.fields if f.name not in (text, "weight", "chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, automaton = Folder(), lexicon.automaton()
        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            weight = np.array([weigh(automaton, fold(t)) for t in texts], dtype=float)
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(weight), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[*batch.schema.names[1:], "weight", "chars"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), "weight double, chars bigint"])
    return docs.select(F.col(text).alias("text"), *(f"`{f.name}`" for f in kept)).mapInArrow(run, schema)


def score_documents(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """``docs`` without its text, with weight, chars and ``score`` of every whole text."""
    intercept, by_log, by_rate = lexicon.coefficients
    rate = 1000.0 * F.col("weight") / F.greatest(F.col("chars"), F.lit(200))
    exponent = F.lit(intercept) + F.lit(by_log) * F.log1p("weight") + F.lit(by_rate) * rate
    return weigh_documents(docs, lexicon, text).withColumn("score", 1.0 / (1.0 + F.exp(-exponent)))


def without_toxic(docs: DataFrame, lexicon: Lexicon, least: float = 0.5) -> DataFrame:
    """Documents, with all their columns, whose score is below ``least``."""
    intercept, by_log, by_rate = lexicon.coefficients

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold, automaton = Folder(), lexicon.automaton()
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            weight = np.array([weigh(automaton, fold(t)) for t in texts], dtype=float)
            log, rate = sums(weight, np.array([len(t) for t in texts], dtype=float))
            score = 1.0 / (1.0 + np.exp(-(intercept + by_log * log + by_rate * rate)))
            yield batch.filter(pa.array(score < least))

    return docs.mapInArrow(giving_back(run), docs.schema)


def learn(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Lexicon:
    """Lexicon and coefficients from labelled documents (labels: doc_id, toxic 0/1)."""
    marked = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled))
    sample = materialize(docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id"), "toxicity_sample")
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    seed = seed_lexicon()
    if not n.get(0) or not n.get(1):
        return seed

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = Folder()
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if text:
                    for term in terms_of(fold(text)):
                        counts.setdefault(term, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                                              pa.array([c[1] for c in counts.values()], pa.int64())], names=["term", "clean", "toxic"])

    seen = (sample.select("text", F.col("toxic").cast("long")).mapInArrow(giving_back(candidates), "term string, clean bigint, toxic bigint")
            .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")))
    odds = F.log((F.col("toxic") + 0.5) / (n[1] + 1)) - F.log((F.col("clean") + 0.5) / (n[0] + 1))
    both, share = F.col("toxic") + F.col("clean"), n[1] / (n[0] + n[1])
    part = lambda x, q: F.when(x > 0, x * F.log(x / both / q)).otherwise(0.0)
    evidence = part(F.col("toxic"), share) + part(F.col("clean"), 1 - share)
    kept = (seen.withColumn("weight", odds).where((evidence >= LEAST_EVIDENCE) & (F.col("weight") >= LEAST_WEIGHT))
            .orderBy(F.desc("weight"), "term").limit(MAX_TERMS))
    terms = seed.terms | {r["term"]: float(r["weight"]) for r in kept.collect()}
    exceptions = seed.exceptions | _learn_exceptions(sample, terms, n)
    plain = Lexicon(terms, exceptions, seed.coefficients)
    pairs = weigh_documents(sample, plain).dropDuplicates(["doc_id"]).toPandas()  # at most max_labelled rows
    return Lexicon(terms, exceptions, fit_logistic(pairs["weight"].to_numpy(), pairs["chars"].to_numpy(float),
                                                   pairs["toxic"].to_numpy(float)))


def terms_of(folded: str) -> set[str]:
    """Patterns of a folded text: each word, and its beginnings."""
    words = set(folded.split())
    out = {f" {w} " for w in words}
    for w in words:
        out.update(f" {w[:k]}" for k in STEM_LETTERS if len(w) > k)
    return out


def _learn_exceptions(sample: DataFrame, terms: dict[str, float], n: dict[int, int]) -> dict[str, float]:
    """Two-word phrases with a term that were in three clean texts at least and mostly in clean ones."""
    words = {t.strip(): w for t, w in terms.items() if t.endswith(" ")}

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fold = Folder()
        for batch in batches:
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                row = fold(text).split() if text else []
                for pair in {f"{a} {b}" for a, b in zip(row, row[1:], strict=False) if a in words or b in words}:
                    counts.setdefault(pair, [0, 0])[toxic] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()),
                                              pa.array([c[1] for c in counts.values()], pa.int64())], names=["term", "clean", "toxic"])

    seen = (sample.select("text", F.col("toxic").cast("long")).mapInArrow(phrases, "term string, clean bigint, toxic bigint")
            .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .where((F.col("clean") >= LEAST_CLEAN) & (F.col("clean") / n[0] > F.col("toxic") / n[1]))
            .orderBy(F.desc("clean"), "term").limit(MAX_TERMS))
    return {r["term"]: max(words.get(w, 0.0) for w in r["term"].split()) for r in seen.collect()}


def fit_logistic(weight: np.ndarray, length: np.ndarray, label: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Newton's method for the two sums and an intercept; slopes are kept from being negative."""
    x = np.column_stack([np.ones(len(weight)), *sums(weight, length)])
    beta = np.zeros(3)
    penalty = ridge * len(weight) * np.array([0.0, 1e-2, 1e-2])
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, x.T @ (label - p) - penalty * beta)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    if beta[1] < 0 or beta[2] < 0 or not all(map(math.isfinite, beta)):
        return SEED_COEFFICIENTS
    return tuple(float(b) for b in beta)
