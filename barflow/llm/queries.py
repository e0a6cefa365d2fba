"""The registered queries opN_<name>: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barflow.llm import embed_dedup, fingerprint, jaccard, lexical_search, lm_score, mixing, packing, pii, quality, secret_scan, spelling, toxicity, url_filter
from barflow.llm.common import documents, held_out, table
from barflow.llm.oracle import ORACLE_SQL  # noqa: F401


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's calibrated probability in the mix, whether it is drawn, and the mix's largest miss of a target share."""
    return mixing.mix_documents(documents(spark, sf_dir)).select("doc_id", "source", "lang", "topic", "n_tokens", "probability", "sampled", "residual")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every whole text and its edited text, and their likeness."""
    return fingerprint.compare_with_edits(documents(spark, sf_dir))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents' pieces in sequences of at most 4096 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), word_tokenizer())


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: counts and digest of the base kinds, and all spans."""
    return secret_scan.digest(secret_scan.find_secrets(documents(spark, sf_dir)))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under 5-shingle Jaccard links of 0.75 or more."""
    return jaccard.join_documents(documents(spark, sf_dir))


def toxicity_lexicon(spark: SparkSession, sf_dir: str) -> toxicity.Lexicon:
    """Learnt from the labelled documents that are not held out."""
    apart = held_out(F.col("doc_id"), 5, 0)
    return toxicity.learn(documents(spark, sf_dir), table(spark, sf_dir, "labels").where(~apart))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learnt from the rows that are not held out."""
    docs, apart = documents(spark, sf_dir), held_out(F.col("doc_id"), 5, 0)
    lexicon = toxicity_lexicon(spark, sf_dir)
    scored = toxicity.score_documents(docs.select("doc_id", "text"), lexicon)
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy difference of every whole text between the benchmark's texts and the corpus."""
    return lm_score.score_documents(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the rules', else the language models'."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("score")


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all vectors at cosine 0.9 or more, and their components."""
    return embed_dedup.link_vectors(table(spark, sf_dir, "embeddings"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learnt from the rows that are not held out."""
    docs, apart = documents(spark, sf_dir).select("doc_id", "text"), held_out(F.col("doc_id"), 3, 1)
    model = quality.learn(docs, table(spark, sf_dir, "labels").where(~apart))
    scored = quality.score_documents(docs, model)
    return scored.select("doc_id", apart.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, form and root of every frequent word of the documents."""
    return spelling.spelling_variants(documents(spark, sf_dir))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text: counts and digest of the base kinds, and all spans."""
    docs = documents(spark, sf_dir)
    return pii.digest(pii.find_pii(docs, pii.learn(docs)))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_fingerprints": op2_fingerprints,
    "op3_packing": op3_packing,
    "op4_secrets": op4_secrets,
    "op5_jaccard": op5_jaccard,
    "op6_toxicity": op6_toxicity,
    "op7_lm_score": op7_lm_score,
    "op8_urls": op8_urls,
    "op9_embeddings": op9_embeddings,
    "op10_quality": op10_quality,
    "op11_spelling": op11_spelling,
    "op12_pii": op12_pii,
    "op13_search": op13_search,
}
