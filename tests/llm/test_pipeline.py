import __spark_entry__
import corpus_pipeline
from barflow.llm import jaccard, mixing, queries, secret_scan, toxicity
from barflow.llm.common import documents

SF = "/root/testdata/sf0.001"


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


def test_every_stage_works_on_what_its_predecessor_kept(spark):
    docs = documents(spark, SF)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "secrets", "mixing", "packing"]
    lexicon = queries.toxicity_lexicon(spark, SF)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name == "toxicity":
            assert ids(out) == ids(toxicity.score_documents(docs, lexicon).where("score < 0.5"))
        if name == "ngram_jaccard":
            assert ids(out) == ids(jaccard.join_documents(docs).where("doc_id = component_id"))
        if name == "secrets":
            assert ids(out) == ids(docs)
            left = secret_scan.digest(secret_scan.find_secrets(out)).where("n_assign + n_access + n_hex > 0")
            assert left.count() == 0
        if name == "mixing":
            assert ids(out) == ids(mixing.mix_documents(docs).where("sampled"))
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(out.collect(), out.schema)
        else:
            assert ids(out.where("piece = 0")) == ids(docs)
    assert corpus_pipeline.run(spark, SF).count() == out.count()


def test_extra_columns_and_nulls_go_through(spark):
    rows = [(1, "you idiot loser scum " * 9, "en", "src1", 9, "t", 1), (2, None, None, None, None, None, None), (3, "a b c d e f g h", "en", "src0", 15, "u", 2),
            (4, "A b c d  e f g h", "en", "src2", 16, "v", 3), (5, "token=abcdefghijklmnop", "de", "src3", 22, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, topic string, n_tokens int")
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        if name == "toxicity":
            assert ids(out) == [2, 3, 4, 5]
        if name == "ngram_jaccard":
            assert ids(out) == [1, 2, 3, 5]
        if name == "secrets":
            assert out.where("doc_id = 5").first()["text"] == "[REDACTED]"
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_registration():
    names = __spark_entry__.queries()
    for k in range(1, 11):
        assert sum(n.startswith(f"op{k}_") for n in names) == 1
    assert names["pipeline"] is corpus_pipeline.run and set(__spark_entry__.oracle_sql()) <= set(names)
