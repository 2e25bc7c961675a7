import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from guichet.llm import minhash
from guichet.llm.store import written


def stage(name):
    return dict(corpus_pipeline.STAGES)[name]


@pytest.fixture(scope="module")
def steps(spark, data_dir):
    docs, out = spark.read.parquet(f"{data_dir}/documents.parquet"), []
    for _, run in corpus_pipeline.STAGES:
        out.append(docs)
        docs = written(run(spark, docs, data_dir))
    return [*out, docs]


def test_columns_and_decisions(spark, steps):
    columns = steps[0].columns
    assert [d.columns for d in steps[:-1]] == [columns] * 5
    assert steps[1].count() == steps[0].count()  # every generated text is in one of the languages
    groups = minhash.near_duplicates(steps[1])
    assert sorted(r[0] for r in steps[2].select("doc_id").collect()) == sorted(r[0] for r in groups.filter("kept").select("doc_id").collect())
    assert steps[3].count() == steps[2].count()
    assert steps[3].filter("text rlike '[\\\\w.]+@mail'").join(steps[2].select("text"), "text", "left_semi").count() == 0
    packed = steps[5].filter("start = 0").groupBy("doc_id").count()
    mixed = steps[4].groupBy("doc_id").count()
    assert packed.exceptAll(mixed).count() == 0 == mixed.exceptAll(packed).count()


def test_run_is_the_stages_in_order(spark, steps, data_dir):
    again = corpus_pipeline.run(spark, data_dir)
    assert again.exceptAll(steps[-1]).count() == 0 and again.count() == steps[-1].count()


def test_rejected_languages(spark, odd_docs):
    kept = [r["doc_id"] for r in stage("language_id")(spark, odd_docs, "").collect()]
    assert not {1, 2, 3, 9} & set(kept) and {5, 6, 7} <= set(kept)


def test_one_of_each_group_stays(spark, odd_docs):
    kept = stage("near_duplicates")(spark, odd_docs, "")
    assert kept.columns == odd_docs.columns
    assert sorted((r["doc_id"] or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 7, 9, 10]
    twice = odd_docs.filter("doc_id = 6")
    assert stage("near_duplicates")(spark, twice, "").count() == 1


def test_different_texts_with_one_identifier_stay(spark):
    a, b, c = (" ".join(f"{w}{i}" for i in range(40)) for w in "abc")
    rows = [(1, a), (1, b), (2, b), (3, c), (3, c), (0, a + " end"), (4, None), (4, "")]
    kept = stage("near_duplicates")(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert sorted(tuple(r) for r in kept.fillna("null").collect()) == [(0, a + " end"), (1, b), (3, c), (4, ""), (4, "null")]


def test_stages_on_odd_and_no_rows(spark, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for _, run in corpus_pipeline.STAGES:
            docs = written(run(spark, docs, ""))
        assert docs.columns[0] == "doc_id"
    assert docs.count() == 0


def test_text_length_follows_the_new_text(spark):
    df = spark.createDataFrame([(1, "mail a@b.example.com", 20), (2, "plain", 99)], "doc_id long, text string, n_chars long")
    found = {r["doc_id"]: r for r in stage("personal_data")(spark, df, "").collect()}
    assert found[1]["n_chars"] == len(found[1]["text"]) and found[2]["n_chars"] == 99
    assert stage("personal_data")(spark, df.select("doc_id", F.col("text")), "").columns == ["doc_id", "text"]
