"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next one's docs. All but the last return the columns of documents.
Null texts, empty tables, repeated rows and ties behave as the operators describe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from guichet.llm import language, minhash, mixing, packing, pii
from guichet.llm.queries import SURROGATE_KEY, public_vocabulary
from guichet.llm.store import carried, restored, written

#: A text that no learned language explains better than all others together is rejected.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters (null and empty ones too) and those whose language is undecided.

    The languages are learned from the stage's own labelled rows; a document with another
    label than its predicted language stays.
    """
    model = language.fit(docs, public_vocabulary("piece_bpe_32k.model"))
    predict = language.predictor(spark, model)
    found = docs.select(carried(docs), predict(F.col("text")).alias("found"))
    kept = found.filter((F.col("found.lang_pred") != "und") & (F.col("found.score") >= LEAST_SCORE))
    return kept.select(*restored(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest doc_id.

    Groups are made of rows, not of identifiers: rows that share a doc_id are documents of
    their own, of equal ones one stays. Rows without a doc_id are nobody's copies and stay.
    """
    rows = written(docs.select(carried(docs), F.monotonically_increasing_id().alias("_node")))
    known = rows.filter(F.col("_doc.doc_id").isNotNull())
    texts = known.select("_node", F.col("_doc.text").alias("text"))
    found = minhash.near_duplicates(texts, key="_node").select(F.col("doc_id").alias("_node"), "component_id")
    found = written(found.join(known.select("_node", F.col("_doc.doc_id").alias("doc_id")), "_node"))
    first = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "_node"))["_node"].alias("_first"))
    copies = found.join(first, "component_id").filter("_node != _first").select("_node")
    return rows.join(copies, "_node", "left_anti").select(*restored(docs))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; n_chars follows the new text."""
    changed = pii.pseudonymise(docs, SURROGATE_KEY)
    if "n_chars" in docs.columns:
        length = F.when(F.size("pii_spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
        changed = changed.withColumn("n_chars", length)
    return changed.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in the wanted proportions: a document occurs as often as the mix takes it, some not at all."""
    return mixing.repeated(mixing.mix(docs)).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_vocabulary("word_bpe_49k.json"))


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained probabilities, keyed digests and a tokeniser: nothing SQL can recompute.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
