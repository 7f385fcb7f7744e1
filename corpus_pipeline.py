"""Cleaning of a text corpus for training, stage by stage.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. All but the
last return the columns of ``documents``; the last returns the packed pieces of what is left. Every
stage is written and read again, so a lost executor costs one stage at most.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom import scratch
from salesloom.llm import decontaminate, language, packing, quality, simhash
from salesloom.llm.batches import unused_names

# A text of many languages, or of letters in no order, is below it; a clean one is far above. The
# network has no class for a language it has not learnt, so a text in one may pass.
LEAST_LANGUAGE_SCORE = 0.3


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told from their text."""
    net = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    (name,) = unused_names(docs, "found")
    found = docs.withColumn(name, language.predict(net, F.col("text")))
    told = (F.col(f"{name}.lang_pred") != language.UNKNOWN) & (
        F.col(f"{name}.score") >= LEAST_LANGUAGE_SCORE
    )
    return found.where(told).drop(name)


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample weighted by likeness to documents labelled good."""
    return quality.resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that fingerprints of three-word shingles link at two bits."""
    return simhash.drop_near_duplicates(docs, shingle_words=3, max_bits=2)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    hits = decontaminate.benchmark_hits(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    found = scratch.materialize(hits.where("n_hit > 0").drop("spans", "items"), "contaminated")
    return decontaminate.remove_documents(docs, found)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of one length."""
    return packing.packed_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language", known_language),
    ("quality", good_text),
    ("near_copies", no_near_copies),
    ("benchmark", no_benchmark),
    ("packing", packed),
]

# Learnt models, graph components and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.materialize(stage(spark, docs, sf_dir), name)
    return docs
