"""Training-data pipeline over ``documents``: a list of stages, each calling one operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from riskspark.llm import bpe, decontamination, quality_classifier, simhash, suffix_dedup
from riskspark.llm.common import stored

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark, docs, sf_dir):
    """Drop the documents that the compression classifier takes for bad."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    return quality_classifier.classify(docs, labels).where("predicted = 1").select(*COLUMNS)


def near_duplicate_stage(spark, docs, sf_dir):
    """Keep one document of each group of copies and near copies."""
    return simhash.keep_one(docs).select(*COLUMNS)


def repeats_stage(spark, docs, sf_dir):
    """Take out strings of 200 bytes or more that stand elsewhere too; documents stay, with what is left of them."""
    kept = suffix_dedup.strip_repeats(docs, keep_text=True)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def benchmark_stage(spark, docs, sf_dir):
    """Drop documents that hold a window of a benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    return decontamination.flagged(docs, items).where("not contaminated").select(*COLUMNS)


def token_stage(spark, docs, sf_dir):
    """Token ids of every document that is left, with digests of ids and decoded text."""
    vocabulary = bpe.load_vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    rows = docs.select("doc_id", "text")
    return bpe.encode_documents(rows, vocabulary, keep_ids=True).drop("decoded")


STAGES = [
    ("quality classifier", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("repeated passages", repeats_stage),
    ("benchmark decontamination", benchmark_stage),
    ("token ids", token_stage),
]

#: SQL has no compression models, suffix arrays or tokenizers; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Apply the stages to ``documents``; each result is written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
