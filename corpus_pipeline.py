"""Training-corpus pipeline over ``documents``: classify, deduplicate, decontaminate, mix, and write token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``docs``. ``run`` writes every
stage's result under the shared checkpoint folder and reads it back, so that a lost executor costs at most part of
one stage; what a stage wrote on its way, and the stage before, are deleted then. A stage handles what its operator handles: nulls in any column, empty and very long texts, repeated rows, empty
tables, further columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.llm import decontamination, mixing, near_dup, quality_classifier, token_output
from paddock.llm.common import discard, discard_path, join_by_key, landed, row_key, table, watched

END_ID = 2


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier, fitted on the labelled ones, does not reject."""
    return quality_classifier.classified(spark, docs, sf_dir).where("kept").select(docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies (five-word shingles, similarity 0.8); one
    row of each document that is repeated with its id."""
    found = landed(near_dup.near_duplicates(docs).where("kept").groupBy("key_id", "key_hash").agg(F.count("*").alias("times")), "kept")
    rows = join_by_key(docs.select("*", *row_key()), found.select("key_id", "key_hash"), "left_semi")
    if not found.where("times > 1").isEmpty():
        rows = rows.dropDuplicates(["key_id", "key_hash"])
    return rows.select(docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words benchmark windows cover less than a twentieth."""
    found = decontamination.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.where("NOT contaminated").select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes its words, rounded to whole documents; rows that repeat id and text
    share their words evenly, rounded up."""
    mixed = (mixing.mix(docs).where("taken > 0")
             .groupBy("key_id", "key_hash").agg(F.max("size").alias("size"), F.sum("taken").alias("taken"), F.count("*").alias("rows"))
             .withColumn("times", F.ceil(F.floor((2 * F.col("taken") + F.col("size")) / (2 * F.col("size"))) / F.col("rows")))
             .where("times > 0").select("key_id", "key_hash", "times"))
    rows = join_by_key(docs.select("*", *row_key()), mixed, "inner")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))).select(docs.columns)


def write_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids in byte-plane chunks, read back: doc_id, start, n_tokens, ids_crc32."""
    path = token_output.write_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID)
    return token_output.documents(spark, path)


STAGES = [
    ("quality_classifier", classify),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("token_output", write_ids),
]

#: No SQL: the classifier is a fitted model and token ids come from a tokenizer. Tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with watched() as paths:
            new = landed(stage(spark, docs, sf_dir), f"stage-{name}")
        for path in paths:  # the stage's own steps, and the stage before, are done with
            if path != new.landed_at:
                discard_path(spark, path)
        if hasattr(docs, "landed_at"):
            discard(docs)
        docs = new
    return docs
