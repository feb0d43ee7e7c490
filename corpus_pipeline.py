"""The corpus pipeline: from raw documents to token ids.

Stages, each over all that its predecessor kept: toxicity, exact dedup, MinHash near-dedup, benchmark decontamination, byte-level BPE.
All but the last return the columns of documents; the last adds ids and n_tokens. Rows with null texts count as empty
throughout; empty texts are one group of copies. Rows without a doc_id are linked with nothing; columns may bear any names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dossier.llm import bpe, decontaminate, exact_dedup, minhash, toxicity
from dossier.llm.queries import VOCABULARY_FILE, read
from dossier.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't call toxic. It learns from the table of labels."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised texts, the one with the smallest id."""
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, the one with the smallest id."""
    return minhash.keep_representatives(docs, words=5, percent=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and ids of each document; other columns are left behind."""
    coded = bpe.encode(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY_FILE), public_tokenizers.PATTERN)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("exact_dedup", drop_copies), ("near_dedup", drop_near_copies), ("decontamination", drop_leaks), ("byte_bpe", tokenise)]

#: SQL can't express a trained classifier; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again by the next."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
