"""Training-corpus pipeline: the stages in order, each a function (spark, docs, sf_dir) -> DataFrame.

Every stage but the last returns the columns of ``documents``.  Toxic documents go, one document of
each near-duplicate group stays, repeated passages are cut out of the texts, small domains are
repeated up to their target weights (no document is lost there), and the last stage returns piece ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselake.llm import minhash_dedup, mixing, piece_nbest, suffix_dedup, toxicity_cnn
from caselake.llm.common import drop_staged, fold, read_documents, scope, stage


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop what the classifier calls toxic; it learns from labels outside the held-out fold."""
    labels = _labels(spark, sf_dir).select("doc_id", F.col("toxic").cast("int").alias("label")).where(fold(modulus=5) != 0)
    return toxicity_cnn.keep_clean(docs, toxicity_cnn.fit(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each group of near copies."""
    return minhash_dedup.keep_first(docs)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut out every byte covered by a 100-byte string that also starts earlier."""
    return suffix_dedup.remove_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat documents by their fitted rates, of 1 at least, under targets that no domain shrinks for: every document stays."""
    labelled = docs.select("doc_id", "text", F.col("lang").alias("domain"))
    return mixing.mix(docs, mixing.learn(labelled, _labels(spark, sf_dir)), floor=1.0)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids and scores of the N best segmentations."""
    return piece_nbest.segment(docs, public_tokenizers.path("piece_bpe_32k.model"), with_ids=True)


STAGES = [("toxicity", toxicity), ("minhash", near_dedup), ("suffix_array", passage_dedup), ("mixing", mix), ("sentencepiece", encode)]

#: Trained models, suffix arrays and piece lattices are beyond SQL; the tests hold brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = read_documents(spark, sf_dir)
    for name, function in STAGES[:-1]:
        with scope() as tables:  # what a stage wrote on its way goes with it
            before, docs = docs, stage(function(spark, docs, sf_dir), f"stage-{name}")
            tables.keep(docs)
        drop_staged(before)
    return STAGES[-1][1](spark, docs, sf_dir)
