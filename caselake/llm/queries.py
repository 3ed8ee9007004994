"""The registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import language_id, mixing, rule_quality, toxicity_cnn
from .common import fold, read_documents
from .compression_quality import compression_bands
from .language_id import held_out
from .lz_fingerprint import lz_edit_likeness
from .minhash_dedup import near_duplicates
from .piece_nbest import segment
from .suffix_dedup import dedup_digest
from .token_files import read_tokens, write_tokens


def _labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", F.col(label).cast("int").alias("label"))


def mixing_classifier(spark: SparkSession, sf_dir: str) -> mixing.Classifier:
    """Domains are the languages of the documents that ``labels`` lists."""
    docs = read_documents(spark, sf_dir, "doc_id", "text", F.col("lang").alias("domain"))
    return mixing.learn(docs, _labels(spark, sf_dir, "quality"))


#: Target shares of expected tokens; a domain that isn't named keeps its tokens.
TARGET_WEIGHTS = {"en": 0.4, "de": 0.2, "es": 0.2, "fr": 0.2}


def op1_soft_mixing(spark: SparkSession, sf_dir: str, weights: dict[str, float] | None = TARGET_WEIGHTS) -> DataFrame:
    """Rates under which the domains' expected tokens have the target shares, and how often each document is then taken;
    with the target and the reached tokens of the document's likeliest domain."""
    rated, fit = mixing.rates(read_documents(spark, sf_dir), mixing_classifier(spark, sf_dir), weights)
    total = lambda values: F.element_at(F.create_map(*(F.lit(x) for d, v in zip(fit.domains, values, strict=True) for x in (d, round(float(v), 3)))), F.col("domain"))
    return mixing.with_copies(rated).select(
        "doc_id", "n_tokens", "domain", F.array_max("posterior").alias("posterior"), "rate", "copies", total(fit.targets).alias("target_tokens"), total(fit.reached).alias("reached_tokens")
    )


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands(read_documents(spark, sf_dir))


def op3_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_edit_likeness(read_documents(spark, sf_dir))


def op4_simple8b_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vocabulary file must lie at the same path on every executor."""
    return read_tokens(write_tokens(read_documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")))


def op5_piece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model file must lie at the same path on every executor."""
    return segment(read_documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op6_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are learned from rows whose fold of 5 is not 0."""
    docs = read_documents(spark, sf_dir, "doc_id", "text", "lang")
    model = toxicity_cnn.fit(docs, _labels(spark, sf_dir, "toxic").where(fold(modulus=5) != 0))
    return toxicity_cnn.score(docs, model).select(
        "doc_id", held_out(fold(modulus=5), 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "language"
    )


def op7_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_documents(spark, sf_dir))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_digest(read_documents(spark, sf_dir))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words and n-grams are learned from rows whose fold of 4 is not 2."""
    docs = read_documents(spark, sf_dir, "doc_id", "text", "lang")
    model = language_id.fit(docs.where(fold(modulus=4) != 2))
    return language_id.identify(docs, model).select("doc_id", held_out(fold(modulus=4), 2).alias("held_out"), "lang_pred", "score")


def op10_rule_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels are learned from rows whose fold of 3 is not 1."""
    docs = read_documents(spark, sf_dir, "doc_id", "text")
    model = rule_quality.fit(docs, _labels(spark, sf_dir, "quality").where(fold(modulus=3) != 1))
    return rule_quality.score(docs, model).select(
        "doc_id", held_out(fold(modulus=3), 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


QUERIES = {
    "op1_soft_mixing": op1_soft_mixing,
    "op2_compression_bands": op2_compression_bands,
    "op3_lz_fingerprint": op3_lz_fingerprint,
    "op4_simple8b_tokens": op4_simple8b_tokens,
    "op5_piece_nbest": op5_piece_nbest,
    "op6_toxicity_cnn": op6_toxicity_cnn,
    "op7_minhash_dedup": op7_minhash_dedup,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_language_id": op9_language_id,
    "op10_rule_quality": op10_rule_quality,
}

#: Shingle sets as lists, likeness from a join on shingles, components by reachability.
ORACLE_SQL: dict[str, str] = {
    "op7_minhash_dedup": r"""with recursive
    words as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
    sets as (select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) when len(w) > 0 then [array_to_string(w, ' ')] else [] end as s from words),
    grams as (select doc_id, unnest(s) as g from sets),
    shared as (select x.doc_id as a, y.doc_id as b, count(*) as n from grams x join grams y on x.g = y.g and x.doc_id < y.doc_id group by all),
    links as (select a, b from shared join sets p on p.doc_id = a join sets q on q.doc_id = b where 100 * n >= 75 * (len(p.s) + len(q.s) - n)),
    ways as (select a, b from links union all select b, a from links),
    reach as (select a, b from ways union select r.a, w.b from reach r join ways w on w.a = r.b),
    least_of as (select a as doc_id, min(b) as least from reach group by a)
    select doc_id, len(s) as n_shingles, least(doc_id, coalesce(least, doc_id)) as component_id, doc_id <= coalesce(least, doc_id) as kept from sets left join least_of using (doc_id)""",
}
