"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import cut_lineage
from . import bpe, chat, collocations, language, license_scan, lz_fingerprint, mixing, ngram_join, quality_rules, sharding, substring_dedup, token_align, toxicity
from .common import documents
from .oracles import ORACLES  # noqa: F401  (re-exported for the entry module)


def op8_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    # One pass over the texts; learning and judging read the narrow counts.
    features = quality_rules.with_features(cut_lineage(quality_rules.statistics(documents(spark, sf_dir))))
    rules = quality_rules.learn(features, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_rules.judge(features, rules)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    ranks = public.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(documents(spark, sf_dir), ranks, public.PATTERN, round_trip=True))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.report(ngram_join.join(documents(spark, sf_dir), n=5, threshold=0.8))


def op2_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.with_neighbours(documents(spark, sf_dir))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op4_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    profiles = language.learn(language.training_rows(docs))
    return language.predict(docs, profiles).select(
        "doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.segments(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.report(license_scan.scan(documents(spark, sf_dir)))


def op7_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir), shards=40, vnodes=128).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.kept(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as public

    return token_align.digests(token_align.align(documents(spark, sf_dir), public.path("byte_bpe_50k.json"),
                                                 public.path("piece_bpe_32k.model")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir), max_words=3, min_count=10, contained_percent=50, top=2000)


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, model).select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_lz_fingerprint, op3_source_mix, op4_rank_order_language, op5_perspective_rotation, op6_license_scan, op7_ring_shards, op8_decision_list, op9_byte_bpe,
                                 op10_substring_dedup, op11_token_alignment, op12_collocations, op13_toxicity)}
