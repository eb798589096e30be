"""Corpus pipeline: from raw documents to the token ids of a training mix.

Each stage takes (spark, docs, sf_dir), works on all the rows its predecessor
kept and returns a DataFrame (a stage that runs Python bounds its Arrow
batches itself, whoever read its input), which `run` writes as Parquet into the shared
checkpoint folder and reads back as the next stage's input.  A lost executor
therefore costs a stage at most its own tasks.

The first stage learns its language profiles from the documents, which SQL
can't express, so there is no SQL for the whole; the tests compare it with a
brute-force version stage by stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from listing_engine.llm import bpe, language, mixing, ngram_join, substring_dedup
from listing_engine.llm.common import bounded_batches, documents
from listing_engine.session import checkpoint_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# A text in a language or script without a profile scores near 0, prose in a learned one over 0.4.
LEAST_LANGUAGE_SCORE = 0.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters and those far from every learned language go;
    the others keep their `lang`, or get the predicted one where it is NULL."""
    bounded_batches(spark)
    profiles = language.learn(language.training_rows(docs))
    judged = language.predict(docs, profiles, keep=COLUMNS)
    return (judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE_SCORE))
            .withColumn("lang", F.coalesce("lang", "lang_pred")).select(*COLUMNS))


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id stays."""
    bounded_batches(spark)
    return ngram_join.deduplicate(docs.select(*COLUMNS), n=5, threshold=0.8)


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words that start in an earlier document go, and documents
    of which nothing is left; n_chars follows the text."""
    bounded_batches(spark)
    return (substring_dedup.dedup(docs.select(*COLUMNS))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 1, 2, 3 in turn; a document stands as often as the mix takes it."""
    return mixing.apply(docs.select(*COLUMNS))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of every document, as digests of the ids and of the round trip."""
    import public_tokenizers as public

    bounded_batches(spark)
    ranks = public.path("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(docs, ranks, public.PATTERN, round_trip=True))


STAGES = [
    ("language ID", identify_language),
    ("n-gram Jaccard join", join_near_duplicates),
    ("substring dedup", remove_repeated_passages),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode_tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    root = f"{checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for n, (_, stage) in enumerate(STAGES):
        path = f"{root}/{n}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
