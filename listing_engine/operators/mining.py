"""Untranslated-text mining: counts (E1, G1), totals (E2, E3), priority
summary (E4), cross-field frequency (E5), records with Han (E9), per-field
and global top-k (F1, F3).

One scan of the flat table explodes every candidate text -- 9 text columns,
each option, each configuration name / value with its path -- and a single
`groupBy(field, text)` counts them with map-side partial aggregation, so a
text that occurs in a third of all listings is pre-counted per task before
the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import HAN_CLASS, has_han, priority
from ..schemas import TRANSLATED_TEXT_COLUMNS
from .dictionary import lookup_side

# Salt buckets for the two-phase per-field top-k.
TOPK_SALT = 64


def candidate_texts(flat: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """G1: `keep` columns, field and text of every Han text of every record, bag
    semantics; configuration paths are `configuration.<id>.name|value`."""
    scalar = [F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in TRANSLATED_TEXT_COLUMNS]
    opts = F.transform(F.coalesce(F.col("options"), F.array().cast("array<string>")),
                       lambda o: F.struct(F.lit("options").alias("field"), o.alias("text")))
    cfg_entries = F.coalesce(F.map_entries("configuration"),
                             F.array().cast("array<struct<key:string,value:struct<name:string,value:string>>>"))
    cfg = F.flatten(F.transform(cfg_entries, lambda e: F.array(
        F.struct(F.concat(F.lit("configuration."), e["key"], F.lit(".name")).alias("field"),
                 e["value"]["name"].alias("text")),
        F.struct(F.concat(F.lit("configuration."), e["key"], F.lit(".value")).alias("field"),
                 e["value"]["value"].alias("text")),
    )))
    allt = F.concat(F.array(*scalar), opts, cfg)
    return (flat.select(*keep, F.explode(F.filter(allt, lambda t: t["text"].rlike(HAN_CLASS))).alias("t"))
            .select(*keep, "t.field", "t.text"))


def text_index(flat: DataFrame) -> DataFrame:
    """(text, inner_id): which listings hold a Han text, each pair once."""
    return candidate_texts(flat, ("inner_id",)).select("text", "inner_id").distinct()


def mine_untranslated(flat: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Occurrences per (field, text) with `known` = already in the
    dictionary.  C8 / D8 (drop known, min count) are `new_entries`."""
    counts = candidate_texts(flat).groupBy("field", "text").agg(F.count(F.lit(1)).cast("bigint").alias("count"))
    lk = lookup_side(dictionary).select(F.col("cn").alias("text"), F.lit(True).alias("known"))
    return counts.join(lk, "text", "left").select(
        "field", "text", "count", F.coalesce(F.col("known"), F.lit(False)).alias("known"))


def new_entries(mined: DataFrame, min_count: int = 1) -> DataFrame:
    """C8 + B14: texts not in the dictionary with at least `min_count`
    occurrences, with their priority."""
    return mined.filter(~F.col("known") & (F.col("count") >= min_count)).select(
        "field", "text", "count", priority(F.col("field"), F.col("count")).alias("priority"))


def field_totals(entries: DataFrame) -> DataFrame:
    """Occurrences and distinct texts per field."""
    return entries.groupBy("field").agg(
        F.sum("count").cast("bigint").alias("occurrences"),
        F.count(F.lit(1)).cast("bigint").alias("texts"))


def mining_metadata(flat: DataFrame, mined: DataFrame, min_count: int = 1) -> DataFrame:
    """Records analysed, distinct untranslated texts (all fields),
    known occurrences, new (field, text) entries, the threshold."""
    records = flat.agg(F.count(F.lit(1)).cast("bigint").alias("total_records_analyzed"))
    m = mined.agg(
        F.count_distinct("text").cast("bigint").alias("total_untranslated_unique"),
        F.coalesce(F.sum(F.when(F.col("known"), F.col("count"))), F.lit(0)).cast("bigint").alias("already_in_dict_count"),
        F.count_if(~F.col("known") & (F.col("count") >= min_count)).cast("bigint").alias("new_translations_count"),
    )
    # Both sides are single global aggregates: join them on a constant.
    return records.withColumn("_k", F.lit(1)).join(m.withColumn("_k", F.lit(1)), "_k").drop("_k") \
        .withColumn("min_count_threshold", F.lit(min_count))


def priority_summary(entries: DataFrame) -> DataFrame:
    """Entries per priority (zeros kept)."""
    p = F.col("priority")
    return entries.agg(
        F.count_if(p == "high").cast("bigint").alias("high"),
        F.count_if(p == "medium").cast("bigint").alias("medium"),
        F.count_if(p == "low").cast("bigint").alias("low"))


def text_frequency(mined: DataFrame) -> DataFrame:
    """E5: total occurrences of each unknown text over all fields."""
    return mined.filter(~F.col("known")).groupBy("text").agg(F.sum("count").cast("bigint").alias("total"))


def top_texts(entries: DataFrame, k: int = 20, salt: int = TOPK_SALT) -> DataFrame:
    """the k most frequent texts per field (ties by text).

    Two phases so that one huge field is not ranked in a single task: rank
    inside (field, hash(text) % salt) buckets, keep each bucket's top k, then
    rank the at most salt * k survivors of each field."""
    order = [F.col("count").desc(), F.col("text")]
    bucket = F.pmod(F.xxhash64("text"), F.lit(salt))
    local = entries.withColumn("_b", bucket).withColumn(
        "_r", F.row_number().over(Window.partitionBy("field", "_b").orderBy(*order))).filter(F.col("_r") <= k)
    ranked = local.withColumn("rank", F.row_number().over(Window.partitionBy("field").orderBy(*order)))
    return ranked.filter(F.col("rank") <= k).drop("_b", "_r")


def top_frequency(freq: DataFrame, k: int = 100) -> DataFrame:
    """global top k by total (TakeOrderedAndProject, no full sort)."""
    return freq.orderBy(F.col("total").desc(), F.col("text")).limit(k)


def record_has_han(df: DataFrame) -> DataFrame:
    """C5 as a column `has_han`: any text column, option or configuration
    string has Han (description excluded)."""
    cols = [has_han(c) for c in TRANSLATED_TEXT_COLUMNS]
    opt = F.coalesce(F.exists("options", lambda o: has_han(o)), F.lit(False))
    cfg = F.coalesce(F.exists(F.map_values("configuration"),
                              lambda e: has_han(e["name"]) | has_han(e["value"])), F.lit(False))
    expr = cols[0]
    for c in cols[1:]:
        expr = expr | c
    return df.withColumn("has_han", expr | opt | cfg)


def untranslated_records(flat: DataFrame) -> DataFrame:
    """Number of records passing C5."""
    return record_has_han(flat).agg(F.count_if("has_han").cast("bigint").alias("records_with_han"))
