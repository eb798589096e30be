"""Dictionary operators: lookup (D4 / D4b), extension (D9), coverage.

The dictionary is a two-column DataFrame (cn, ru) with unique `cn`.  Lookups
are exact whole-string matches; a miss returns the original text, NULL stays
NULL.  Lookups are joins on the text; Spark's statistics and adaptive execution
choose between broadcasting the dictionary and a shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import entry_error
from ..session import written_out


def as_lookup(dictionary: DataFrame) -> DataFrame:
    """Unique-key (cn, ru) pairs; a repeated cn keeps its last entry when a
    `pos` column orders them, else the greatest ru (deterministic)."""
    d = dictionary.filter(F.col("cn").isNotNull())
    if "pos" in d.columns:
        return d.groupBy("cn").agg(F.max_by("ru", "pos").alias("ru"))
    return d.groupBy("cn").agg(F.max("ru").alias("ru"))


def lookup_side(dictionary: DataFrame) -> DataFrame:
    """The dictionary prepared as the build side of lookup joins.  It is
    written out, so that its size is known before the join is planned: rows of
    a Python list or of a checkpoint have none, and the texts would be shuffled
    to a handful of entries, the frequent ones all to one task."""
    return written_out(as_lookup(dictionary))


def translate_column(df: DataFrame, col: str, lookup: DataFrame, out: str | None = None) -> DataFrame:
    """D4 for one column: left join on the text, miss -> original."""
    out = out or col
    lk = lookup.select(F.col("cn").alias(f"__cn_{col}"), F.col("ru").alias(f"__ru_{col}"))
    j = df.join(lk, df[col] == lk[f"__cn_{col}"], "left")
    return j.withColumn(out, F.coalesce(F.col(f"__ru_{col}"), F.col(col))).drop(f"__cn_{col}", f"__ru_{col}")


def translate_cols(df: DataFrame, cols: list[str], dictionary: DataFrame) -> DataFrame:
    """Translate several text columns.  With a broadcast dictionary
    each lookup is a hash probe in the same stage (no shuffle of `df`)."""
    lk = lookup_side(dictionary)
    for c in cols:
        df = translate_column(df, c, lk)
    return df


def extend_dictionary(dictionary: DataFrame, new: DataFrame, dry_run: bool = False):
    """Classify each candidate (cn, ru) as error / already_exists /
    conflict / added.  Existing entries are never overwritten.

    Returns (dictionary after the run, one-row stats, classified candidates).
    With `dry_run` the dictionary is returned unchanged."""
    cand = as_lookup(new)
    old = as_lookup(dictionary).select("cn", F.col("ru").alias("old_ru"))
    err = entry_error(F.col("cn"), F.col("ru"))
    cls = (
        F.when(err.isNotNull(), F.lit("error"))
        .when(F.col("old_ru") == F.col("ru"), F.lit("already_exists"))
        .when(F.col("old_ru").isNotNull(), F.lit("conflict"))
        .otherwise(F.lit("added"))
    )
    classified = cand.join(old, "cn", "left").select("cn", "ru", "old_ru", cls.alias("class"), err.alias("error"))
    c = F.col("class")
    stats = classified.agg(
        F.count(F.lit(1)).cast("bigint").alias("total"),
        F.count_if(c == "added").cast("bigint").alias("added"),
        F.count_if(c.isin("already_exists", "conflict")).cast("bigint").alias("skipped"),
        F.count_if(c == "error").cast("bigint").alias("errors"),
        F.count_if(c == "already_exists").cast("bigint").alias("already_exists"),
    )
    if dry_run:
        return dictionary.select("cn", "ru"), stats, classified
    added = classified.filter(c == "added").select("cn", "ru")
    return dictionary.select("cn", "ru").unionByName(added), stats, classified


def dictionary_coverage(mined: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Distinct mined texts that are / are not in the dictionary."""
    lk = lookup_side(dictionary).select(F.col("cn").alias("text"), F.lit(True).alias("known"))
    j = mined.select("text").join(lk, "text", "left")
    return j.agg(
        F.count_distinct(F.when(F.col("known"), F.col("text"))).cast("bigint").alias("known_texts"),
        F.count_distinct(F.when(F.col("known").isNull(), F.col("text"))).cast("bigint").alias("missing_texts"),
    )
