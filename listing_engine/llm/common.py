"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Words, for the operators whose contract says "not ASCII white space".
SPACE = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


BATCH_BYTES = "4m"


def bounded_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold a few megabytes, where the session has not set a
    bound itself: with long texts the default of 10,000 rows or 64 MB, held in
    and out by the JVM and by each Python worker, is most of an executor."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in (None, "67108864b", "67108864"):
        spark.conf.set(name, BATCH_BYTES)


def words(text: Column) -> Column:
    """The words of a text in order; none for NULL.

    A split leaves an empty string at an end that is white space, and only
    there, so the words are the split without its empty ends.
    """
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE, -1), "")


def let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row.

    Catalyst may copy an expression into every place that uses it; a lambda
    variable is bound once.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
