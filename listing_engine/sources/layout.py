"""A flat table laid out for serving (C6, F8): what a filter can skip, it skips.

Files are cut by a bucket of the key, as a partition column, so a point lookup
lists one folder.  The text facets are also stored in lower case and each
bucket is sorted by them, so an equality on a facet is a plain comparison that
Parquet's row-group statistics answer; number ranges are pushed down as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .stores import bucket_of

FACETS = ("mark", "model", "transmission_type", "color", "body_type", "engine_type")
RANGES = ("year", "km_age", "price")
ROWS_PER_BUCKET = 1_000_000


def facet_key(name: str) -> str:
    return f"{name}_key"


def write_layout(flat: DataFrame, path: str, buckets: int, key: str = "inner_id") -> None:
    """Write `flat` in `buckets` folders, each sorted by the lower-cased facets."""
    keyed = flat.withColumns({facet_key(c): F.lower(c) for c in FACETS}).withColumn("bucket", bucket_of(F.col(key), buckets))
    (keyed.repartition(buckets, "bucket").sortWithinPartitions("bucket", *map(facet_key, FACETS))
     .write.mode("overwrite").partitionBy("bucket").parquet(path))


def stored_offers(spark: SparkSession, path: str, **filters) -> DataFrame:
    """C6 on a layout: the filters of `serving.filter_offers`, as predicates
    that reach the scan.  A falsy argument means no filter."""
    rows = spark.read.parquet(path)
    for c in FACETS:
        if filters.get(c):
            rows = rows.where(F.col(facet_key(c)) == F.lit(str(filters[c]).lower()))
    for c in RANGES:
        if filters.get(f"{c}_from"):
            rows = rows.where(F.col(c) >= filters[f"{c}_from"])
        if filters.get(f"{c}_to"):
            rows = rows.where(F.col(c) <= filters[f"{c}_to"])
    return rows.drop("bucket", *map(facet_key, FACETS))


def stored_offer(spark: SparkSession, path: str, value: str, buckets: int, key: str = "inner_id") -> DataFrame:
    """F8 on a layout: one folder is read."""
    b = spark.range(1).select(bucket_of(F.lit(value), buckets).alias("b")).first()["b"]
    return spark.read.parquet(path).where((F.col("bucket") == b) & (F.col(key) == value)).drop("bucket", *map(facet_key, FACETS))
