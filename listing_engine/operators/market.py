"""Market statistics documented by the reference.

All are keyed aggregations or windows; the per-listing price history (J3)
uses a two-level lag so that a listing with a huge number of changes is
ordered in id buckets (many tasks) rather than in one window partition.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import payload, truthy_flag, with_numbers

# Width (in change ids) of the buckets of the two-level lag.
LAG_BUCKET_WIDTH = 1_000_000


def price_stats(flat: DataFrame) -> DataFrame:
    """Median (interpolating, exact) and mean price per car.  The exact
    median keeps a value -> count map per group, so its memory follows the
    distinct prices of a group, not its rows."""
    return flat.filter(F.col("price").isNotNull()).groupBy("mark", "model", "year").agg(
        F.median("price").alias("median_price"),
        F.avg("price").alias("avg_price"),
        F.count(F.lit(1)).cast("bigint").alias("listings"))


def change_prices(changes: DataFrame) -> DataFrame:
    """Price observations of a change feed: `price` or `new_price` of each
    payload (the later key of the two wins, as in the merge)."""
    return with_numbers(changes, {"price": "price"}, as_type="bigint", new_keys=True).select(
        "id", "inner_id", "change_type", "created_at", "price")


def observed_prices(changes: DataFrame) -> DataFrame:
    """The changes that name a price.  Rows without one are dropped by an
    explode, not by a filter: a filter would be pushed below the projections
    and repeat the payload's parse in its condition."""
    rows = change_prices(changes)
    return rows.select(*rows.columns[:-1], F.explode(F.array_compact(F.array("price"))).alias("price"))


def lag_within_key(df: DataFrame, key: str, order: str, value: str, out: str = "prev",
                   bucket_width: int = LAG_BUCKET_WIDTH) -> DataFrame:
    """`lag(value)` over `key` ordered by `order`, in two levels: a window
    per (key, order bucket), then the last value of the previous non-empty
    bucket carried in through a small per-bucket window."""
    b = F.floor(F.col(order) / F.lit(bucket_width))
    w1 = Window.partitionBy(key, "_b").orderBy(order)
    inner = df.withColumn("_b", b).withColumn("_prev", F.lag(value).over(w1)) \
        .withColumn("_first", F.row_number().over(w1) == 1)
    last = df.withColumn("_b", b).groupBy(key, "_b").agg(F.max_by(value, order).alias("_last"))
    carry = last.withColumn("_carry", F.lag("_last").over(Window.partitionBy(key).orderBy("_b"))) \
        .select(key, "_b", "_carry")
    return inner.join(carry, [key, "_b"], "left") \
        .withColumn(out, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))) \
        .drop("_b", "_prev", "_first", "_carry")


def price_changes(changes: DataFrame, bucket_width: int = LAG_BUCKET_WIDTH) -> DataFrame:
    """Every price observation with the previous one of its listing and
    the difference."""
    obs = observed_prices(changes)
    j = lag_within_key(obs, "inner_id", "id", "price", "prev_price", bucket_width)
    return j.withColumn("delta", F.col("price") - F.col("prev_price"))


def exposure(changes: DataFrame) -> DataFrame:
    """For each removed listing, first seen, removal time, days exposed
    and the last price seen before removal (aggregates only, skew-safe)."""
    p = change_prices(changes)
    removed = F.col("change_type") == "removed"
    agg = p.groupBy("inner_id").agg(
        F.min("created_at").alias("first_seen"),
        F.max(F.when(removed, F.col("created_at"))).alias("removed_at"),
        F.max(F.when(removed, F.col("id"))).alias("removed_id"),
        F.max_by("price", F.when(F.col("price").isNotNull(), F.col("id"))).alias("last_price"),
    )
    return agg.filter(F.col("removed_at").isNotNull()).withColumn(
        "days_exposed", F.datediff(F.to_date("removed_at"), F.to_date("first_seen")))


def price_trend(changes: DataFrame, days: int = 7) -> DataFrame:
    """Mean observed price per day and its moving mean over `days`
    days (the window runs over per-day rows only)."""
    daily = observed_prices(changes).groupBy(
        F.to_date("created_at").alias("day")).agg(F.avg("price").alias("avg_price"),
                                                    F.count(F.lit(1)).cast("bigint").alias("observations"))
    w = Window.orderBy("day").rowsBetween(-(days - 1), 0)
    return daily.withColumn("moving_avg_price", F.avg("avg_price").over(w))


def popularity(flat: DataFrame, k: int | None = None) -> DataFrame:
    """Listings per (mark, model), most popular first."""
    out = flat.groupBy("mark", "model").agg(F.count(F.lit(1)).cast("bigint").alias("listings"))
    return out.orderBy(F.col("listings").desc(), "mark", "model").limit(k) if k else out


def delisted_on(changes: DataFrame, day: dt.date) -> DataFrame:
    """Listings removed on `day`."""
    return changes.filter((F.col("change_type") == "removed") & (F.to_date("created_at") == F.lit(day)))


def seller_fields(raw: DataFrame) -> DataFrame:
    """seller_type, salon_id and the dealer flag (`true` / `1` / `yes`)."""
    m = payload("data")
    return raw.select("inner_id",
                      F.try_variant_get(m["seller_type"], "$", "string").alias("seller_type"),
                      F.try_variant_get(m["salon_id"], "$", "string").alias("salon_id"),
                      truthy_flag(m["is_dealer"]).alias("is_dealer"))



def price_sketches(prices: DataFrame, keys: list[str], day: str = "day", price: str = "price", k: int = 200) -> DataFrame:
    """J1, mergeable: a KLL quantile sketch of the prices per car and day.

    Sketches of a few kilobytes add up to any span of days or set of cars
    (`merged_prices`) without the listings being read again."""
    return (prices.where(F.col(price).isNotNull()).groupBy(*keys, day)
            .agg(F.kll_sketch_agg_bigint(F.col(price).cast("bigint"), F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n")))


def merged_prices(sketches: DataFrame, keys: list[str], shares: tuple[float, ...] = (0.5,)) -> DataFrame:
    """Price quantiles of `keys` from the sketches of their days: n and `quantiles`.

    With k = 200 a quantile's rank is off by under RANK_ERROR of n (the bound
    holds with 99 % confidence; up to k values a sketch is exact)."""
    whole = sketches.groupBy(*keys).agg(F.kll_merge_agg_bigint("sketch").alias("sketch"), F.sum("n").alias("n"))
    return whole.select(*keys, "n", F.array(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(s)) for s in shares]).alias("quantiles"))


RANK_ERROR = 0.0165  # of one quantile, for k = 200 (published for this sketch)
