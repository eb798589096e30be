"""Serving and status queries: facets (E11), first change of a date (E12),
listing filter (C6), listing page (F6), change page (F7), point lookup (F8),
progress counts (E7, E8), recent runs (F5), done-date gate (C7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, written_out

# Listing page sizes (default and ceiling).
DEFAULT_PAGE_SIZE = 20
MAX_PAGE_SIZE = 100
CHANGE_PAGE_SIZE = 20


def facets(flat: DataFrame) -> DataFrame:
    """Each mark with its sorted distinct models (bounded by the model
    count of a mark, merged map-side)."""
    return flat.filter(F.col("mark").isNotNull()).groupBy("mark").agg(
        F.sort_array(F.collect_set("model")).alias("models"))


def facet_values(flat: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values of one facet column."""
    return flat.filter(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def filter_offers(flat: DataFrame, mark=None, model=None, transmission_type=None, color=None, body_type=None,
                  engine_type=None, year_from=None, year_to=None, km_age_from=None, km_age_to=None,
                  price_from=None, price_to=None) -> DataFrame:
    """Case-insensitive equality on text facets, inclusive ranges on
    numbers; a falsy argument means no filter."""
    out = flat
    for col, val in (("mark", mark), ("model", model), ("transmission_type", transmission_type),
                     ("color", color), ("body_type", body_type), ("engine_type", engine_type)):
        if val:
            out = out.filter(F.lower(F.col(col)) == F.lit(str(val).lower()))
    for col, lo, hi in (("year", year_from, year_to), ("km_age", km_age_from, km_age_to),
                        ("price", price_from, price_to)):
        if lo:
            out = out.filter(F.col(col) >= lo)
        if hi:
            out = out.filter(F.col(col) <= hi)
    return out


def offers_page(flat: DataFrame, page: int = 1, size: int = DEFAULT_PAGE_SIZE, key: str = "inner_id",
                **filters) -> tuple[DataFrame, DataFrame]:
    """one page of filtered listings in key order, and a one-row frame
    with `next_page` (NULL on the last page).  The page is a top-(offset +
    size + 1) by key, not a full sort; both results read the rows it found."""
    size = max(1, int(size or DEFAULT_PAGE_SIZE))
    if size > MAX_PAGE_SIZE:
        raise ValueError(f"a page has at most {MAX_PAGE_SIZE} rows, {size} were asked for")
    page = max(1, int(page or 1))
    window = written_out(filter_offers(flat, **filters).orderBy(key).offset((page - 1) * size).limit(size + 1))
    rows = window.orderBy(key).limit(size)
    meta = window.agg(F.when(F.count(F.lit(1)) > size, F.lit(page + 1)).alias("next_page"),
                      F.lit(page).alias("page"), F.lit(size).alias("limit"))
    return rows, meta


def offers_after(flat: DataFrame, after=None, size: int = DEFAULT_PAGE_SIZE, key: str = "inner_id", **filters) -> DataFrame:
    """F6 by a cursor: the `size` listings behind the key `after` (the last one
    of the page before), whose cost doesn't grow with the page number."""
    rows = filter_offers(flat, **filters)
    if after is not None:
        rows = rows.where(F.col(key) > F.lit(after))
    return rows.orderBy(key).limit(max(1, min(int(size or DEFAULT_PAGE_SIZE), MAX_PAGE_SIZE)))


def all_pages(flat: DataFrame, size: int = DEFAULT_PAGE_SIZE, key: str = "inner_id", **filters) -> DataFrame:
    """F6 in bulk: every listing with its `page` (from 1) and `position` (from 0).

    One range partitioning and sort by the key; a row's rank is its place in
    its partition plus the rows of the partitions before, whose counts are a
    row a partition.  No window over all rows, no offset that grows."""
    rows = filter_offers(flat, **filters)
    ranged = cut_lineage(rows.repartitionByRange(key).sortWithinPartitions(key))
    numbered = ranged.withColumn("__id", F.monotonically_increasing_id())  # partition above the place in it
    part, place = F.shiftright("__id", 33).alias("__part"), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (numbered.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
               .select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__offset")))
    placed = numbered.withColumn("__part", F.shiftright("__id", 33)).join(F.broadcast(offsets), "__part")  # a row a partition
    rank = F.col("__offset") + place
    return placed.select(*rows.columns, (F.floor(rank / size) + 1).cast("long").alias("page"), (rank % size).cast("long").alias("position"))


def changes_page(changes: DataFrame, change_id: int, limit: int = CHANGE_PAGE_SIZE) -> tuple[DataFrame, DataFrame]:
    """changes with id >= cursor, `limit` of them, and (cur, next) ids;
    next is the id of the first change not returned (NULL at the end)."""
    window = changes.filter(F.col("id") >= change_id).orderBy("id").limit(limit + 1)
    rows = window.orderBy("id").limit(limit)
    meta = window.agg(
        F.lit(change_id).cast("bigint").alias("cur_change_id"),
        F.when(F.count(F.lit(1)) > limit, F.max("id")).alias("next_change_id"),
        F.lit(limit).alias("limit"))
    return rows, meta


def change_id_for_date(changes: DataFrame, day: dt.date) -> DataFrame:
    """Smallest change id whose event time falls on `day`."""
    return changes.filter(F.to_date("created_at") == F.lit(day)).agg(F.min("id").alias("change_id"))


def change_ids_by_date(changes: DataFrame) -> DataFrame:
    """E12 for every date at once."""
    return changes.groupBy(F.to_date("created_at").alias("day")).agg(F.min("id").alias("change_id"))


def offer(flat: DataFrame, inner_id: str) -> DataFrame:
    """F8: one listing by key (an equality filter; partition/bucket pruning
    applies when the store is bucketed by key)."""
    return flat.filter(F.col("inner_id") == F.lit(inner_id))


def processing_status(raw: DataFrame) -> DataFrame:
    """Processed, unprocessed and total rows."""
    return raw.agg(
        F.count_if(F.col("is_processed")).cast("bigint").alias("processed"),
        F.count_if(~F.col("is_processed")).cast("bigint").alias("unprocessed"),
        F.count(F.lit(1)).cast("bigint").alias("total"))


def recent_runs(log: DataFrame, n: int = 10) -> DataFrame:
    """the last n journal rows by start time."""
    return log.orderBy(F.col("started_at").desc(), F.col("operation_type")).limit(n)


def already_done(state: DataFrame, day: dt.date) -> bool:
    """A run for `day` is skipped when the stored date is >= day."""
    row = state.agg(F.max("last_successful_date").alias("d")).first()
    return bool(row and row.d is not None and row.d >= day)
