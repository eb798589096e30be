"""Change feed -> raw table: insert-if-absent (D1), ordered change fold
(H1 / D2), per-day change counts (H5) and the processed-flag reset (H6).

The fold is computed in closed form instead of replaying events one by one:

* the *base* of a key is its existing raw row, else its first recognised
  event (in feed order);
* status is 1 if the base is removed/inactive or any later event is `removed`;
* change_type is the last applied `changed`/`removed`, created_at the last
  applied `changed`, both falling back to the base;
* the payload is a field-wise last-writer-wins over the applied `changed`
  payloads (after the `new_` key mapping), laid over the base payload.

Every step is an aggregation with map-side partial aggregation (`min_by`,
`max_by`, `count_if`) grouped by key or by (key, field); no per-key event
list is ever collected, so one key holding a third of the feed is still
split across tasks until the final (tiny) per-key row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ntz

from ..functions.scalars import map_new_keys, payload
from ..schemas import RAW
from ..session import ensure_runtime_confs

RECOGNISED = ("added", "changed", "removed")


def _now(now) -> Column:
    return ntz(now)


def _with_order(changes: DataFrame) -> DataFrame:
    if "pos" not in changes.columns:
        changes = changes.withColumn("pos", F.lit(0))
    return changes.withColumn("ord", F.struct(F.col("id").cast("bigint").alias("id"),
                                              F.col("pos").cast("int").alias("pos")))


def _has_key(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def empty_base(text: Column) -> Column:
    """Whether a stored payload is missing or an empty JSON value, which an
    update starts afresh from (as from `{}`)."""
    return text.isNull() | F.regexp_replace(text, r"\s", "").isin("null", "{}", "[]", '""', "0", "false")


@dataclass
class ChangeResult:
    table: DataFrame    # whole raw table after the batch
    touched: DataFrame  # new rows of the keys the batch inserted or modified
    events: DataFrame   # every input event with its outcome
    stats: DataFrame    # one row of run counters (E10)


def apply_changes(raw: DataFrame, changes: DataFrame, now, source: str = "daily_update") -> ChangeResult:
    """Fold an ordered change feed into the raw table.

    `changes`: id, inner_id, change_type, created_at (TIMESTAMP_NTZ), data
    (JSON text) and optionally `pos` (position inside the page).
    `now` is a parameter so that results are reproducible."""
    spark = changes.sparkSession
    ensure_runtime_confs(spark)
    now_c = _now(now)
    # The payload of a change is parsed here, and only here.
    ch = _with_order(changes).withColumn("m", F.when(F.col("change_type") == "changed", payload("data")))
    ch = ch.withColumn("obj_ok", (F.col("change_type") != "changed") | F.col("m").isNotNull())
    keyed = ch.filter(_has_key(F.col("inner_id")))
    rec = keyed.filter(F.col("change_type").isin(*RECOGNISED))
    ct = F.col("change_type")
    applied_change = (ct == "changed") & F.col("obj_ok")
    applied_cr = applied_change | (ct == "removed")

    per_key = rec.groupBy("inner_id").agg(
        F.min_by(F.struct("ord", "change_type", "created_at", "data", "obj_ok"), F.col("ord")).alias("first"),
        F.max(ct == "removed").alias("any_removed"),
        F.max_by(ct, F.when(applied_cr, F.col("ord"))).alias("last_cr_type"),
        F.max_by(F.col("created_at"), F.when(applied_change, F.col("ord"))).alias("last_change_at"),
        F.count_if(ct == "added").alias("n_added"),
        F.count_if(applied_change).alias("n_changed_ok"),
        F.count_if((ct == "changed") & ~F.col("obj_ok")).alias("n_changed_bad"),
        F.count_if(ct == "removed").alias("n_removed"),
    )

    # Field-wise last writer over applied `changed` payloads.
    fields = (
        rec.filter(applied_change)
        .select("inner_id", "ord", F.posexplode(map_new_keys(F.col("m"))).alias("p", "key", "value"))
        .groupBy("inner_id", "key")
        .agg(
            F.max_by("value", F.struct("ord", "p")).alias("value"),
            F.max("ord").alias("w"),
            F.min("ord").alias("first_w"),
        )
        .groupBy("inner_id")
        .agg(F.collect_list(F.struct("first_w", "key", "w", "value")).alias("fields"))
    )

    # Joins on the key; Spark broadcasts the key list where its measured size allows.
    key_list = per_key.select("inner_id")
    existing = raw.join(key_list, "inner_id", "left_semi").withColumn("present", F.lit(True))
    existing = existing.select("present", *[F.col(c).alias(f"r_{c}") if c != "inner_id" else F.col(c) for c in raw.columns])
    joined = existing.join(per_key, "inner_id", "right").join(fields, "inner_id", "left")

    exists = F.coalesce(F.col("present"), F.lit(False))
    first = F.col("first")
    absent_base = ~exists
    base_text = F.when(exists, F.col("r_data")).when(first["change_type"] == "removed", F.lit("{}")).otherwise(first["data"])
    # An empty base counts as {}, and an update of it keeps what it brings; a
    # base that is some other value can't be updated: its row is an error.
    base_map = F.when(empty_base(base_text), F.create_map().cast("map<string,variant>")).otherwise(payload(base_text))
    base_ok = base_map.isNotNull()
    overlay = F.filter(F.coalesce(F.col("fields"), F.array()), lambda f: exists | (f["w"] > first["ord"]))
    overlay = F.array_sort(overlay, lambda a, b: F.when(a["first_w"] < b["first_w"], -1)
                           .when(a["first_w"] > b["first_w"], 1).otherwise(0))
    merged = F.map_concat(base_map, F.map_from_entries(F.transform(overlay, lambda f: F.struct(f["key"], f["value"]))))
    n_updates = F.when(base_ok, F.col("n_changed_ok")).otherwise(F.lit(0))
    own = (absent_base & (first["change_type"] == "changed") & first["obj_ok"]).cast("int")
    data = F.when(base_ok & (F.col("n_changed_ok") > own), F.to_json(merged)).otherwise(base_text)

    modified = absent_base | (n_updates + F.col("n_removed") > 0)
    base_status = F.when(exists, F.col("r_active_status")).when(first["change_type"] == "removed", 1).otherwise(0)
    status = F.when(F.col("any_removed"), F.lit(1)).otherwise(base_status)
    base_type = F.when(exists, F.col("r_change_type")).otherwise(first["change_type"])
    base_created = F.when(exists, F.col("r_created_at")).otherwise(first["created_at"])

    result = joined.select(
        "inner_id",
        modified.alias("modified"),
        exists.alias("existed"),
        F.when(exists, F.col("r_id")).otherwise(first["ord"]["id"]).cast("bigint").alias("id"),
        F.coalesce(F.when(base_ok, F.col("last_cr_type")).otherwise(F.when(F.col("any_removed"), F.lit("removed"))),
                   base_type).alias("change_type"),
        F.coalesce(F.when(base_ok, F.col("last_change_at")), base_created).alias("created_at"),
        data.alias("data"),
        F.when(exists, F.col("r_first_loaded_at")).otherwise(now_c).alias("first_loaded_at"),
        F.when(modified, now_c).otherwise(F.col("r_last_updated_at")).alias("last_updated_at"),
        F.when(exists, F.col("r_source")).otherwise(F.lit(source)).alias("source"),
        status.cast("int").alias("active_status"),
        F.when(modified, F.lit(False)).otherwise(F.col("r_is_processed")).alias("is_processed"),
        first["ord"].alias("base_ord"),
        base_ok.alias("base_ok"),
    )

    touched = result.filter("modified").select(*[f.name for f in RAW.fields])
    touched_keys = touched.select("inner_id")
    table = raw.select(*[f.name for f in RAW.fields]).join(touched_keys, "inner_id", "left_anti").unionByName(touched)

    # Per-event outcome: one join of the feed with the small per-key table.
    key_info = result.select("inner_id", "existed", "base_ord", "base_ok")
    ev = ch.drop("m").join(key_info, "inner_id", "left")
    outcome = (
        F.when(~_has_key(F.col("inner_id")), F.lit("error"))
        .when(~F.col("change_type").isin(*RECOGNISED) | F.col("change_type").isNull(), F.lit("ignored"))
        .when(~F.col("existed") & (F.col("ord") == F.col("base_ord")), F.lit("loaded"))
        .when(F.col("change_type") == "added", F.lit("duplicate"))
        .when(F.col("change_type") == "removed", F.lit("removed"))
        .when(~F.col("obj_ok") | ~F.col("base_ok"), F.lit("error"))
        .otherwise(F.lit("updated"))
    )
    events = ev.select("id", "pos", "inner_id", "change_type", "created_at", outcome.alias("outcome"))

    o = F.col("outcome")
    stats = events.agg(
        F.count_if(o == "loaded").cast("bigint").alias("loaded"),
        F.count_if(o == "updated").cast("bigint").alias("updated"),
        F.count_if(o == "removed").cast("bigint").alias("removed"),
        F.count_if(o == "duplicate").cast("bigint").alias("duplicates"),
        F.count_if(o == "error").cast("bigint").alias("errors"),
        F.count_if(o == "ignored").cast("bigint").alias("ignored"),
    )
    return ChangeResult(table=table, touched=touched, events=events, stats=stats)


def insert_new(raw: DataFrame, offers: DataFrame, now, source: str = "initial_load") -> tuple[DataFrame, DataFrame]:
    """D1 (+ C2): keep offers whose key is new; the first offer of a key in
    feed order wins.  Returns (rows to insert, one-row counters)."""
    now_c = _now(now)
    ch = _with_order(offers)
    keyed = ch.filter(_has_key(F.col("inner_id")))
    first = keyed.groupBy("inner_id").agg(
        F.min_by(F.struct("ord", "change_type", "created_at", "data"), F.col("ord")).alias("r"))
    new = first.join(raw.select("inner_id"), "inner_id", "left_anti")
    rows = new.select(
        F.col("r.ord.id").cast("bigint").alias("id"),
        "inner_id",
        F.coalesce(F.col("r.change_type"), F.lit("added")).alias("change_type"),
        F.coalesce(F.col("r.created_at"), now_c).alias("created_at"),
        F.coalesce(F.col("r.data"), F.lit("{}")).alias("data"),
        now_c.alias("first_loaded_at"),
        now_c.alias("last_updated_at"),
        F.lit(source).alias("source"),
        F.lit(0).alias("active_status"),
        F.lit(False).alias("is_processed"),
    )
    winners = new.select("inner_id", F.col("r.ord").alias("win_ord"))
    outcome = (
        F.when(~_has_key(F.col("inner_id")), F.lit("error"))
        .when(F.col("ord") == F.col("win_ord"), F.lit("loaded"))
        .otherwise(F.lit("skipped"))
    )
    o = outcome
    stats = ch.join(winners, "inner_id", "left").agg(
        F.count_if(o == "loaded").cast("bigint").alias("loaded"),
        F.count_if(o == "skipped").cast("bigint").alias("skipped"),
        F.count_if(o == "error").cast("bigint").alias("errors"),
    )
    return rows, stats


def change_stats_by_day(events: DataFrame, time_col: str = "created_at") -> DataFrame:
    """H5: change counters per calendar day of the event time (batch form;
    the streaming form in `streaming.apply` adds a watermark)."""
    o = F.col("outcome")
    return events.groupBy(F.to_date(time_col).alias("day")).agg(
        F.count_if(o == "loaded").cast("bigint").alias("loaded"),
        F.count_if(o == "updated").cast("bigint").alias("updated"),
        F.count_if(o == "removed").cast("bigint").alias("removed"),
        F.count_if(o == "duplicate").cast("bigint").alias("duplicates"),
        F.count_if(o == "error").cast("bigint").alias("errors"),
        F.count_if(o == "ignored").cast("bigint").alias("ignored"),
    )


def reset_processed(raw: DataFrame) -> DataFrame:
    """H6: clear the processed flag on every row (the caller rewrites the store)."""
    return raw.withColumn("is_processed", F.lit(False))
