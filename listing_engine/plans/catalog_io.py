"""Registered queries of the readers, stores, streams and jobs.

They land the driver tables as page files (with seeded damage where the point
is what a reader does with it), run the library over them and return what a
user reads back.  Every file goes to the session's shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quality import reject_reason
from ..functions.scalars import event_time
from ..operators import flat as FL
from ..operators import mining as MI
from ..operators import serving as SV
from ..operators.normalise import normalise_rows
from ..session import ensure_runtime_confs, written_out
from ..sources import dictionary_io as DI
from ..sources import pages as PG
from ..sources import reports as RP
from ..sources import stores as ST
from ..streaming import apply as SA
from . import adapters as A
from . import jobs as J
from .catalog import (CURRENT_YEAR, _fold, _mined, _mined_with_flat, _scratch, code_point_translator, mining_dictionary, raw_view,
                      snapshot_flat)

# Damage of the landed feed: pages (of 20 change ids) whose text breaks off,
# and records whose id is not a number.
BAD_PAGE, BAD_PAGE_OF = 7, 50
BAD_RECORD, BAD_RECORD_OF = 77, 100
NO_BUDGET = 1 << 40


def _damaged_feed(spark: SparkSession, sf: str, root: str) -> str:
    PG.write_change_pages(A.change_feed(spark, sf), f"{root}/whole", 20)
    pages = spark.read.text(f"{root}/whole")
    number = F.floor(F.get_json_object("value", "$.meta.cur_change_id").cast("long") / 20)
    bad = number % BAD_PAGE_OF == BAD_PAGE
    text = F.when(bad, F.expr("substring(value, 1, length(value) - 10)")).otherwise(
        F.regexp_replace("value", r'\{"id":(\d*77),', '{"id":"x$1",'))
    pages.select(text.alias("value")).write.text(f"{root}/pages")
    return f"{root}/pages"


def q50_page_bad_records(spark, sf):
    """A2 + A6: what a read of the damaged feed keeps and what it sets aside."""
    path = _damaged_feed(spark, sf, _scratch(spark, "damaged"))
    read = PG.load_change_pages(spark, path, A.RUN_TIME, multi_line=False, budget=NO_BUDGET)
    return (read.records.select(F.lit("good").alias("kind")).unionByName(read.left_out.select("kind"))
            .groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.lit(read.counters["bad_pages"]).cast("long").alias("bad_pages")))


def q51_stream_bad_page(spark, sf):
    """A3 + A6 + H2: the damaged feed as a stream; the good records are
    folded into the store, the bad ones are in the table next to it."""
    ensure_runtime_confs(spark)
    root = _scratch(spark, "stream-damaged")
    store = ST.raw_store(spark, f"{root}/raw")
    store.replace(A.snapshot_raw(spark, sf))
    SA.stream_apply(spark, _damaged_feed(spark, sf, root), store, f"{root}/checkpoint", A.RUN_TIME,
                    multi_line=False, budget=NO_BUDGET)
    aside = SA.left_out(spark, store.path).groupBy("kind").agg(F.count(F.lit(1)).cast("int").alias("n"))
    return raw_view(store.read()).unionByName(aside.select(
        F.concat(F.lit("bad "), "kind").alias("inner_id"), F.lit(None).cast("int").alias("price"),
        F.lit(None).cast("int").alias("km_age"), F.col("n").alias("active_status"), F.lit("aside").alias("change_type")))


def q52_store_merge(spark, sf):
    """The snapshot in a store, then the rows the feed touched merged twice
    under one batch id (the second time is a replay and changes nothing)."""
    store = ST.raw_store(spark, f"{_scratch(spark, 'store')}/raw", buckets=16)
    store.replace(A.snapshot_raw(spark, sf))
    touched = _fold(spark, sf).touched
    store.merge(touched, batch_id=0)
    store.merge(touched.withColumn("active_status", F.lit(9)), batch_id=0)
    return raw_view(store.read())


def q53_offer_pages(spark, sf):
    """A1 + A5 + B17: the snapshot as offer pages, the first five read back;
    some records have no change type or no payload."""
    path = _scratch(spark, "offers")
    s = A.listing_snapshot(spark, sf)
    page = (F.floor(F.col("id") / 20) + 1).cast("int")
    record = F.struct("id", "inner_id", F.when(F.col("id") % 3 != 0, F.col("change_type")).alias("change_type"),
                      F.lit("2024-01-01T00:00:00Z").alias("created_at"),
                      F.when(F.col("id") % 4 != 0, F.col("data")).alias("data"))
    (s.groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(record)).alias("result"))
     .select(F.to_json(F.struct("result", F.struct("page", (F.col("page") + 1).alias("next_page"),
                                                   F.lit(20).alias("limit")).alias("meta"))).alias("value"))
     .write.text(path))
    records, _ = PG.read_offer_pages(spark, path, A.RUN_TIME, max_pages=5, multi_line=False)
    return records.groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"),
                                       F.count_if(F.col("change_type") == "added").alias("added"),
                                       F.count_if(F.col("data") == "{}").alias("without_payload"))


def q54_sync_state(spark, sf):
    """A9 + H4 + C7: the cursor after the first and the last day of the feed."""
    path = _scratch(spark, "state")
    days = A.change_feed(spark, sf).groupBy(F.to_date("created_at").alias("day")).agg(F.max("id").alias("last"))
    first, last = (days.agg(f(F.struct("day", "last")).alias("d")).first().d for f in (F.min, F.max))
    ST.advance_sync_state(spark, path, first.day, first["last"] + 1, A.SNAPSHOT_TIME)
    before = SV.already_done(ST.read_sync_state(spark, path), last.day)
    ST.advance_sync_state(spark, path, last.day, last["last"] + 1, A.RUN_TIME)
    state = ST.read_sync_state(spark, path)
    return state.select("last_successful_date", "last_change_id", F.lit(before).alias("done_before"),
                        F.lit(SV.already_done(state, last.day)).alias("done_after"))


def _stores(spark, root):
    return ST.raw_store(spark, f"{root}/raw"), ST.flat_store(spark, f"{root}/flat")


def q55_daily_update(spark, sf):
    """I2 + I1 + A8 + D7: the landed feed over the loaded snapshot; the flat
    store afterwards, with the processed flag of each raw row."""
    ensure_runtime_confs(spark)
    root = _scratch(spark, "daily")
    raw, flat = _stores(spark, root)
    raw.replace(A.snapshot_raw(spark, sf))
    PG.write_change_pages(A.change_feed(spark, sf), f"{root}/pages", 20)
    J.daily_update(spark, f"{root}/pages", raw, flat, A.seed_dictionary(spark), f"{root}/state", A.RUN_TIME,
                   log_path=f"{root}/log", multi_line=False)
    return flat.read().select("inner_id", "price", "km_age", "active_status").join(
        raw.read().select("inner_id", "is_processed"), "inner_id", "full_outer")


def q56_run_journal(spark, sf):
    """A10 + F5: the journal of a run, a skipped second run of the same day
    (no row) and a run that fails (an ERROR row)."""
    root = _scratch(spark, "journal")
    raw, flat = _stores(spark, root)
    raw.replace(A.snapshot_raw(spark, sf))
    PG.write_change_pages(A.change_feed(spark, sf), f"{root}/pages", 20)
    run = lambda pages, state: J.daily_update(
        spark, pages, raw, flat, A.seed_dictionary(spark), state, A.RUN_TIME, skip_normalise=True,
        log_path=f"{root}/log", multi_line=False)
    run(f"{root}/pages", f"{root}/state")
    run(f"{root}/pages", f"{root}/state")
    try:
        run(f"{root}/nowhere", f"{root}/other-state")
    except Exception:  # noqa: BLE001 - the point is the row it leaves
        pass
    return ST.read_runs(spark, f"{root}/log").groupBy("operation_type", "status").agg(F.count(F.lit(1)).alias("runs"))


def q57_report_text(spark, sf):
    """A13 + F2: the lines of the text report."""
    mined = _mined(spark, sf)
    entries = MI.new_entries(mined)
    return RP.untranslated_report_lines(entries, MI.text_frequency(mined), top=5).select("line")


def q58_dictionary_files(spark, sf):
    """A11 + A14: mined entries with a translation written out and read as a dictionary."""
    mined, flat = _mined_with_flat(spark, sf)
    entries = MI.new_entries(mined).withColumn("translation", F.concat(F.lit("T:"), "text"))
    path = _scratch(spark, "dictionary")
    RP.write_mining_report(entries, MI.mining_metadata(flat, mined), MI.priority_summary(entries),
                           path, A.RUN_TIME.isoformat())
    return DI.read_dictionary(spark, path).select("cn", "ru")


def q59_preview(spark, sf):
    """The first three listings."""
    return RP.preview(snapshot_flat(spark, sf)).select("id", "mark", "year", "n_options", F.array_join("first_options", "|").alias("options"))


def q60_passthrough_images(spark, sf):
    """B1 + B6: url and images of every part's payload."""
    return snapshot_flat(spark, sf).select("inner_id", "url", "vin", "description", F.array_join("images", "|").alias("images"))


def q61_rejected(spark, sf):
    """C3 + C4 + E10: payloads of wrong shapes and numbers out of range."""
    p = A.read(spark, sf, "part")
    case = F.col("p_size") % 6
    data = (F.when(case == 0, F.lit("[1]")).when(case == 1, F.lit('{"extra":5}'))
            .when(case == 2, F.lit('{"extra":{"option":7}}')).when(case == 3, F.lit('{"year":"1880"}'))
            .when(case == 4, F.lit('{"price":"999999999"}')).otherwise(F.lit('{"year":"2020"}')))
    raw = A.snapshot_raw(spark, sf).drop("data").join(
        p.select(F.col("p_partkey").cast("string").alias("inner_id"), data.alias("data")), "inner_id")
    n = normalise_rows(raw, A.seed_dictionary(spark), CURRENT_YEAR)
    return n.rejected.groupBy("stage", "reason").agg(F.count(F.lit(1)).alias("n")).unionByName(
        n.rows.groupBy().agg(F.lit("accepted").alias("stage"), F.lit("").alias("reason"), F.count(F.lit(1)).alias("n")))


def q62_event_time(spark, sf):
    """Order dates as texts with offsets, without one, and unreadable."""
    o = A.read(spark, sf, "orders")
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    case = F.col("o_orderkey") % 4
    shown = (F.when(case == 0, F.concat(text, F.lit("+03:00"))).when(case == 1, F.concat(text, F.lit("Z")))
             .when(case == 2, text).otherwise(F.lit("soon")))
    return o.select("o_orderkey", F.date_format(event_time(shown, A.RUN_TIME), "yyyy-MM-dd HH:mm:ss").alias("at"))


def q63_pending_batch(spark, sf):
    """C1 + F4: the first 50 pending rows by id."""
    raw = A.snapshot_raw(spark, sf).withColumn("is_processed", F.col("id") % 2 == 0)
    return FL.pending(raw, 50).select("id", "inner_id")


def q64_min_count(spark, sf):
    """New texts with at least ten occurrences."""
    return MI.new_entries(_mined(spark, sf), min_count=10).select("field", "text", "count")


def q65_stream_day_stats(spark, sf):
    """H5 (stream): change counters per day over the landed pages."""
    root = _scratch(spark, "day-stats")
    PG.write_change_pages(A.change_feed(spark, sf), f"{root}/pages", 20)
    stats = SA.stream_change_stats(PG.stream_change_pages(spark, f"{root}/pages", A.RUN_TIME, multi_line=False))
    query = (stats.writeStream.outputMode("complete").option("checkpointLocation", f"{root}/checkpoint")
             .trigger(availableNow=True)
             .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(f"{root}/out")).start())
    query.awaitTermination()
    return spark.read.parquet(f"{root}/out").select(F.to_date("day.start").alias("day"), "added", "changed", "removed", "events")


def q66_daily_export(spark, sf):
    """The parts as a pipe-separated export, read back."""
    path = _scratch(spark, "export")
    p = A.read(spark, sf, "part")
    p.select(F.col("p_partkey").cast("string"), F.lit("added"), F.lit("2024-01-01"), F.lit("u"), "p_brand", "p_type",
             F.lit("2020"), F.round("p_retailprice").cast("int").cast("string"), F.lit("1")) \
        .write.option("sep", "|").csv(path)
    return RP.read_daily_export(spark, path).select("inner_id", "mark", "model", "price")


def q67_enrich_once_applied(spark, sf):
    """I5 (real run): the dictionary is extended and the listings re-translated."""
    ensure_runtime_confs(spark)
    flat = written_out(snapshot_flat(spark, sf).withColumn("updated_at", F.lit(A.SNAPSHOT_TIME).cast("timestamp_ntz")))
    out = J.enrich_once(A.snapshot_raw(spark, sf), flat, A.seed_dictionary(spark), code_point_translator, A.RUN_TIME,
                        CURRENT_YEAR, auto_add=True, auto_retranslate=True)
    return MI.record_has_han(out["flat"]).agg(
        F.count(F.lit(1)).alias("listings"), F.count_if("has_han").alias("with_han"),
        F.count_if(F.col("model").rlike("U[0-9A-F]{4}")).alias("retranslated_models"))


def q68_unvalidated_retranslate(spark, sf):
    """Listings whose numbers validation would reject are re-translated all the same."""
    raw = A.snapshot_raw(spark, sf).withColumn("data", F.regexp_replace("data", r'"price":"[^"]*"', '"price":"999999999"'))
    flat = written_out(snapshot_flat(spark, sf).withColumn("updated_at", F.lit(A.SNAPSHOT_TIME).cast("timestamp_ntz")))
    table, _ = FL.retranslate(flat, raw, mining_dictionary(spark), A.RUN_TIME, fields=["model", "price"])
    return table.select("inner_id", "model", "price")


def q69_range_check(spark, sf):
    """C3 on stored rows: flat rows that this year's ranges would reject."""
    flat = snapshot_flat(spark, sf)
    return flat.select(F.coalesce(reject_reason(2018), F.lit("ok")).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


IO_QUERIES = {name: fn for name, fn in sorted(globals().items()) if name.startswith("q") and name[1:3].isdigit()}
