"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame
over the whole driver tables (through `adapters`).  Names match the keys of
`oracles.ORACLES`; every computed column is aliased identically there.
Output columns are plain types (arrays and maps are joined to text)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.quality import reject_reason
from ..functions.scalars import (digits_float, digits_int, falsy, flex_date_str, guarded_text, ntz, payload,
                                 with_fields, with_numbers)
from ..operators import changes as C
from ..operators import dictionary as D
from ..operators import flat as FL
from ..operators import market as MK
from ..operators import mining as MI
from ..operators import serving as SV
from ..operators.normalise import normalise_rows, project_payload
from ..schemas import CHANGE_PAGE, TRANSLATED_TEXT_COLUMNS
from ..session import checkpoint_dir, ensure_runtime_confs, written_out
from ..sources import pages as PG
from ..sources import stores as ST
from ..streaming import apply as SA
from . import adapters as A

CURRENT_YEAR = 2026
# Fixed adapter value: one extra entry the mining dictionary knows beyond the
# seed dictionary, so that mining finds known texts left in the flat table.
MINING_EXTRA = [("小型", "Малый")]


def _fold(spark: SparkSession, sf: str) -> C.ChangeResult:
    ensure_runtime_confs(spark)
    return C.apply_changes(A.snapshot_raw(spark, sf), A.change_feed(spark, sf), A.RUN_TIME)


def raw_view(raw: DataFrame) -> DataFrame:
    """The numbers of raw rows, with their status and type."""
    return with_numbers(raw, {"price": "price", "km_age": "km_age"}).select(
        "inner_id", "price", "km_age", "active_status", "change_type")


def snapshot_flat(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_rows(A.snapshot_raw(spark, sf), A.seed_dictionary(spark), CURRENT_YEAR).rows


def config_flat(spark: SparkSession, sf: str) -> DataFrame:
    return normalise_rows(A.config_payloads(spark, sf), A.seed_dictionary(spark), CURRENT_YEAR).rows


def mining_flat(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_flat(spark, sf).unionByName(config_flat(spark, sf))


def mining_dictionary(spark: SparkSession) -> DataFrame:
    return A.seed_dictionary(spark).unionByName(spark.createDataFrame(MINING_EXTRA, "cn string, ru string"))


def _mined(spark, sf):
    """The mined texts, written out: most queries read them several times, and
    they take a pass over all listings."""
    return written_out(MI.mine_untranslated(mining_flat(spark, sf), mining_dictionary(spark)))


def _mined_with_flat(spark, sf):
    """(mined texts, flat rows), for reports that also count the rows: the
    columns mining reads are normalised once."""
    flat = written_out(mining_flat(spark, sf).select("inner_id", *TRANSLATED_TEXT_COLUMNS, "options", "configuration"))
    return written_out(MI.mine_untranslated(flat, mining_dictionary(spark))), flat


# --- change feed -----------------------------------------------------------

def q01_change_fold(spark: SparkSession, sf: str) -> DataFrame:
    """A2 + H1/D2 + B12 + B3: fold the event feed into the part snapshot."""
    return raw_view(_fold(spark, sf).table)


def q02_change_stats(spark, sf):
    """Run counters of the fold."""
    return _fold(spark, sf).stats


def q03_stats_by_day(spark, sf):
    """H5: counters per event day."""
    return C.change_stats_by_day(_fold(spark, sf).events)


def q04_insert_new(spark, sf):
    """D1 + C2: orders as offers keyed by customer; BUILDING customers are
    already loaded; 5-LOW orders arrive without a key."""
    o = A.read(spark, sf, "orders")
    offers = o.select(
        F.col("o_orderkey").alias("id"), F.lit(0).alias("pos"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
        .alias("inner_id"),
        F.lit(None).cast("string").alias("change_type"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.to_json(F.struct(F.col("o_totalprice").alias("price"))).alias("data"))
    c = A.read(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    raw = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("inner_id"))
    rows, _ = C.insert_new(raw, offers, A.RUN_TIME)
    return rows.select("inner_id", "id", "change_type")


def q04b_insert_stats(spark, sf):
    """D1 counters: loaded / skipped / errors."""
    o = A.read(spark, sf, "orders")
    offers = o.select(
        F.col("o_orderkey").alias("id"), F.lit(0).alias("pos"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
        .alias("inner_id"),
        F.lit("added").alias("change_type"), F.col("o_orderdate").cast("timestamp_ntz").alias("created_at"),
        F.lit("{}").alias("data"))
    c = A.read(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    raw = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("inner_id"))
    return C.insert_new(raw, offers, A.RUN_TIME)[1]


# --- scalar functions -------------------------------------------------------

def q05_digits(spark, sf):
    """B3 / B4 on text and numbers derived from every line item."""
    li = A.read(spark, sf, "lineitem")
    data = F.to_json(F.struct(
        F.format_number(F.col("l_extendedprice"), 2).alias("s1"),
        F.concat(F.col("l_quantity").cast("string"), F.lit("万")).alias("s2"),
        F.concat(F.lit("-"), F.col("l_linenumber").cast("string")).alias("s3"),
        F.col("l_extendedprice").alias("n1"),
        F.concat(F.col("l_discount").cast("string"), F.lit("L")).alias("d1"),
        F.concat(F.col("l_tax").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")).alias("d2"),
    ))
    fields = ["s1", "s2", "s3", "n1", "d1", "d2"]
    picked = with_fields(li.select("l_orderkey", "l_linenumber", payload(data).alias("m")), "m", fields)
    v = lambda f: F.col(f"v_{f}")
    k = lambda f: F.col(f"k_{f}")
    return picked.select(
        "l_orderkey", "l_linenumber",
        *[digits_int(v(f), k(f)).cast("bigint").alias(f) for f in ("s1", "s2", "s3", "n1")],
        *[digits_float(v(f), k(f)).alias(f) for f in ("d1", "d2")])


def q06_dates(spark, sf):
    """B5 on date texts derived from every order."""
    o = A.read(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    y, mo, d = F.year("d").cast("string"), F.month("d"), F.dayofmonth("d")
    s1 = F.date_format("d", "yyyy-MM")
    s2 = F.concat_ws("-", y, mo.cast("string"), d.cast("string"))
    s3 = F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T00:00"))
    s4 = F.concat(y, F.lit("-"), F.lpad((mo + (F.col("o_orderkey") % 2) * 12).cast("string"), 2, "0"))
    s5 = F.concat(y, F.lit("-02-"), (d + 10).cast("string"))
    return o.select("o_orderkey", *[flex_date_str(s).alias(n) for s, n in
                                    ((s1, "d1"), (s2, "d2"), (s3, "d3"), (s4, "d4"), (s5, "d5"))])


def q07_truthiness(spark, sf):
    """§1.5: falsy JSON values and what text / int parsing makes of them."""
    p = A.read(spark, sf, "part")
    case = F.col("p_size") % 6
    a = (F.when(case == 0, F.lit('""')).when(case == 1, F.lit("0")).when(case == 2, F.lit('"0"'))
         .when(case == 3, F.lit("[]")).when(case == 4, F.lit("{}")).otherwise(F.lit("0")))
    data = F.concat(F.lit('{"a":'), F.when(case == 5, F.regexp_replace(F.to_json(F.array("p_brand")), r"^\[|\]$", ""))
                    .otherwise(a), F.lit("}"))
    picked = with_fields(p.select("p_partkey", payload(data).alias("m")), "m", ["a"])
    v, k = F.col("v_a"), F.col("k_a")
    return picked.select(F.col("p_partkey").cast("string").alias("inner_id"),
                         falsy(v, k).alias("is_falsy"), guarded_text(v, k).alias("as_text"),
                         digits_int(v, k).try_cast("bigint").alias("as_int"), k.alias("kind"))


def q08_validate(spark, sf):
    """Rejection reasons over payloads derived from every line item."""
    li = A.read(spark, sf, "lineitem")
    raw = li.select(
        F.col("l_orderkey").alias("id"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("inner_id"),
        F.lit(0).alias("active_status"), ntz(A.SNAPSHOT_TIME).alias("created_at"),
        F.to_json(F.struct(
            (F.lit(1880) + F.col("l_quantity") * 3).cast("bigint").alias("year"),
            (F.round(F.col("l_extendedprice") * 100).cast("bigint") * 10).alias("price"),
            (F.col("l_partkey") * 5000).alias("km_age"),
            (F.col("l_suppkey") * 100).alias("power"),
            (F.col("l_tax") * 300).alias("displacement"),
        )).alias("data"))
    pre = project_payload(raw)
    return pre.select(F.coalesce(reject_reason(CURRENT_YEAR), F.lit("ok")).alias("reason")) \
        .groupBy("reason").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


# --- normalisation, translation --------------------------------------------

def q09_translate(spark, sf):
    """I1 + D4 / B2: translated scalar columns of the normalised snapshot."""
    return snapshot_flat(spark, sf).select("inner_id", "mark", "model", "color", "address", "year", "price",
                                           "km_age", "power", "displacement", "first_registration")


def q10_options(spark, sf):
    """B7 + G2: translated, de-duplicated option lists."""
    return snapshot_flat(spark, sf).select("inner_id", F.array_join("options", "|").alias("options"),
                                           F.size("options").alias("n_options"))


def q11_config(spark, sf):
    """Configuration maps per order (ids filtered, last wins)."""
    f = config_flat(spark, sf)
    entries = F.array_sort(F.map_entries("configuration"))
    return f.select("inner_id", F.array_join(F.transform(entries, lambda e: F.concat_ws(
        "=", e["key"], F.concat_ws(":", e["value"]["name"], e["value"]["value"]))), ";").alias("config"))


def q12_flat_upsert(spark, sf):
    """D3: the snapshot normalised into flat, then the folded raw table
    normalised and upserted over it (ids and created_at kept)."""
    flat0 = snapshot_flat(spark, sf).withColumn("updated_at", ntz(A.SNAPSHOT_TIME))
    folded = _fold(spark, sf).table
    rows = normalise_rows(folded, A.seed_dictionary(spark), CURRENT_YEAR).rows
    table, _ = FL.upsert_flat(flat0, rows, A.RUN_TIME)
    return table.select("inner_id", "id", "price", "km_age", "active_status",
                        (F.col("created_at") == ntz(A.SNAPSHOT_TIME)).alias("kept_created"))


# --- mining, dictionary ---------------------------------------------------------

def q13_mine(spark, sf):
    """E1 + G1 + D8: untranslated (field, text) counts with the known flag."""
    return _mined(spark, sf)


def q14_field_totals(spark, sf):
    """E2 over new entries."""
    return MI.field_totals(MI.new_entries(_mined(spark, sf)))


def q15_priority(spark, sf):
    """E4 + B14: new entries per priority."""
    return MI.priority_summary(MI.new_entries(_mined(spark, sf)))


def q15b_mining_metadata(spark, sf):
    """Corpus totals of the mining report."""
    mined, flat = _mined_with_flat(spark, sf)
    return MI.mining_metadata(flat, mined, 1)


def q16_top_texts(spark, sf):
    """top 3 texts per field (salted two-phase ranking)."""
    return MI.top_texts(MI.new_entries(_mined(spark, sf)), k=3).select("field", "text", "count", "rank")


def q17_frequency(spark, sf):
    """E5 + F3: top 5 unknown texts over all fields."""
    return MI.top_frequency(MI.text_frequency(_mined(spark, sf)), k=5)


def q18_dictionary_extend(spark, sf):
    """D9 + B16: candidates from the part types against the seed dictionary."""
    p = A.read(spark, sf, "part")
    cand = p.select(A.han_type(F.col("p_type")).alias("cn"), F.initcap("p_type").alias("ru")).unionByName(
        p.select(F.col("p_brand").alias("cn"), F.lit("x").alias("ru"))).unionByName(
        p.select(A.han_word(F.split("p_name", " ")[0]).alias("cn"),
                 F.when(F.split("p_name", " ")[0] == "red", F.lit("Красный"))
                 .when(F.split("p_name", " ")[0] == "old", F.lit("")).otherwise(F.upper(F.split("p_name", " ")[0]))
                 .alias("ru"))).distinct()
    _, _, classified = D.extend_dictionary(A.seed_dictionary(spark), cand)
    return classified.select("cn", "ru", F.col("class").alias("class"))


def q18b_dictionary_stats(spark, sf):
    """D9 counters."""
    p = A.read(spark, sf, "part")
    cand = p.select(A.han_type(F.col("p_type")).alias("cn"), F.initcap("p_type").alias("ru")).distinct()
    return D.extend_dictionary(A.seed_dictionary(spark), cand, dry_run=True)[1]


# --- status, serving ---------------------------------------------------------------

def q19_status(spark, sf):
    """Processed / unprocessed after the fold over a processed snapshot."""
    raw = A.snapshot_raw(spark, sf).withColumn("is_processed", F.lit(True))
    return SV.processing_status(C.apply_changes(raw, A.change_feed(spark, sf), A.RUN_TIME).table)


def run_log(spark, sf):
    """An operations journal derived from orders (one run per order)."""
    o = A.read(spark, sf, "orders")
    return o.select(
        F.col("o_orderpriority").alias("operation_type"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.make_interval(secs=F.col("o_orderkey") % 86400))
        .alias("started_at"),
        (F.col("o_custkey") % 600).cast("int").alias("duration"),
        F.when(F.col("o_orderstatus") == "F", "ERROR").otherwise("OK").alias("status"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("details"))


def q20_recent_runs(spark, sf):
    """the ten most recent runs."""
    r = SV.recent_runs(run_log(spark, sf), 10)
    return r.select("operation_type", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started_at"),
                    "duration", "status", "details")


def q21_facets(spark, sf):
    """Models per mark."""
    return SV.facets(snapshot_flat(spark, sf)).select("mark", F.array_join("models", "|").alias("models"))


def q22_filter(spark, sf):
    """Case-insensitive mark, year and price ranges."""
    return SV.filter_offers(snapshot_flat(spark, sf), mark="BRAND#3", year_from=2010, price_to=9500) \
        .select("inner_id", "mark", "year", "price")


def q23_offers_page(spark, sf):
    """page 3 of listings with price <= 9800, 20 a page, and next_page."""
    rows, meta = SV.offers_page(snapshot_flat(spark, sf), page=3, size=20, price_to=9800)
    n = meta.first()["next_page"]
    return rows.select("inner_id", "price").withColumn("next_page", F.lit(n).cast("int"))


def q24_changes_page(spark, sf):
    """changes from id 5000, 20 a page, with the next cursor."""
    rows, meta = SV.changes_page(A.change_feed(spark, sf), 5000, 20)
    nxt = meta.first()["next_change_id"]
    return rows.select("id", "inner_id", "change_type").withColumn("next_change_id", F.lit(nxt).cast("bigint"))


def q25_change_id(spark, sf):
    """First change id of every date."""
    return SV.change_ids_by_date(A.change_feed(spark, sf)).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), "change_id")


def q26_offer(spark, sf):
    """F8: point lookup."""
    return SV.offer(snapshot_flat(spark, sf), "17").select("inner_id", "mark", "model", "price")


# --- re-translation, audits ------------------------------------------------------

def q27_retranslate(spark, sf):
    """Rows with Han re-normalised with the mining dictionary."""
    flat = written_out(snapshot_flat(spark, sf).withColumn("updated_at", ntz(A.SNAPSHOT_TIME)))
    table, _ = FL.retranslate(flat, A.snapshot_raw(spark, sf), mining_dictionary(spark), A.RUN_TIME,
                              fields=["model", "color", "options", "no_such_field"])
    return table.select("inner_id", "model", "color", F.array_join("options", "|").alias("options"))


def q28_has_han(spark, sf):
    """C5 + E9: records that still hold Han text, per source."""
    f = MI.record_has_han(mining_flat(spark, sf))
    return f.groupBy(F.substring("inner_id", 1, 1).rlike("[0-9]").alias("from_parts")).agg(
        F.count_if("has_han").cast("bigint").alias("with_han"), F.count(F.lit(1)).cast("bigint").alias("total"))


def q29_orphans(spark, sf):
    """Keys on one side only (flat = snapshot, raw = folded table)."""
    return FL.orphans(snapshot_flat(spark, sf), _fold(spark, sf).table)


# --- market -------------------------------------------------------------------------

def q31_price_stats(spark, sf):
    """Median / mean price per mark, model, year (after the fold)."""
    f = normalise_rows(_fold(spark, sf).table, A.seed_dictionary(spark), CURRENT_YEAR).rows
    return MK.price_stats(f).select("mark", "model", "year", F.round("median_price", 4).alias("median_price"),
                                    F.round("avg_price", 4).alias("avg_price"), "listings")


def q32_exposure(spark, sf):
    """Exposure and last price of removed listings."""
    return MK.exposure(A.change_feed(spark, sf)).select("inner_id", "days_exposed", "last_price")


def q33_price_change(spark, sf):
    """Price changes per listing (two-level lag, narrow buckets here so
    that the carry across buckets is exercised)."""
    return MK.price_changes(A.change_feed(spark, sf), bucket_width=500).select(
        "id", "inner_id", "price", "prev_price", "delta")


def q34_popularity(spark, sf):
    """Listings per mark and model."""
    return MK.popularity(snapshot_flat(spark, sf))


def q35_price_trend(spark, sf):
    """Daily mean price and 7-day moving mean."""
    return MK.price_trend(A.change_feed(spark, sf)).select(
        F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("avg_price", 4).alias("avg_price"),
        "observations", F.round("moving_avg_price", 4).alias("moving_avg_price"))


def q36_delisted(spark, sf):
    """Listings removed on 2024-01-15."""
    return MK.delisted_on(A.change_feed(spark, sf), dt.date(2024, 1, 15)).select("id", "inner_id")


# --- pages, streaming ------------------------------------------------------------

def _scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    import uuid
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def q30_page_gaps(spark, sf):
    """A4: the change feed landed as pages of 20, chain check (gaps and the
    terminal page)."""
    path = _scratch(spark, "pages")
    PG.write_change_pages(A.change_feed(spark, sf), path, 20)
    pages = spark.read.schema(CHANGE_PAGE).json(path)
    return PG.page_chain_gaps(pages.select("meta.*", F.size("result").alias("n")),
                              "cur_change_id", "next_change_id", "n")


def q30b_page_records(spark, sf):
    """A2 + A6 + B10 + B17: landed pages read back from change id 5000."""
    path = _scratch(spark, "pages")
    PG.write_change_pages(A.change_feed(spark, sf), path, 20)
    recs, bad = PG.read_change_pages(spark, path, A.RUN_TIME, from_change_id=5000, multi_line=False)
    return recs.groupBy("change_type").agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                           F.min("id").alias("min_id"), F.max("id").alias("max_id"),
                                           F.lit(bad).cast("bigint").alias("bad_pages"))


def q37_stream_apply(spark, sf):
    """H2 + A3 + A7: the feed replayed as a stream of page files into a raw
    store holding the snapshot; must equal q01."""
    ensure_runtime_confs(spark)
    root = _scratch(spark, "stream")
    SA.land_in_order(A.change_feed(spark, sf), f"{root}/pages", chunks=4)
    store = ST.raw_store(spark, f"{root}/raw")
    store.replace(A.snapshot_raw(spark, sf))
    SA.stream_apply(spark, f"{root}/pages/*", store, f"{root}/checkpoint", A.RUN_TIME, multi_line=False)
    return raw_view(store.read())


def q38_stateful_apply(spark, sf):
    """H3: the feed replayed as 4 groups of page files through keyed state
    (transformWithState), no base rows; equals the closed-form fold."""
    ensure_runtime_confs(spark)
    root = _scratch(spark, "stateful")
    SA.land_in_order(A.change_feed(spark, sf), f"{root}/pages", chunks=4)
    store = ST.raw_store(spark, f"{root}/raw")
    SA.stateful_apply(spark, f"{root}/pages/*", store, f"{root}/checkpoint", A.RUN_TIME, multi_line=False)
    return raw_view(store.read())


def code_point_translator(texts):
    """A deterministic stand-in for a machine translator (I3 hook): every
    Han character becomes `U<code point>`."""
    import re
    return texts.map(lambda t: re.sub("[\u4e00-\u9fff]", lambda m: f"U{ord(m.group(0)):X}", t)
                     if isinstance(t, str) else t)


def q39_enrich(spark, sf):
    """I4 (+ I1, E1, I3, D9, H6, E9): the enrichment loop over parts and
    orders from the seed dictionary until no Han text is left."""
    from . import jobs as J
    ensure_runtime_confs(spark)
    raw = A.snapshot_raw(spark, sf).unionByName(A.config_payloads(spark, sf))
    empty = spark.createDataFrame([], FL.FLAT)
    res = J.enrich(raw, empty, A.seed_dictionary(spark), code_point_translator, A.RUN_TIME, CURRENT_YEAR)
    added = sum(r.get("dict_added", 0) for r in res.rounds)
    left = MI.untranslated_records(res.flat)
    return left.select(F.lit(len(res.rounds)).cast("int").alias("rounds"),
                       F.lit(added).cast("bigint").alias("added"),
                       F.lit(res.dictionary.count()).cast("bigint").alias("dictionary_size"),
                       F.col("records_with_han"))


# --- dictionary, seller fields, translation hook, reports --------------------------

def q40_dictionary_coverage(spark, sf):
    """Distinct mined texts in / not in the mining dictionary."""
    return D.dictionary_coverage(_mined(spark, sf), mining_dictionary(spark))


def q41_translate_cols(spark, sf):
    """D4 standalone: three Han columns of every part through the seed
    dictionary (broadcast hash joins, no shuffle of the part table)."""
    p = A.read(spark, sf, "part")
    words = F.split("p_name", " ")
    df = p.select(F.col("p_partkey").cast("string").alias("inner_id"), A.han_type(F.col("p_type")).alias("model"),
                  A.han_word(words[0]).alias("color"), A.han_word(words[1]).alias("option"))
    return D.translate_cols(df, ["model", "color", "option"], A.seed_dictionary(spark))


def q42_seller_fields(spark, sf):
    """Seller fields of payloads derived from every customer."""
    c = A.read(spark, sf, "customer")
    flag = (F.when(F.col("c_custkey") % 4 == 0, F.lit("yes")).when(F.col("c_custkey") % 4 == 1, F.lit("TRUE"))
            .when(F.col("c_custkey") % 4 == 2, F.lit("1")).otherwise(F.lit("no")))
    raw = c.select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("inner_id"),
                   F.to_json(F.struct(F.col("c_mktsegment").alias("seller_type"),
                                      F.col("c_nationkey").alias("salon_id"), flag.alias("is_dealer"))).alias("data"))
    return MK.seller_fields(raw)


def identity_translator(texts):
    """A translator that returns its input (I3 hook): acceptance then rests
    on the field and on non-Han characters alone (B15)."""
    return texts


def q43_translate_texts(spark, sf):
    """I3 + B15: every new entry through the hook, with its acceptance."""
    from . import jobs as J
    entries, _ = J.translate_texts(MI.new_entries(_mined(spark, sf)), identity_translator)
    return entries.select("field", "text", "translation", "accepted")


def q44_mining_report(spark, sf):
    """A12 written, then A14 read back: the report's entries."""
    from ..sources import dictionary_io as DI
    from ..sources import reports as RP
    mined, flat = _mined_with_flat(spark, sf)
    entries = MI.new_entries(mined)
    path = _scratch(spark, "report")
    RP.write_mining_report(entries, MI.mining_metadata(flat, mined), MI.priority_summary(entries),
                           path, A.RUN_TIME.isoformat())
    return DI.read_mined_file(spark, path)


def q45_enrich_once(spark, sf):
    """I5 (dry run): mine with the seed dictionary, translate, count what
    would be added."""
    from . import jobs as J
    flat = mining_flat(spark, sf)
    out = J.enrich_once(None, flat, A.seed_dictionary(spark), code_point_translator, A.RUN_TIME, CURRENT_YEAR,
                        dry_run=True)
    return spark.createDataFrame([(out["new_entries"], out["translated"], out["dict_added"])],
                                 "new_entries long, translated long, dict_added long")


QUERIES = {name: fn for name, fn in sorted(globals().items()) if name.startswith("q") and name[1:3].isdigit()}
