"""Raw payload -> flat typed rows (the projection part of I1), with the
dictionary lookups of B2 / B7 / B8 (D4, D4b).

Plan shape, chosen for scale:

1. the raw rows are dealt by the listing key, whatever files or tasks they
   came from; one narrow projection parses each payload once (`from_json` into
   MAP<STRING,VARIANT>) and derives every typed column, the untranslated
   option list and configuration entries, and the quarantine reason (C4);
2. quarantined and out-of-range (C3) rows are split off before any lookup;
3. every text to translate (9 scalar slots, each option, each configuration
   name / value) becomes one row of a long table; the dictionary is joined
   once (a broadcast hash join when its size is proven small);
4. one `groupBy(inner_id)` rebuilds each listing: scalar slots, the option
   list (translated, then de-duplicated in first-seen order) and the
   configuration map (repeat id: first position, last value).

So with a broadcast dictionary the whole normalisation costs a single shuffle,
that of the payloads, keyed by the unique listing key (no hot keys): the
regroup finds its rows where they are.  No Python runs in the plan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.quality import quarantine_reason_of, reject_reason
from ..schemas import TRANSLATED_TEXT_COLUMNS
from ..session import ensure_runtime_confs
from .dictionary import lookup_side

TEXT = TRANSLATED_TEXT_COLUMNS
INT_FIELDS = ("year", "price", "km_age", "power")

# Columns carried unchanged through the translation regroup.
PASSTHROUGH = ["id", "active_status", "created_at", "url", "year", "price", "km_age", "offer_created",
               "description", "displacement", "vin", "first_registration", "power", "images",
               "quarantine_reason", "reject_reason"]

FLAT_ORDER = ["id", "inner_id", "active_status", "created_at", "url", "mark", "model", "year", "color", "price",
              "km_age", "engine_type", "transmission_type", "body_type", "address", "section", "offer_created",
              "description", "displacement", "vin", "first_registration", "power", "drive_type", "images",
              "options", "configuration"]


SCALAR_FIELDS = ["url", *TEXT, *INT_FIELDS, "offer_created", "description", "displacement", "vin",
                 "first_registration", "images", "extra", "configuration"]


_COLUMN_CACHE: dict = {}


def _projection_columns(spark) -> tuple[list, list, list, list, list]:
    """The projection stages' column lists.  Columns are unresolved
    expressions, so they are built once per session (building them costs
    thousands of gateway calls) and reused by every normalise plan."""
    key = id(spark.sparkContext)
    if key in _COLUMN_CACHE:
        return _COLUMN_CACHE[key]
    m = F.col("m")
    v = lambda f: F.col(f"v_{f}")
    k = lambda f: F.col(f"k_{f}")
    picked = [*[m[f].alias(f"v_{f}") for f in SCALAR_FIELDS],
              *[S.vkind(m[f]).alias(f"k_{f}") for f in SCALAR_FIELDS]]
    opt_display, opt_groups = S.option_entries(F.col("v_extra"))
    options = [F.try_variant_get(F.col("v_extra"), "$.option", "variant").alias("v_option"),
               opt_display.alias("o_display"), opt_groups.alias("o_groups"),
               F.try_variant_get(F.col("v_extra"), "$.configuration", "variant").alias("v_nested")]
    option_kind = [S.vkind(F.col("v_option")).alias("k_option"), S.vkind(F.col("v_nested")).alias("k_nested")]
    config_items = [S.config_items(S.config_source(v("configuration"), k("configuration"), k("extra"), v("nested"),
                                                      k("nested"))).alias("c_items")]
    used = S.option_used(v("extra"), k("extra"), v("option"), k("option"))
    final = [
        S.pass_text(v("url")).alias("url"),
        *[S.guarded_text(v(c), k(c)).alias(c) for c in TEXT],
        *[S.digits_int(v(c), k(c)).alias(c) for c in INT_FIELDS],
        S.flex_date(v("offer_created"), k("offer_created")).alias("offer_created"),
        S.pass_text(v("description")).alias("description"),
        S.digits_float(v("displacement"), k("displacement")).alias("displacement"),
        S.pass_text(v("vin")).alias("vin"),
        S.flex_date(v("first_registration"), k("first_registration")).alias("first_registration"),
        S.image_list(v("images"), k("images")).alias("images"),
        S.option_names_of(F.col("o_display"), F.col("o_groups"), used).alias("options_raw"),
        S.config_entries(F.col("c_items")).alias("config_raw"),
        quarantine_reason_of(m, v("extra"), k("extra"), k("option"), used, F.col("o_display"),
                             F.col("o_groups")).alias("quarantine_reason"),
    ]
    _COLUMN_CACHE[key] = (picked, options, option_kind, config_items, final)
    return _COLUMN_CACHE[key]


def project_payload(raw: DataFrame) -> DataFrame:
    """Parse and type every payload field (before translation).

    Stages: parse once; pick each field and its JSON kind once (plus the
    option entries, which both the option list and the quarantine checks
    read); derive the typed columns from those.  The optimizer keeps the
    stages apart because their expensive outputs are used more than once."""
    spark = raw.sparkSession
    ensure_runtime_confs(spark)
    picked_cols, option_cols, option_kind, config_items, final_cols = _projection_columns(spark)
    keys = ["id", "inner_id", "active_status", "created_at"]
    parsed = raw.select(*keys, S.payload("data").alias("m"))
    picked = parsed.select(*keys, "m", *picked_cols)
    picked = picked.select("*", *option_cols)
    picked = picked.select("*", *option_kind)
    picked = picked.select("*", *config_items)
    return picked.select(*keys, *final_cols)


def _long_texts(pre: DataFrame) -> DataFrame:
    """One row per text to translate, plus one `row` entry per listing.

    Built with a single `explode` of a per-row array so the payload is parsed
    once (a union of four selects would re-run the projection four times)."""
    row_t = F.struct(*PASSTHROUGH)
    null_s = F.lit(None).cast("string")
    null_row = F.lit(None).cast(pre.select(row_t.alias("r")).schema["r"].dataType)

    def entry(slot, pos, text, text2, cid, row):
        return F.struct(slot.alias("slot"), pos.cast("int").alias("pos"), text.alias("text"),
                        text2.alias("text2"), cid.alias("cid"), row.alias("row"))

    row_entry = F.array(entry(F.lit("row"), F.lit(0), null_s, null_s, null_s, row_t))
    texts = F.concat(
        F.array(*[entry(F.lit(c), F.lit(0), F.col(c), null_s, null_s, null_row) for c in TEXT]),
        F.transform("options_raw", lambda t, i: entry(F.lit("opt"), i, t, null_s, null_s, null_row)),
        F.transform("config_raw", lambda e, i: entry(F.lit("cfg"), i, e["name"], e["value"], e["id"], null_row)),
    )
    # A rejected row keeps only its `row` entry: nothing of it is translated.
    entries = F.when(F.col("reject_reason").isNull(), F.concat(row_entry, texts)).otherwise(row_entry)
    long = pre.select("inner_id", F.explode(entries).alias("e")).select("inner_id", "e.*")
    # A missing scalar or option leaves nothing behind.
    return long.where(F.col("slot").isin("row", "cfg") | F.col("text").isNotNull())


def translate_assemble(pre: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Steps 3-4: one dictionary join over the long table, one regroup.
    `pre` carries `reject_reason`; every listing comes out with it, with the
    number of its raw rows and of those held back."""
    lk = lookup_side(dictionary)
    lk1 = lk.select(F.col("cn").alias("cn1"), F.col("ru").alias("ru1"))
    lk2 = lk.select(F.col("cn").alias("cn2"), F.col("ru").alias("ru2"))
    long = _long_texts(pre)
    # A missing text looks for a word that no dictionary has, another one per
    # listing, so that the many missing ones don't meet on one key.
    none = F.concat(F.lit("\u0000"), F.col("inner_id"))
    long = (long.withColumns({"k1": F.coalesce("text", none), "k2": F.coalesce("text2", none)})
            .join(lk1, F.col("k1") == F.col("cn1"), "left").join(lk2, F.col("k2") == F.col("cn2"), "left"))
    t1 = F.coalesce(F.col("ru1"), F.col("text"))
    t2 = F.coalesce(F.col("ru2"), F.col("text2"))
    slot = F.col("slot")
    g = long.groupBy("inner_id").agg(
        F.first("row", ignorenulls=True).alias("row"),
        F.count("row").alias("raw_rows"),
        F.count("row.reject_reason").alias("rejected_rows"),
        *[F.max(F.when(slot == c, t1)).alias(c) for c in TEXT],
        F.collect_list(F.when(slot == "opt", F.struct(F.col("pos"), t1.alias("t")))).alias("opts"),
        F.collect_list(F.when(slot == "cfg", F.struct(F.col("pos"), F.col("cid").alias("id"),
                                                       t1.alias("name"), t2.alias("value")))).alias("cfg"),
    )
    options = F.array_distinct(F.filter(F.transform(F.array_sort("opts"), lambda o: o["t"]),
                                        lambda t: t.isNotNull() & (t != "")))
    cfg = F.transform(F.array_sort("cfg"), lambda e: F.struct(e["id"].alias("id"), e["name"].alias("name"),
                                                             e["value"].alias("value")))
    out = g.select("inner_id", "row.*", *TEXT, options.alias("options"), S.config_map(cfg).alias("configuration"),
                   "raw_rows", "rejected_rows")
    return out.select(*[F.col(c).try_cast("int").alias(c) if c in INT_FIELDS else F.col(c) for c in FLAT_ORDER],
                      "reject_reason", "raw_rows", "rejected_rows")


def accepted(decided: DataFrame) -> DataFrame:
    """The listings that pass, as flat rows.  The split happens here, above the
    aggregation: a filter placed on the projection would be pushed down through
    it and inline (and later evaluate) the whole payload projection twice."""
    return decided.filter(F.col("reject_reason").isNull()).select(*FLAT_ORDER)


def _dealt(raw: DataFrame) -> DataFrame:
    """The raw rows dealt by key to as many tasks as the session shuffles to.

    A small file is one task's, and a payload takes long to parse.  The number
    is named so that adaptive execution doesn't merge these partitions: it goes
    by their compressed payloads, a small part of what a task makes of them."""
    return raw.repartition(int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions")), "inner_id")


@dataclass
class Normalised:
    rows: DataFrame      # FLAT columns except updated_at, one per accepted raw row
    rejected: DataFrame  # id, inner_id, stage, reason
    decided: DataFrame   # all keys: FLAT columns, reject_reason, raw_rows, rejected_rows


def normalise_rows(raw: DataFrame, dictionary: DataFrame, current_year: int | None,
                   validate: bool = True) -> Normalised:
    """I1 core: raw rows -> validated, translated flat rows.  Without
    `validate` only the quarantine (C4) holds rows back, as D5 wants; a number
    too large for its column is then NULL."""
    reason = F.col("quarantine_reason")
    pre = project_payload(_dealt(raw)).withColumn(
        "reject_reason", F.coalesce(reason, reject_reason(current_year)) if validate else reason)
    rejected = pre.filter(F.col("reject_reason").isNotNull()).select(
        "id", "inner_id",
        F.when(F.col("quarantine_reason").isNotNull(), F.lit("quarantine")).otherwise(F.lit("validation"))
        .alias("stage"),
        F.col("reject_reason").alias("reason"))
    decided = translate_assemble(pre, dictionary)
    return Normalised(rows=accepted(decided), rejected=rejected, decided=decided)
