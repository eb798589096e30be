"""Adapters that turn the driver's TPC-H-ish tables into listing feeds.

None of the driver tables holds listings or Han text, so these derive both,
with rules simple enough that DuckDB can compute the expected results from
the same tables (see `__spark_entry__.oracle_sql`).  Every adapter reads a
whole table; nothing is sampled or capped.

* `listing_snapshot(part)`   one offer per part (A1 shape): brand -> mark,
  type -> Han model, name words -> options, size -> year/power/km, price text.
* `change_feed(events)`      an ordered change feed (A2 shape) keyed onto the
  same id space, so some keys exist in the snapshot and some do not.
* `config_payloads(lineitem)` configuration payloads per order (B8 shape).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import ntz
from ..schemas import DICTIONARY

# Fixed values of the test adapters (not reference data): Han renderings of
# the part types and name words, and the seed dictionary that knows only some
# of them, so that mining always finds leftovers.
TYPE_HAN = {
    "STANDARD": "标准", "ECONOMY": "经济", "MEDIUM": "中型",
    "SMALL": "小型", "LARGE": "大型", "PROMO": "促销PROMO",
}
WORD_HAN = {
    "red": "红色", "blue": "蓝色", "hot": "加热座椅", "cold": "空调",
    "small": "小型", "large": "大型", "new": "新车", "old": "二手车",
    "widget": "倒车影像", "gear": "自动挡", "ring": "天窗", "bolt": "导航",
}
FLAG_HAN = {"A": "前驱", "N": "四驱", "R": "后驱"}
STATUS_HAN = {"O": "标配", "F": "选配"}
SEED_DICTIONARY = [
    ("标准", "Стандарт"), ("经济", "Эконом"), ("中型", "Средний"),
    ("红色", "Красный"), ("蓝色", "Синий"), ("加热座椅", "Подогрев сидений"),
    ("前驱", "Передний привод"), ("标配", "Стандартная комплектация"),
]
# Line number -> configuration id as written in the payload: ints, int-like
# text, a float, a foreign id and junk, to exercise the id rules.
LINE_PARAM_ID = {1: "93", 2: "91", 3: "90.0", 4: "999", 5: "\"88\"", 6: "93", 7: "\"x\""}

SNAPSHOT_TIME = dt.datetime(2024, 1, 1, 0, 0, 0)
RUN_TIME = dt.datetime(2024, 2, 1, 0, 0, 0)


def _case(col: Column, mapping: dict, default: Column | None = None) -> Column:
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v)))
    return expr.otherwise(default if default is not None else col)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def han_type(c: Column) -> Column:
    return _case(c, TYPE_HAN)


def han_word(c: Column) -> Column:
    return _case(c, WORD_HAN)


def listing_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offer records (id, pos, inner_id, change_type, created_at, data) from `part`."""
    # A small file is one task's; dealt while the rows are narrow.
    p = read(spark, sf_dir, "part").repartition("p_partkey")
    words = F.split(F.col("p_name"), " ")
    w1, w2 = words.getItem(0), words.getItem(1)
    price = F.round(F.col("p_retailprice") * 10).cast("bigint")
    opt = lambda c: F.struct(han_word(c).alias("optionname"))
    data = F.to_json(F.struct(
        F.col("p_partkey").cast("string").alias("inner_id"),
        F.concat(F.lit("https://example.invalid/offer/"), F.col("p_partkey").cast("string")).alias("url"),
        F.col("p_brand").alias("mark"),
        han_type(F.col("p_type")).alias("model"),
        (F.lit(2000) + F.col("p_size") % 25).cast("string").alias("year"),
        han_word(w1).alias("color"),
        F.format_number(price, 0).alias("price"),
        (F.col("p_size") * 1000).alias("km_age"),
        F.concat(F.format_number(F.col("p_size") / 10.0, 1), F.lit("L")).alias("displacement"),
        (F.col("p_size") * 10).cast("string").alias("power"),
        F.concat(F.lit("2023-"), F.lpad((F.col("p_size") % 12 + 1).cast("string"), 2, "0")).alias("first_registration"),
        F.when(F.col("p_size") % 5 == 0, F.lit("")).when(F.col("p_size") % 5 == 1, F.lit("上海"))
        .otherwise(F.lit("北京")).alias("address"),
        F.array(F.concat(F.lit("img/"), F.col("p_partkey").cast("string"), F.lit(".jpg"))).alias("images"),
        F.struct(F.struct(
            F.array(opt(w1), opt(w2)).alias("displayopts"),
            F.array(F.struct(F.array(opt(w2), opt(F.col("p_brand"))).alias("opts"))).alias("moreoptions"),
        ).alias("option")).alias("extra"),
    ))
    return p.select(
        F.col("p_partkey").cast("bigint").alias("id"),
        F.lit(0).alias("pos"),
        F.col("p_partkey").cast("string").alias("inner_id"),
        F.lit("added").alias("change_type"),
        ntz(SNAPSHOT_TIME).alias("created_at"),
        data.alias("data"),
    )


def snapshot_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshot as a raw table (RAW schema), all rows active, unprocessed."""
    s = listing_snapshot(spark, sf_dir)
    t = ntz(SNAPSHOT_TIME)
    return s.select(
        "id", "inner_id", "change_type", "created_at", "data",
        t.alias("first_loaded_at"), t.alias("last_updated_at"), F.lit("initial_load").alias("source"),
        F.lit(0).alias("active_status"), F.lit(False).alias("is_processed"),
    )


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change records from `events`: signup -> added, purchase / view ->
    changed, error -> removed, click -> an unknown type (ignored)."""
    e = read(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    et = F.col("event_type")
    change_type = (F.when(et == "signup", "added").when(et.isin("purchase", "view"), "changed")
                   .when(et == "error", "removed").otherwise("other"))
    data = (
        F.when(et == "signup", F.to_json(F.struct((k * 1000).alias("price"), (k * 100).alias("km_age"))))
        .when(et == "purchase", F.to_json(F.struct((k * 1000).alias("new_price"))))
        .when(et == "view", F.to_json(F.struct((k * 100).alias("km_age"))))
        .otherwise(F.lit("{}"))
    )
    return e.select(
        F.col("event_id").alias("id"),
        F.lit(0).alias("pos"),
        (F.col("user_id") * 20 + F.col("event_id") % 20).cast("string").alias("inner_id"),
        change_type.alias("change_type"),
        F.col("ts").cast("timestamp_ntz").alias("created_at"),
        data.alias("data"),
    )


def config_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw row per order whose payload holds a configuration block built
    from its line items (ids repeat across lines, so last-wins matters)."""
    li = read(spark, sf_dir, "lineitem")
    pid = _case(F.col("l_linenumber").cast("string"), {str(k): v for k, v in LINE_PARAM_ID.items()}, F.lit("0"))
    # to_json(array(x)) quotes and escapes x; strip the brackets.
    name_json = F.regexp_replace(F.to_json(F.array(_case(F.col("l_returnflag"), FLAG_HAN))), r"^\[|\]$", "")
    value_json = F.regexp_replace(F.to_json(F.array(_case(F.col("l_linestatus"), STATUS_HAN))), r"^\[|\]$", "")
    item = F.concat(F.lit('{"id":'), pid, F.lit(',"name":'), name_json, F.lit(',"value":'), value_json, F.lit("}"))
    per_order = li.groupBy("l_orderkey").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", item.alias("j")))),
                                 lambda s: s["j"]), ",").alias("items"))
    data = F.concat(F.lit('{"mark":"Brand#1","configuration":{"paramtypeitems":[{"paramitems":['),
                    F.col("items"), F.lit("]}]}}"))
    t = ntz(SNAPSHOT_TIME)
    return per_order.select(
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("inner_id"),
        F.lit("added").alias("change_type"), t.alias("created_at"), data.alias("data"),
        t.alias("first_loaded_at"), t.alias("last_updated_at"), F.lit("initial_load").alias("source"),
        F.lit(0).alias("active_status"), F.lit(False).alias("is_processed"),
    )


def seed_dictionary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_DICTIONARY, DICTIONARY)
