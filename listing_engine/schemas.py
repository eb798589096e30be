"""Declared schemas. Nothing in the engine infers a schema from data."""

from __future__ import annotations

from pyspark.sql import types as T

# One record of a page.  `data` stays JSON text: a VARIANT scan silently
# yields NULL for payloads with duplicate keys, text keeps them (and key order).
RECORD = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("inner_id", T.StringType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("data", T.StringType()),
])

OFFER_PAGE = T.StructType([
    T.StructField("result", T.ArrayType(RECORD)),
    T.StructField("meta", T.StructType([
        T.StructField("page", T.IntegerType()),
        T.StructField("next_page", T.IntegerType()),
        T.StructField("limit", T.IntegerType()),
    ])),
])

CHANGE_PAGE = T.StructType([
    T.StructField("result", T.ArrayType(RECORD)),
    T.StructField("meta", T.StructType([
        T.StructField("cur_change_id", T.LongType()),
        T.StructField("next_change_id", T.LongType()),
        T.StructField("limit", T.IntegerType()),
    ])),
])

# Flat change feed: what A1/A2 emit after `inline(result)`.
CHANGES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("inner_id", T.StringType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("data", T.StringType()),
])

RAW = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("inner_id", T.StringType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("data", T.StringType()),
    T.StructField("first_loaded_at", T.TimestampNTZType()),
    T.StructField("last_updated_at", T.TimestampNTZType()),
    T.StructField("source", T.StringType()),
    T.StructField("active_status", T.IntegerType()),
    T.StructField("is_processed", T.BooleanType()),
])

# Who wrote what of a raw row: what a stream of events in any order needs to
# let a late event lose or win (operators.writers).  `base` is the row before
# the first event, NULL if there was none.
_AT = [T.StructField("id", T.LongType()), T.StructField("pos", T.IntegerType())]
FIELD_WRITER = T.StructType([
    T.StructField("value", T.StringType()),  # JSON text
    T.StructField("last", T.StructType([*_AT, T.StructField("p", T.IntegerType())])),
    T.StructField("first", T.StructType([*_AT, T.StructField("p", T.IntegerType())])),
])
WRITERS = T.StructType([
    T.StructField("base", T.StructType([f for f in RAW.fields if f.name in (
        "id", "change_type", "created_at", "data", "first_loaded_at", "source", "active_status")])),
    T.StructField("first", T.StructType([*_AT, T.StructField("change_type", T.StringType()),
                                         T.StructField("created_at", T.TimestampNTZType()), T.StructField("data", T.StringType())])),
    T.StructField("type", T.StructType([*_AT, T.StructField("change_type", T.StringType())])),
    T.StructField("change", T.StructType([*_AT, T.StructField("created_at", T.TimestampNTZType())])),
    T.StructField("removed", T.BooleanType()),
    T.StructField("fields", T.MapType(T.StringType(), FIELD_WRITER)),
])
RAW_STORED = T.StructType([*RAW.fields, T.StructField("writers", WRITERS)])

CONFIG_ENTRY = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.StringType()),
])

# Text columns that go through the dictionary, in record order.
TRANSLATED_TEXT_COLUMNS = [
    "mark", "model", "color", "engine_type", "transmission_type",
    "body_type", "address", "section", "drive_type",
]

FLAT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("inner_id", T.StringType()),
    T.StructField("active_status", T.IntegerType()),
    T.StructField("created_at", T.TimestampNTZType()),
    T.StructField("url", T.StringType()),
    T.StructField("mark", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("color", T.StringType()),
    T.StructField("price", T.IntegerType()),
    T.StructField("km_age", T.IntegerType()),
    T.StructField("engine_type", T.StringType()),
    T.StructField("transmission_type", T.StringType()),
    T.StructField("body_type", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("section", T.StringType()),
    T.StructField("offer_created", T.DateType()),
    T.StructField("description", T.StringType()),
    T.StructField("displacement", T.DoubleType()),
    T.StructField("vin", T.StringType()),
    T.StructField("first_registration", T.DateType()),
    T.StructField("power", T.IntegerType()),
    T.StructField("drive_type", T.StringType()),
    T.StructField("images", T.ArrayType(T.StringType())),
    T.StructField("options", T.ArrayType(T.StringType())),
    T.StructField("configuration", T.MapType(T.StringType(), CONFIG_ENTRY)),
    T.StructField("updated_at", T.TimestampNTZType()),
])

SYNC_STATE = T.StructType([
    T.StructField("last_successful_date", T.DateType()),
    T.StructField("last_change_id", T.LongType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

RUN_LOG = T.StructType([
    T.StructField("operation_type", T.StringType()),
    T.StructField("started_at", T.TimestampNTZType()),
    T.StructField("duration", T.IntegerType()),
    T.StructField("status", T.StringType()),
    T.StructField("details", T.StringType()),
])

DICTIONARY = T.StructType([
    T.StructField("cn", T.StringType()),
    T.StructField("ru", T.StringType()),
])

MINED = T.StructType([
    T.StructField("field", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("count", T.LongType()),
    T.StructField("priority", T.StringType()),
])

# Daily export (documented): pipe-separated, one directory per date.
EXPORT = T.StructType([
    T.StructField("inner_id", T.StringType()),
    T.StructField("change_type", T.StringType()),
    T.StructField("created_at", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("mark", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("km_age", T.StringType()),
])
