"""The change fold (H1) as a merge of last writers.

What a key's row is after a set of events depends on few of them: the first
(its base, if there was no row before), the last that set the type, the last
change, whether one removed it, and for each field the last that wrote it.
Each is kept with the (id, pos) of its event, so that two such summaries merge
by comparison, in any order and as often as one likes: a late event loses or
wins, a repeated one changes nothing, and no list of events is kept.

`event_writers` summarises a batch of events per key, `merged` joins two
summaries, `raw_columns` gives the row.  The rows equal `apply_changes` on all
events at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import map_new_keys, ntz, payload
from ..schemas import RAW, WRITERS
from ..session import ensure_runtime_confs
from .changes import RECOGNISED, _has_key, _with_order, empty_base

RAW_COLUMNS = [f.name for f in RAW.fields]


def _type(name: str) -> str:
    return WRITERS[name].dataType.simpleString()


def recognised(changes: DataFrame) -> DataFrame:
    """The events that count, with `ord`, the parsed payload `m` of a change, and
    whether they are an applied `change` or a change of `kind`."""
    ensure_runtime_confs(changes.sparkSession)
    ct = F.col("change_type")
    rows = (_with_order(changes).where(_has_key(F.col("inner_id")) & ct.isin(*RECOGNISED))
            .withColumn("m", F.when(ct == "changed", payload("data"))))
    applied = (ct == "changed") & F.col("m").isNotNull()
    return rows.withColumn("is_change", applied).withColumn("is_kind", applied | (ct == "removed"))


def event_writers(changes: DataFrame) -> DataFrame:
    """(inner_id, writers) of a batch of events; `writers.base` is NULL.

    Two aggregations with partial ones before the shuffle, by key and by (key,
    field): one key with a third of the events is reduced task by task."""
    rec, at = recognised(changes), [F.col("ord.id").alias("id"), F.col("ord.pos").alias("pos")]
    keys = rec.groupBy("inner_id").agg(
        F.min_by(F.struct(*at, "change_type", "created_at", "data"), "ord").alias("first"),
        F.max_by(F.struct(*at, "change_type"), F.when(F.col("is_kind"), F.col("ord"))).alias("type"),
        F.max_by(F.struct(*at, "created_at"), F.when(F.col("is_change"), F.col("ord"))).alias("change"),
        F.max(F.col("change_type") == "removed").alias("removed"))
    place = F.struct(F.col("ord.id").alias("id"), F.col("ord.pos").alias("pos"), "p")
    fields = (rec.where("is_change").select("inner_id", "ord", F.posexplode(map_new_keys(F.col("m"))).alias("p", "key", "value"))
              .select("inner_id", "key", F.to_json("value").alias("value"), place.alias("at"))
              .groupBy("inner_id", "key").agg(F.max(F.struct("at", "value")).alias("last"), F.min("at").alias("first"))
              .groupBy("inner_id").agg(F.map_from_entries(F.collect_list(F.struct("key", F.struct(
                  F.col("last.value").alias("value"), F.col("last.at").alias("last"), "first")))).alias("fields")))
    return keys.join(fields, "inner_id", "left").select("inner_id", _writers(F.lit(None), *[F.col(c) for c in (
        "first", "type", "change", "removed", "fields")]).alias("writers"))


def _writers(base: Column, first: Column, kind: Column, change: Column, removed: Column, fields: Column) -> Column:
    named = zip((f.name for f in WRITERS.fields), (base, first, kind, change, removed, fields))
    return F.struct(*[c.cast(_type(name)).alias(name) for name, c in named])


def _at(c: Column) -> Column:
    return F.struct(c["id"], c["pos"])


def _later(a: Column, b: Column) -> Column:
    return F.when(a.isNull() | (b.isNotNull() & (_at(b) > _at(a))), b).otherwise(a)


def merged(a: Column, b: Column) -> Column:
    """Two summaries of one key as one; either may be NULL.  A base comes from `a`."""
    def field(_, x: Column, y: Column) -> Column:
        last = F.when(x.isNull() | (y.isNotNull() & (y["last"] > x["last"])), y).otherwise(x)
        return F.struct(last["value"].alias("value"), last["last"].alias("last"), F.least(x["first"], y["first"]).alias("first"))

    def one(name):
        return a[name], b[name]

    none = F.create_map().cast(_type("fields"))
    first_a, first_b = one("first")
    first = F.when(first_a.isNull() | (first_b.isNotNull() & (_at(first_b) < _at(first_a))), first_b).otherwise(first_a)
    return _writers(a["base"], first, _later(*one("type")), _later(*one("change")),
                    F.coalesce(a["removed"], F.lit(False)) | F.coalesce(b["removed"], F.lit(False)),
                    F.map_zip_with(F.coalesce(a["fields"], none), F.coalesce(b["fields"], none), field))


def raw_columns(w: Column, key: Column, now, source: str = "daily_update") -> dict[str, Column]:
    """The raw row that a summary stands for, apart from `is_processed`."""
    base, first, change = w["base"], w["first"], w["change"]
    exists = base.isNotNull()
    by_removal = first["change_type"] == "removed"
    text = F.when(exists, base["data"]).when(by_removal, F.lit("{}")).otherwise(first["data"])
    start = F.when(empty_base(text), F.create_map().cast("map<string,variant>")).otherwise(payload(text))
    # Updates are the changes behind the base; a base that isn't an object takes none.
    behind = F.filter(F.map_entries(w["fields"]), lambda e: exists | (_at(e["value"]["last"]) > _at(first)))
    in_order = F.array_sort(behind, lambda x, y: F.when(x["value"]["first"] < y["value"]["first"], -1)
                            .when(x["value"]["first"] > y["value"]["first"], 1).otherwise(0))
    overlay = F.map_from_entries(F.transform(in_order, lambda e: F.struct(e["key"], F.parse_json(e["value"]["value"]))))
    updated = start.isNotNull() & change.isNotNull() & (exists | (_at(change) > _at(first)))
    kind = F.when(start.isNotNull(), w["type"]["change_type"]).otherwise(F.when(w["removed"], F.lit("removed")))
    return {
        "inner_id": key,
        "id": F.when(exists, base["id"]).otherwise(first["id"]),
        "change_type": F.coalesce(kind, F.when(exists, base["change_type"]).otherwise(first["change_type"])),
        "created_at": F.coalesce(F.when(start.isNotNull(), change["created_at"]), F.when(exists, base["created_at"]).otherwise(first["created_at"])),
        "data": F.when(updated, F.to_json(F.map_concat(start, overlay))).otherwise(text),
        "first_loaded_at": F.when(exists, base["first_loaded_at"]).otherwise(ntz(now)),
        "last_updated_at": ntz(now),
        "source": F.when(exists, base["source"]).otherwise(F.lit(source)),
        "active_status": F.when(w["removed"], F.lit(1)).when(exists, base["active_status"]).when(by_removal, 1).otherwise(0).cast("int"),
    }


def updates(w: Column) -> Column:
    """Whether a batch's summary can change a row that was there before."""
    return w["type"].isNotNull()


def base_of(row: DataFrame) -> Column:
    """The columns of a raw row as the base of its summary."""
    return F.struct(*[F.col(f.name) for f in WRITERS["base"].dataType.fields])


def combine(now) -> "callable":
    """For `VersionedTable.merge`: the stored rows with a batch's summaries laid over them.

    A stored row without writers (loaded or rewritten by a batch job) is the
    base of what the stream brings from then on."""
    def over(old: DataFrame, new: DataFrame) -> DataFrame:
        ensure_runtime_confs(new.sparkSession)
        joined = (old.withColumn("__old", F.lit(True)).withColumnRenamed("writers", "__w")
                  .join(new.select("inner_id", F.col("writers").alias("__n")), "inner_id", "full_outer"))
        there = F.coalesce(F.col("__old"), F.lit(False))
        base = F.when(F.col("__w").isNotNull(), F.col("__w.base")).when(there, base_of(joined))
        before = _writers(base, *[F.col(f"__w.{f.name}") for f in WRITERS.fields[1:]])
        late_base = F.col("__w").isNotNull() & F.col("__w.base").isNull() & (_at(F.col("__n.first")) < _at(F.col("__w.first")))
        touched = F.col("__n").isNotNull() & (~there | updates(F.col("__n")) | F.coalesce(late_base, F.lit(False)))
        # The summary is worked out once, below a materialised column.
        rows = joined.withColumn("__touched", touched).withColumn("__s", F.when(F.col("__touched"), merged(before, F.col("__n"))))
        made = raw_columns(F.col("__s"), F.col("inner_id"), now)
        made["first_loaded_at"] = F.coalesce(F.col("first_loaded_at"), made["first_loaded_at"])
        made["is_processed"] = F.lit(False)
        return rows.select(*[F.when(F.col("__touched"), made[c]).otherwise(F.col(c)).alias(c) if c != "inner_id" else F.col(c) for c in RAW_COLUMNS],
                           F.when(F.col("__touched"), F.col("__s")).otherwise(F.col("__w")).alias("writers"))

    return over
