"""Structured Streaming versions of the change apply (H2, H3, H4, H5).

Both folds keep, per key, who last wrote what (`operators.writers`), so the
rows don't depend on how page files are dealt to batches or in which order
they come, and a batch costs what it touches, however many came before.

H2 `stream_apply`: page texts -> `foreachBatch`: the batch is staged and parsed
once, its events are summarised per key, and the raw table's buckets that hold
these keys are merged with the summaries.  The table's pointer holds the batch
id, so a batch that is replayed after a crash is either not published or
skipped.  Bad pages stay in the staging folder; too many stop the query.

H3 `stateful_apply`: `transformWithState` keeps the summaries in a RocksDB
state store (for each group of keys a map state key -> row and last writer of
each field) and gives out the updated row of every key that a batch touches.

H5 `stream_change_stats`: daily counters with a watermark on event time.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import json
import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.scalars import map_new_keys, ntz
from ..operators.writers import base_of, combine, event_writers, raw_columns, recognised
from ..schemas import RAW, WRITERS
from ..session import ensure_runtime_confs
from ..sources.pages import BAD_PAGE_BUDGET, stage_batch, stream_change_pages, stream_page_texts
from ..sources.stores import VersionedTable

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _drain(rows: DataFrame, fold_batch, checkpoint: str, available_now: bool):
    writer = rows.writeStream.foreachBatch(fold_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    if available_now:
        q.awaitTermination()
    return q


def staging_path(base: str) -> str:
    return f"{base.rstrip('/')}__landed"


def left_out(spark: SparkSession, base: str) -> DataFrame:
    """kind and text of the bad pages and records of all batches."""
    return (spark.read.schema("text string, kind string, batch_id long").parquet(staging_path(base))
            .where("kind in ('page', 'record')"))


def stream_apply(spark: SparkSession, pages_path: str, store: VersionedTable, checkpoint: str, now,
                 max_files: int = 100, multi_line: bool = True, available_now: bool = True,
                 budget: int = BAD_PAGE_BUDGET):
    """H2 (+ A3, A6, H4): drain the landed change pages into the raw store.
    Returns the finished (or running) StreamingQuery."""
    def fold_batch(texts: DataFrame, batch_id: int) -> None:
        if batch_id <= store.last_batch():
            return  # replay of a published batch
        read = stage_batch(texts, now, staging_path(store.path), batch_id, budget)
        store.merge(event_writers(read.records), batch_id, combine(now))
        read.drop_good()

    return _drain(stream_page_texts(spark, pages_path, max_files, multi_line), fold_batch, checkpoint, available_now)


# --- H3: the fold in keyed state ---------------------------------------------------

_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
_BASE = {"timestampNTZFormat": _TIME}
_NAMES = ("first", "type", "change")
_ROW_STATE = T.StructType(
    [T.StructField("base", T.StringType())]
    + [T.StructField(f"{n}_{f}", t) for n in _NAMES for f, t in (("id", T.LongType()), ("pos", T.LongType()))]
    + [T.StructField(n, T.StringType()) for n in ("first_type", "first_at", "first_data", "type_value", "change_at")]
    + [T.StructField("removed", T.BooleanType())])
_PLACES = ["id", "pos", "p", "first_id", "first_pos", "first_p"]
_FIELD_STATE = T.StructType([T.StructField("value", T.StringType()), *(T.StructField(n, T.LongType()) for n in _PLACES)])
_SUMMARY = T.StructType([*_ROW_STATE.fields, T.StructField("fields", T.MapType(T.StringType(), _FIELD_STATE))])
# Groups of keys in the state store; a checkpoint holds rows by them, so the number stays.
KEY_GROUPS = 1 << 14
_STATE_OUT = "inner_id string, summary string, forgotten boolean"


class RowFold(StatefulProcessor):
    """A map state key -> summary (`_SUMMARY`: the row, and the last writer of each
    field) as a JSON text, which is also what goes out.

    The stream is grouped by a hash of the key: Spark exchanges Arrow batches
    with Python per group, and each call to the state store is a message to the
    JVM, so a touched key costs one read, one write and its share of a batch,
    however many fields it has.

    With `forget_after` (seconds of event time) a listing is forgotten that
    long after its removal, by a timer: its last row goes out marked `forgotten`."""

    def __init__(self, forget_after: int | None = None):
        self.forget_after = forget_after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getMapState("rows", "inner_id string", "summary string")
        self.due = handle.getMapState("due", "at long", "inner_ids string")

    def _get(self, key: str) -> dict:
        held = self.rows.getValue((key,))
        return json.loads(held[0]) if held is not None else dict.fromkeys(_ROW_STATE.names) | {"removed": False, "fields": {}}

    def _put(self, key: str, state: dict) -> str:
        text = json.dumps(state, ensure_ascii=False)
        self.rows.updateValue((key,), (text,))
        return text

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802, N803 (Spark's names)
        self._put(initialState.inner_id, self._get(initialState.inner_id) | {"base": initialState.base})

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        states, before, due = {}, {}, {}
        touched = set()
        for e in rows:
            key = e.inner_id
            if key not in states:
                states[key] = state = self._get(key)
                before[key] = state["base"], state["first_id"], state["first_pos"]
            state, at = states[key], (e.id, e.pos)
            if state["first_id"] is None or at < (state["first_id"], state["first_pos"]):
                state.update(first_id=e.id, first_pos=e.pos, first_type=e.change_type, first_at=e.created_at, first_data=e.data)
            if not (e.is_change or e.change_type == "removed"):
                continue
            touched.add(key)
            if state["type_id"] is None or at > (state["type_id"], state["type_pos"]):
                state.update(type_id=e.id, type_pos=e.pos, type_value=e.change_type)
            if e.change_type == "removed":
                state["removed"] = True
                due[key] = max(due.get(key, 0), e.at_ms)
            else:
                if state["change_id"] is None or at > (state["change_id"], state["change_pos"]):
                    state.update(change_id=e.id, change_pos=e.pos, change_at=e.created_at)
                self._write_fields(state["fields"], e)
        for key, state in states.items():
            base, *first = before[key]
            new_base = base is None and [state["first_id"], state["first_pos"]] != first
            if key in touched or new_base or (base is None and first[0] is None):
                yield Row(inner_id=key, summary=self._put(key, state), forgotten=False)
        if self.forget_after is not None:
            self._forget_later(due)

    @staticmethod
    def _write_fields(fields: dict, e: Row) -> None:
        for p, (name, value) in enumerate(zip(e.names, e.values)):
            place, have = (e.id, e.pos, p), fields.get(name)
            if have is None:
                fields[name] = dict(zip(_FIELD_STATE.names, (value, *place, *place)))
                continue
            if place >= (have["id"], have["pos"], have["p"]):
                have.update(value=value, id=e.id, pos=e.pos, p=p)
            if place < (have["first_id"], have["first_pos"], have["first_p"]):
                have.update(first_id=e.id, first_pos=e.pos, first_p=p)

    def _forget_later(self, due: dict) -> None:
        """One timer per group and time; the keys that it is for stand in `due`."""
        by_time = {}
        for key, removed_at in due.items():
            by_time.setdefault(removed_at + 1000 * self.forget_after, []).append(key)
        for at, keys in by_time.items():
            held = self.due.getValue((at,))
            self.due.updateValue((at,), (json.dumps(list(dict.fromkeys((json.loads(held[0]) if held is not None else []) + keys))),))
            self.handle.registerTimer(at)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        at = expiredTimerInfo.getExpiryTimeInMs()
        for inner_id in json.loads(self.due.getValue((at,))[0]):
            out = Row(inner_id=inner_id, summary=json.dumps(self._get(inner_id), ensure_ascii=False), forgotten=True)
            self.rows.removeKey((inner_id,))
            yield out
        self.due.removeKey((at,))

    def close(self) -> None:
        pass


@contextlib.contextmanager
def _state_store(spark: SparkSession):
    """`transformWithState` needs RocksDB; the session's own choice comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(name, before) if before else spark.conf.unset(name)


def state_updates(records: DataFrame, initial: DataFrame | None = None, forget_after: int | None = None,
                  watermark: str = "2 days") -> DataFrame:
    """H3: a stream of change records -> a stream of (inner_id, writers, forgotten),
    the summary of every key a batch touches.  `initial`: raw rows from before
    the stream."""
    spark = records.sparkSession
    ensure_runtime_confs(spark)
    entries = F.coalesce(F.map_entries(map_new_keys(F.col("m"))), F.array())
    events = recognised(records).select(
        "inner_id", F.col("ord.id").alias("id"), F.col("ord.pos").cast("long").alias("pos"), "change_type",
        F.date_format("created_at", _TIME).alias("created_at"), "data", F.coalesce("is_change", F.lit(False)).alias("is_change"),
        F.when(F.col("is_change"), F.transform(entries, lambda e: e["key"])).alias("names"),
        F.when(F.col("is_change"), F.transform(entries, lambda e: F.to_json(e["value"]))).alias("values"),
        _instant(F.col("created_at")).alias("at"))
    group = F.pmod(F.xxhash64("inner_id"), F.lit(KEY_GROUPS)).cast("int")
    events = events.withColumn("at_ms", F.unix_millis("at")).withColumn("key_group", group)
    events = events.drop("at") if forget_after is None else events.withWatermark("at", watermark)
    before = None
    if initial is not None:
        before = initial.select("inner_id", F.to_json(base_of(initial), _BASE).alias("base"), group.alias("key_group")).groupBy("key_group")
    out = events.groupBy("key_group").transformWithState(
        RowFold(forget_after), _STATE_OUT, "Update", "EventTime" if forget_after is not None else "None", before)
    return out.withColumn("s", F.from_json("summary", _SUMMARY)).select("inner_id", _summary(F.col("s")).alias("writers"), "forgotten")


def _instant(c) -> F.Column:
    """The UTC wall clock of a record as an instant: what a watermark needs."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", ntz(dt.datetime(1970, 1, 1)), c))


def _summary(s):
    """A `_SUMMARY` as the columns of `WRITERS`."""
    at = lambda n: [s[f"{n}_id"].alias("id"), s[f"{n}_pos"].cast("int").alias("pos")]
    time = lambda c: F.to_timestamp_ntz(s[c], F.lit(_TIME))
    there = lambda n, *c: F.when(s[f"{n}_id"].isNotNull(), F.struct(*at(n), *c))
    field = lambda _, e: F.struct(
        e["value"], F.struct(e["id"], e["pos"].cast("int"), e["p"].cast("int")).alias("last"),
        F.struct(e["first_id"], e["first_pos"].cast("int"), e["first_p"].cast("int")).alias("first"))
    parts = {
        "base": F.from_json(s["base"], WRITERS["base"].dataType, _BASE),
        "first": there("first", s["first_type"].alias("change_type"), time("first_at").alias("created_at"), s["first_data"].alias("data")),
        "type": there("type", s["type_value"].alias("change_type")),
        "change": there("change", time("change_at").alias("created_at")),
        "removed": s["removed"],
        "fields": F.transform_values(s["fields"], field),
    }
    return F.struct(*[c.cast(WRITERS[n].dataType.simpleString()).alias(n) for n, c in parts.items()])


def stateful_apply(spark: SparkSession, pages_path: str, store: VersionedTable, checkpoint: str, now,
                   max_files: int = 100, multi_line: bool = True, available_now: bool = True,
                   forget_after: int | None = None):
    """H3: drain the pages through keyed state; the updated rows of each batch
    are upserted into `store`, whose rows from before the first run are the
    state's initial rows.  Returns the StreamingQuery."""
    start = f"{checkpoint.rstrip('/')}__initial"
    # The rows before the first run stay the initial state when the query restarts.
    table = VersionedTable(spark, start, RAW, buckets=store.buckets)
    if not table.exists():
        table.replace(store.read())
    # With initial rows Spark hands each group of the first batch to Python as an Arrow batch of its own.
    initial = table.read() if any(table.version().folders) else None

    def fold_batch(updates: DataFrame, batch_id: int) -> None:
        if batch_id <= store.last_batch():
            return
        # The batch is computed once: its state is committed with it.
        path = f"{staging_path(store.path)}/batch_id={batch_id}"
        updates.write.mode("overwrite").parquet(path)
        rows = spark.read.schema(updates.schema).parquet(path)
        made = raw_columns(F.col("writers"), F.col("inner_id"), now)
        store.merge(rows.select(*[c.alias(n) for n, c in made.items()], F.lit(False).alias("is_processed"), "writers"), batch_id)

    with _state_store(spark):
        records = stream_change_pages(spark, pages_path, now, max_files, multi_line)
        return _drain(state_updates(records, initial, forget_after), fold_batch, checkpoint, available_now)


# --- H5 ----------------------------------------------------------------------------

def stream_change_stats(records: DataFrame, watermark: str = "2 days") -> DataFrame:
    """H5 (streaming form): events per type per day of event time, each change
    id once.  In append mode a day comes once, when the watermark has passed it;
    the state of passed days and ids is dropped, and so is an event that comes
    behind the watermark: `late_events` counts those."""
    return (records.withColumn("created_at", _instant(F.col("created_at"))).withWatermark("created_at", watermark)
            .dropDuplicatesWithinWatermark(["id"])
            .groupBy(F.window("created_at", "1 day").alias("day"))
            .agg(F.count_if(F.col("change_type") == "added").cast("bigint").alias("added"),
                 F.count_if(F.col("change_type") == "changed").cast("bigint").alias("changed"),
                 F.count_if(F.col("change_type") == "removed").cast("bigint").alias("removed"),
                 F.count(F.lit(1)).cast("bigint").alias("events")))


def late_events(query) -> int:
    """The events that a finished `stream_change_stats` query left out as late:
    those that its first stateful operator, the one on change ids, dropped."""
    by_batch = {p.batchId: p for p in query.recentProgress if p.stateOperators}
    return sum(p.stateOperators[-1].numRowsDroppedByWatermark for p in by_batch.values())


def land_in_order(changes: DataFrame, path: str, chunks: int = 4, page_size: int = 20) -> list[str]:
    """Land a feed as `chunks` id-ordered groups of page files written one
    after the other (file sources pick files up in modification order), each
    in its own folder `path/chunk=i`; returns the folders."""
    from ..sources.pages import write_change_pages
    lo, hi = changes.agg(F.min("id"), F.max("id")).first()
    step = (hi - lo) // chunks + 1
    out = []
    for i in range(chunks):
        part = changes.filter((F.col("id") >= lo + i * step) & (F.col("id") < lo + (i + 1) * step))
        folder = f"{path.rstrip('/')}/chunk={i:04d}"
        write_change_pages(part, folder, page_size)
        out.append(folder)
    return out


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package
