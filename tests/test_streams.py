"""Streamed change apply (H2, H3): rows don't depend on how files are dealt to batches."""

import datetime as dt
import json
import os
import random
import shutil
import tempfile
from types import SimpleNamespace

import pytest
from pyspark.sql import Row

from listing_engine.operators import writers as WR
from listing_engine.operators.changes import apply_changes
from listing_engine.schemas import RAW
from listing_engine.sources import stores as ST
from listing_engine.streaming import apply as SA

NOW = dt.datetime(2026, 1, 1)
T0 = dt.datetime(2025, 1, 1)

# Per page: (id, key, type, payload).  "old" has a row before the feed.
PAGES = [
    [(0, "new", "added", {"price": 1, "mark": "a"}), (1, "old", "changed", {"new_price": 10, "km": 1}), (2, "in-order", "added", {"price": 5})],
    [(3, "new", "changed", {"new_price": 2}), (4, "old", "changed", {"new_price": 20}), (5, "gone", "removed", {})],
    [(6, "new", "changed", {"new_price": 3}), (7, "old", "added", {"price": 99}), (8, "gone", "changed", {"new_price": 7})],
]


def _land(order):
    d = tempfile.mkdtemp(prefix="pages-", dir="/tmp")
    for landed, n in enumerate(order):
        records = [{"id": i, "inner_id": k, "change_type": t, "data": data,
                    "created_at": (T0 + dt.timedelta(minutes=i)).isoformat()} for i, k, t, data in PAGES[n]]
        path = os.path.join(d, f"p{n}.json")
        with open(path, "w", encoding="utf-8") as f:
            json.dump({"result": records, "meta": {"cur_change_id": 3 * n, "next_change_id": 3 * n + 3, "limit": 3}}, f)
        os.utime(path, (1_700_000_000 + 60 * landed,) * 2)
    return d


def _shown(rows):
    return sorted((r.inner_id, r.id, r.change_type, r.created_at, r.active_status, r.is_processed, json.dumps(json.loads(r.data), sort_keys=True))
                  for r in rows.collect())


def _initial(spark):
    return spark.createDataFrame([(100, "old", "added", T0, '{"price":8,"mark":"b"}', T0, T0, "initial_load", 0, True),
                                  (101, "other", "added", T0, '{"price":9}', T0, T0, "initial_load", 0, True)], RAW)


def _feed(spark, pages=PAGES):
    return spark.createDataFrame([(i, p, k, t, T0 + dt.timedelta(minutes=i), json.dumps(data))
                                  for page in pages for p, (i, k, t, data) in enumerate(page)],
                                 "id long, pos int, inner_id string, change_type string, created_at timestamp_ntz, data string")


@pytest.mark.parametrize("fold", [SA.stream_apply, SA.stateful_apply])
@pytest.mark.parametrize("order", [[1, 0, 2], [2, 1, 0]])
def test_files_in_any_order_one_a_batch(spark, fold, order):
    expected = _shown(apply_changes(_initial(spark), _feed(spark), NOW).table)
    pages, root = _land(order), tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    store = ST.raw_store(spark, f"{root}/raw", buckets=2)
    store.replace(_initial(spark))
    fold(spark, pages, store, f"{root}/checkpoint", NOW, max_files=1)
    assert store.last_batch() == 2
    assert _shown(store.read()) == expected


@pytest.mark.parametrize("fold", [SA.stream_apply, SA.stateful_apply])
def test_restart_in_the_middle(spark, fold):
    expected = _shown(apply_changes(_initial(spark), _feed(spark), NOW).table)
    pages, root = _land([2, 0]), tempfile.mkdtemp(prefix="stream-", dir="/tmp")
    store = ST.raw_store(spark, f"{root}/raw", buckets=2)
    store.replace(_initial(spark))
    fold(spark, pages, store, f"{root}/checkpoint", NOW, max_files=1)
    assert store.last_batch() == 1
    late = _land([1])
    shutil.copy(f"{late}/p1.json", f"{pages}/p1.json")  # the page between comes last
    fold(spark, pages, ST.raw_store(spark, f"{root}/raw", buckets=2), f"{root}/checkpoint", NOW, max_files=1)
    assert store.last_batch() == 2 and _shown(store.read()) == expected


def test_a_removed_listing_is_forgotten_after_a_while(spark):
    root = tempfile.mkdtemp(prefix="forget-", dir="/tmp")
    day = lambda n: T0 + dt.timedelta(days=n)
    feed = [(0, "a", "added", day(0)), (1, "a", "removed", day(1)), (2, "b", "added", day(1)), (3, "b", "changed", day(40))]
    schema = "id long, pos int, inner_id string, change_type string, created_at timestamp_ntz, data string"
    for i, e in enumerate(feed):
        spark.createDataFrame([(e[0], 0, e[1], e[2], e[3], '{"price":1}')], schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    with SA._state_store(spark):
        events = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
        seen = []
        query = (SA.state_updates(events, forget_after=86_400).writeStream.outputMode("update")
                 .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
                 .foreachBatch(lambda b, _: seen.extend((r.inner_id, r.forgotten) for r in b.collect())).start())
        query.awaitTermination()
    assert ("a", True) in seen and ("b", True) not in seen


class _Store:
    """Stands in for the state of one group of keys; counts what is asked of it."""

    def __init__(self):
        self.maps, self.calls, self.timers = {}, [], []

    def getMapState(self, name, *_):  # noqa: N802
        held, store = self.maps.setdefault(name, {}), self

        class State:
            def getValue(self, k):  # noqa: N802
                store.calls.append(("get", name, *k))
                return held.get(k)

            def updateValue(self, k, v):  # noqa: N802
                store.calls.append(("put", name, *k))
                held[k] = v

            def removeKey(self, k):  # noqa: N802
                del held[k]
        return State()

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


def test_a_touched_key_costs_one_read_and_one_write_of_state():
    def event(i, key, kind, names=()):
        return Row(id=i, pos=0, inner_id=key, change_type=kind, created_at="t", data="{}", is_change=kind == "changed",
                   names=list(names), values=[str(i)] * len(names), at_ms=1000)

    store, fold = _Store(), SA.RowFold(forget_after=5)
    fold.init(store)
    wide = [f"f{n}" for n in range(50)]
    out = list(fold.handleInputRows((3,), iter([event(1, "a", "changed", wide), event(2, "b", "added"), event(3, "a", "changed", wide)]), None))
    assert sorted(store.calls) == [("get", "rows", "a"), ("get", "rows", "b"), ("put", "rows", "a"), ("put", "rows", "b")]
    assert [r.inner_id for r in out] == ["a", "b"] and {f["value"] for f in json.loads(out[0].summary)["fields"].values()} == {"3"}
    # One timer forgets both keys of the group that were removed at one time, and no other.
    list(fold.handleInputRows((3,), iter([event(4, "a", "removed"), event(5, "b", "removed"), event(6, "c", "added")]), None))
    assert store.timers == [6000]
    expired = SimpleNamespace(getExpiryTimeInMs=lambda: 6000)
    assert [(r.inner_id, r.forgotten) for r in fold.handleExpiredTimer((3,), None, expired)] == [("a", True), ("b", True)]
    assert list(store.maps["rows"]) == [("c",)] and not store.maps["due"]


def test_any_split_and_order_of_batches_equals_one_fold(spark):
    """The replay property of the change rules, on random feeds: each case is
    a key space of its own, dealt to batches at random, some twice."""
    rng, cases = random.Random(11), 300
    events, batches = [], [[] for _ in range(6)]
    for case in range(cases):
        for i in range(rng.randrange(1, 9)):
            key = f"{case}-{rng.choice('xy')}"
            e = (len(events), rng.randrange(2), key, rng.choice(["added", "changed", "changed", "removed", "other", None]),
                 T0 + dt.timedelta(minutes=rng.randrange(1000)),
                 rng.choice(['{"new_a":1}', '{"a":2,"b":{"c":[1]}}', '{"b":null,"new_b":3}', "[1]", "{}", '{"c":1.5}', None]))
            events.append(e)
            for b in rng.sample(range(6), rng.choice([1, 1, 2])):
                batches[b].append(e)
    schema = "id long, pos int, inner_id string, change_type string, created_at timestamp_ntz, data string"
    base = [(10**6 + c, f"{c}-x", "added", T0, rng.choice(['{"a":9,"z":1}', "[]", "7", None]), T0, T0, "initial_load", rng.randrange(2), True)
            for c in range(0, cases, 3)]
    initial = spark.createDataFrame(base, RAW)
    root = tempfile.mkdtemp(prefix="replay-", dir="/tmp")
    store = ST.raw_store(spark, f"{root}/raw", buckets=1)
    store.replace(initial)
    for n, batch in enumerate(batches):
        store.merge(WR.event_writers(spark.createDataFrame(batch, schema)), n, WR.combine(NOW))
    shown = lambda rows: sorted((r.inner_id, r.id, r.change_type, r.created_at, r.active_status, r.data and json.dumps(json.loads(r.data), sort_keys=True))
                                for r in rows.collect())
    expected = shown(apply_changes(initial, spark.createDataFrame(events, schema), NOW).table)
    assert shown(store.read()) == expected


def test_day_counts_come_once_without_repeated_and_late_events(spark):
    root = tempfile.mkdtemp(prefix="days-", dir="/tmp")
    schema = "id long, change_type string, created_at timestamp_ntz"
    at = lambda d, h=1: T0 + dt.timedelta(days=d, hours=h)
    chunks = [[(0, "added", at(0)), (1, "changed", at(0, 5)), (2, "added", at(1))],
              [(1, "changed", at(0, 5)), (3, "removed", at(3)), (4, "changed", at(4))],  # id 1 again
              [(6, "added", at(9))],
              [(5, "added", at(0, 2)), (7, "added", at(10))]]  # id 5 is behind the watermark
    for n, chunk in enumerate(chunks):
        spark.createDataFrame(chunk, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
        part = max((f for f in os.listdir(f"{root}/in") if f.startswith("part-")), key=lambda f: os.path.getmtime(f"{root}/in/{f}"))
        os.utime(f"{root}/in/{part}", (1_700_000_000 + 60 * n,) * 2)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = (SA.stream_change_stats(rows, "2 days").writeStream.outputMode("append").format("parquet")
             .option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start(f"{root}/out"))
    query.awaitTermination()
    days = {r.day.start.date(): (r.added, r.changed, r.removed, r.events) for r in spark.read.parquet(f"{root}/out").collect()}
    assert days == {at(0).date(): (1, 1, 0, 2), at(1).date(): (1, 0, 0, 1), at(3).date(): (0, 0, 1, 1), at(4).date(): (0, 1, 0, 1)}
    assert SA.late_events(query) == 1
