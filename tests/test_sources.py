"""Page readers (A1-A6), stores (A7-A10), dictionary files."""

import datetime as dt
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from listing_engine.sources import dictionary_io as DI
from listing_engine.sources import pages as PG
from listing_engine.sources import stores as ST
from listing_engine.plans.adapters import snapshot_raw

NOW = dt.datetime(2026, 1, 1)


def _write(folder, name, obj):
    with open(os.path.join(folder, name), "w", encoding="utf-8") as f:
        f.write(obj if isinstance(obj, str) else json.dumps(obj, ensure_ascii=False, indent=2))


def test_offer_pages(spark):
    d = tempfile.mkdtemp(prefix="pages-", dir="/tmp")
    rec = lambda i, k, **kw: {"id": i, "inner_id": k, "created_at": "2025-04-13T10:00:00Z",
                              "data": {"price": 8000, "mark": "大通"}, **kw}
    _write(d, "p1.json", {"result": [rec(1, "a"), rec(2, None), rec(3, "a")], "meta": {"page": 1, "next_page": 2, "limit": 20}})
    _write(d, "p2.json", {"result": [rec(4, "b", change_type=None)], "meta": {"page": 2, "next_page": None, "limit": 20}})
    _write(d, "p3.json", {"result": [], "meta": {"page": 3, "next_page": None, "limit": 20}})
    _write(d, "bad.json", "{not json")
    recs, bad = PG.read_offer_pages(spark, d, NOW)
    assert bad == 1
    rows = sorted((r.id, r.inner_id, r.change_type, r.page) for r in recs.collect())
    assert rows == [(1, "a", "added", 1), (2, None, "added", 1), (3, "a", "added", 1), (4, "b", "added", 2)]
    one = recs.filter("id = 1").first()
    assert json.loads(one.data) == {"price": 8000, "mark": "大通"}
    assert one.created_at == dt.datetime(2025, 4, 13, 10, 0)
    limited, _ = PG.read_offer_pages(spark, d, NOW, max_pages=1)
    assert limited.count() == 3
    with pytest.raises(PG.BadPageBudgetExceeded):
        PG.read_offer_pages(spark, d, NOW, budget=0)


def test_change_pages_and_chain(spark):
    d = tempfile.mkdtemp(prefix="chg-", dir="/tmp")
    ev = lambda i, t: {"id": i, "inner_id": "k", "change_type": t, "created_at": "2025-01-01T00:00:00+03:00",
                       "data": {"new_price": i}}
    _write(d, "a.json", {"result": [ev(10, "added"), ev(11, "changed")], "meta": {"cur_change_id": 10, "next_change_id": 12, "limit": 2}})
    _write(d, "b.json", {"result": [ev(12, "removed")], "meta": {"cur_change_id": 12, "next_change_id": 20, "limit": 2}})
    recs, bad = PG.read_change_pages(spark, d, NOW, from_change_id=11)
    assert sorted(r.id for r in recs.collect()) == [11, 12]
    assert recs.first().created_at == dt.datetime(2024, 12, 31, 21, 0)
    pages = spark.read.schema(PG.CHANGE_PAGE).option("multiLine", True).json(d)
    gaps = {(r.cur, r.nxt, r.kind) for r in PG.page_chain_gaps(
        pages.select("meta.*", F.size("result").alias("n")), "cur_change_id", "next_change_id", "n").collect()}
    assert gaps == {(12, 20, "gap")}


def test_table_merge_and_lookup(spark):
    root = tempfile.mkdtemp(prefix="store-", dir="/tmp")
    store = ST.raw_store(spark, f"{root}/raw", buckets=8)
    base = snapshot_raw(spark, "/root/testdata/sf0.001")
    n = base.count()
    store.replace(base)
    changed = base.filter(F.col("id") < 3).withColumn("active_status", F.lit(1))
    new = base.limit(1).withColumn("inner_id", F.lit("new-key"))
    out = store.merge(changed.unionByName(new))
    assert out.count() == n + 1
    assert out.filter("active_status = 1").count() == 3
    assert store.lookup("new-key").count() == 1
    assert store.lookup("1").first().active_status == 1


def test_bad_pages_and_bad_records_are_set_aside(spark):
    d = tempfile.mkdtemp(prefix="bad-", dir="/tmp")
    meta = {"cur_change_id": 1, "next_change_id": 9, "limit": 2}
    good = {"id": 1, "inner_id": "a", "change_type": "added", "created_at": "2025-01-01T00:00:00Z", "data": {"p": 1}}
    _write(d, "a.json", {"result": [good, {**good, "id": "x"}], "meta": meta})
    _write(d, "b.json", {"result": "oops", "meta": meta})
    _write(d, "c.json", "{broken")
    _write(d, "d.json", {"result": [], "meta": None})
    recs, bad = PG.read_change_pages(spark, d, NOW)
    assert bad == 3 and [r.id for r in recs.collect()] == [1]
    read = PG.load_change_pages(spark, d, NOW)
    assert sorted(r.kind for r in read.left_out.collect()) == ["page", "page", "page", "record"]
    assert read.counters == {"pages": 4, "bad_pages": 3, "records": 1, "bad_records": 1, "keyless": 0}
    with pytest.raises(PG.BadPageBudgetExceeded):
        PG.read_change_pages(spark, d, NOW, budget=2)


def test_store_errors_are_not_an_empty_table(spark):
    root = tempfile.mkdtemp(prefix="store-", dir="/tmp")
    store = ST.raw_store(spark, f"{root}/raw", buckets=2)
    base = snapshot_raw(spark, "/root/testdata/sf0.001").limit(20)
    assert not store.exists() and store.read().count() == 0
    store.replace(base)
    for data in [os.path.join(p, f) for p, _, files in os.walk(f"{root}/raw/data") for f in files if f.endswith(".parquet")]:
        with open(data, "wb") as f:
            f.write(b"not a parquet file")
    with pytest.raises(Exception):
        store.merge(base.limit(1).withColumn("inner_id", F.lit("new")))
    assert ST.raw_store(spark, f"{root}/raw").last_batch() == -1


def test_two_writers_conflict_visibly(spark):
    root = tempfile.mkdtemp(prefix="store-", dir="/tmp")
    base = snapshot_raw(spark, "/root/testdata/sf0.001").limit(20)
    one, two = (ST.raw_store(spark, f"{root}/raw", buckets=2) for _ in range(2))
    one.replace(base)
    seen = two.version()
    one.merge(base.withColumn("active_status", F.lit(1)))
    two.version = lambda: seen  # read before the other wrote
    with pytest.raises(ST.VersionConflict):
        two.merge(base.withColumn("active_status", F.lit(2)))
    assert {r.active_status for r in one.read().collect()} == {1}


def test_store_commit_is_the_switch(spark):
    root = tempfile.mkdtemp(prefix="store-", dir="/tmp")
    store = ST.raw_store(spark, f"{root}/raw", buckets=4)
    base = snapshot_raw(spark, "/root/testdata/sf0.001")
    store.replace(base, batch_id=0)
    before = store.read()
    # A crash after the data and before the commit: a folder that nothing names.
    lost = base.withColumn("active_status", F.lit(7))
    store._write(store._whole(lost).withColumn("bucket", ST.bucket_of(F.col("inner_id"), 4)))
    assert store.read().where("active_status = 7").count() == 0
    changed = base.where("id < 3").withColumn("active_status", F.lit(1))
    store.merge(changed, batch_id=1)
    store.merge(changed.withColumn("active_status", F.lit(5)), batch_id=1)
    assert store.last_batch() == 1 and store.read().where("active_status = 1").count() == 3
    assert before.where("active_status = 1").count() == 0  # an older read still has its files
    store.merge(base.limit(0), batch_id=2)
    assert store.last_batch() == 2 and store.read().count() == base.count()
    assert store.prune() >= 1 and store.read().count() == base.count()
    store.replace(base.limit(5))
    assert store.read().count() == 5 and store.lookup("1").count() <= 1


def test_sync_state_and_journal(spark):
    root = tempfile.mkdtemp(prefix="state-", dir="/tmp")
    assert ST.read_sync_state(spark, f"{root}/s").count() == 0
    ST.advance_sync_state(spark, f"{root}/s", dt.date(2025, 1, 2), 99, NOW)
    assert ST.read_sync_state(spark, f"{root}/s").first().last_change_id == 99
    ST.append_run(spark, f"{root}/log", "normalize", NOW, 3, "OK", None)
    ST.append_run(spark, f"{root}/log", "normalize", NOW, 4, "ERROR", "x")
    assert ST.read_runs(spark, f"{root}/log").count() == 2


def test_dictionary_formats(spark):
    d = tempfile.mkdtemp(prefix="dict-", dir="/tmp")
    _write(d, "a.json", {"translations_by_field": {
        "mark": {"大通": {"translation": "Maxus", "count": 3}, "智界": {"ru": "Zhijie"}, "缺": {"count": 1}},
        "options": {"车联网": {"translation": "Интернет в автомобиле"}, "大通": {"translation": "Maxus2"}}}})
    d2 = tempfile.mkdtemp(prefix="dict-", dir="/tmp")
    _write(d2, "b.json", {"红色": "Красный", "n": 5})
    got = {r.cn: r.ru for r in DI.read_dictionary(spark, d).collect()}
    assert got == {"大通": "Maxus2", "智界": "Zhijie", "车联网": "Интернет в автомобиле"}
    got2 = {r.cn: r.ru for r in DI.read_dictionary(spark, d2).collect()}
    assert got2 == {"红色": "Красный"}


def test_a_merge_that_writes_the_whole_table_deals_it_by_its_size(spark):
    path = f"{tempfile.mkdtemp(prefix='buckets-', dir='/tmp')}/t"
    table = ST.VersionedTable(spark, path, T.StructType.fromDDL("inner_id string, n long"), rows_per_bucket=10)
    rows = lambda lo, hi, by: spark.range(lo, hi).selectExpr("cast(id as string) inner_id", f"id * {by} n")
    table.merge(rows(0, 35, 1), 0)
    assert len(table.version().folders) == 4
    table.merge(rows(30, 100, 2), 1)
    assert len(table.version().folders) >= 10
    assert sorted((int(r.inner_id), r.n) for r in table.read().collect()) == [(i, i if i < 30 else 2 * i) for i in range(100)]
    assert [r.n for r in table.lookup("50").collect()] == [100]
    table.merge(rows(7, 8, 3), 2)  # one key: the other buckets stay
    assert len(table.version().folders) >= 10 and table.read().count() == 100 and [r.n for r in table.lookup("7").collect()] == [21]
