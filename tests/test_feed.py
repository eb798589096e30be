"""Feed features: nested payloads (B13), page chains (A4), paging (F6), the serving layout (C6, F8), price sketches."""

import json
import random

import pytest
from pyspark.sql import functions as F

from listing_engine.functions.nested import text_paths, translate_nested
from listing_engine.functions.quality import split_keyless
from listing_engine.operators import market as MK
from listing_engine.operators import serving as SV
from listing_engine.operators.chains import chain_order
from listing_engine.plans.catalog import snapshot_flat
from listing_engine.sources import layout as LY

SF = "/root/testdata/sf0.001"


# --- nested payloads

PAYLOADS = [
    ("deep", json.dumps({"a": {"b": [{"c": {"d": [["标准", "x"], "标准"]}}]}, "t": "标准", "n": 1, "e": {}, "l": [], "z": None}, ensure_ascii=False)),
    ("twice", '{"k":"经济","k":"标准"}'), ("text", '"标准"'), ("plain", '{"a":"abc"}'), ("broken", '{"a":'), ("none", None), ("empty", ""),
    ("nested", "[" * 200 + '"标准"' + "]" * 200),
]


def test_walk_gives_each_path_and_text_once(spark):
    df = spark.createDataFrame(PAYLOADS, "inner_id string, data string")
    got = sorted(map(tuple, text_paths(df, "data", root="r").collect()))
    assert got == sorted([
        ("deep", "r.a.b[0].c.d[0][0]", "标准"), ("deep", "r.a.b[0].c.d[1]", "标准"), ("deep", "r.t", "标准"),
        ("twice", "r.k", "标准"), ("text", "r", "标准"), ("nested", "r" + "[0]" * 200, "标准")])


def test_rewrite_keeps_everything_else(spark):
    df = spark.createDataFrame(PAYLOADS, "inner_id string, data string")
    words = spark.createDataFrame([("标准", "Std"), ("经济", "Eco")], "cn string, ru string")
    out = {r.inner_id: r.data for r in translate_nested(df, "data", words).collect()}
    assert out["deep"] == PAYLOADS[0][1].replace('"标准"', '"Std"').replace(": ", ":").replace(", ", ",")
    assert list(json.loads(out["deep"])) == ["a", "t", "n", "e", "l", "z"]
    assert out["twice"] == '{"k":"Std"}' and out["text"] == '"Std"'
    assert all(out[k] == dict(PAYLOADS)[k] for k in ("plain", "broken", "none", "empty"))


# --- page chains

def _brute_chain(pages):
    nxt = dict(pages)
    named = {n for n in nxt.values() if n in nxt}
    heads = sorted(set(nxt) - named)
    place, at, n = {}, heads[0] if heads else None, 0
    while at is not None and at in nxt and at not in place:
        place[at], at, n = n, nxt[at], n + 1
    out = []
    for cur in nxt:
        seen, x = [], nxt[cur]
        while x in nxt and x is not None and x != cur and x not in seen:
            seen.append(x)
            x = nxt[x]
        kind = ("cycle" if x == cur and nxt[cur] is not None else "head" if cur not in place and cur in heads
                else "unreached" if cur not in place else "end" if nxt[cur] is None else "gap" if nxt[cur] not in nxt else "chain")
        out.append((cur, place.get(cur), kind))
    return sorted(out)


@pytest.mark.parametrize("pages", [
    [(i, i + 1) for i in range(37)] + [(37, None)],
    [(0, 1), (1, 2), (2, 9), (5, 6), (6, 7), (7, 5), (8, 1), (10, 11), (11, None)],  # gap, cycle, second heads
    [(0, 1), (1, 2), (2, 3), (3, 1)],                                                # the head runs into a cycle
    [(1, 2), (2, 1)], [(4, None)], [(4, 4)],
])
def test_chain_order_equals_a_walk(spark, pages):
    got = chain_order(spark.createDataFrame(pages, "cur long, nxt long"), "cur", "nxt").collect()
    assert sorted((r.cur, r.place, r.kind) for r in got) == _brute_chain(pages)


def test_chain_order_of_no_pages(spark):
    assert chain_order(spark.createDataFrame([], "cur long, nxt long"), "cur", "nxt").collect() == []


# --- paging

def test_pages_in_bulk_equal_pages_one_by_one(spark):
    rng = random.Random(3)
    flat = spark.createDataFrame([(f"k{i:04d}", rng.randrange(100)) for i in range(300)], "inner_id string, price int").repartition(6)
    every = SV.all_pages(flat, 20, price_to=60)
    rows = sorted((r.page, r.position, r.inner_id) for r in every.collect())
    want = sorted(r.inner_id for r in flat.where("price <= 60").collect())
    assert rows == [(i // 20 + 1, i % 20, k) for i, k in enumerate(want)]
    after, walked = None, []
    while page := [r.inner_id for r in SV.offers_after(flat, after, 20, price_to=60).collect()]:
        walked += page
        after = page[-1]
    assert walked == want


# --- layout

def test_layout_filters_reach_the_scan(spark, tmp_path):
    flat, path = snapshot_flat(spark, SF).cache(), str(tmp_path / "layout")
    LY.write_layout(flat, path, 4)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    got = LY.stored_offers(spark, path, mark="BRAND#3", year_from=2010, price_to=9500)
    assert sorted(r.inner_id for r in got.collect()) == sorted(r.inner_id for r in SV.filter_offers(flat, mark="BRAND#3", year_from=2010, price_to=9500).collect())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(mark_key,brand#3)" in plan and "GreaterThanOrEqual(year,2010)" in plan
    one = LY.stored_offer(spark, path, "17", 4)
    assert [r.inner_id for r in one.collect()] == ["17"] and got.columns == flat.columns
    folders = {f.rsplit("/", 2)[1] for f in one.inputFiles()}
    assert len(folders) <= 4
    read = one.withColumn("file", F.input_file_name()).select("file").distinct().collect()
    assert len({r.file.rsplit("/", 2)[1] for r in read}) == 1
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()


# --- counters, sketches

def test_keyless_records_are_counted_in_passing(spark):
    rows = spark.createDataFrame([(1, "a"), (2, ""), (3, None), (4, "b")], "id long, inner_id string")
    keyed, counter = split_keyless(rows)
    assert sorted(r.id for r in keyed.collect()) == [1, 4]
    assert counter.get == {"keyless": 2, "records": 4}


def test_price_sketches_add_up(spark):
    rng = random.Random(9)
    rows = [(f"m{i % 3}", i % 20, rng.randrange(10**6) if i % 11 else None) for i in range(30_000)]
    prices = spark.createDataFrame(rows, "model string, day int, price int").repartition(7)
    sketches = MK.price_sketches(prices, ["model"])
    out = {r.model: r for r in MK.merged_prices(sketches, ["model"], (0.1, 0.5, 0.9)).collect()}
    for model, r in out.items():
        values = sorted(p for m, _, p in rows if m == model and p is not None)
        assert r.n == len(values)
        for share, q in zip((0.1, 0.5, 0.9), r.quantiles):
            rank = sum(v <= q for v in values) / len(values)
            assert abs(rank - share) <= MK.RANK_ERROR + 1 / len(values)


# --- incremental enrichment, exports

def test_incremental_rounds_end_in_the_same_tables(spark):
    from listing_engine.plans import adapters as A, jobs as J
    from listing_engine.plans.catalog import code_point_translator
    from listing_engine.schemas import FLAT
    raw, none = A.snapshot_raw(spark, SF), spark.createDataFrame([], FLAT)
    args = (raw, none, A.seed_dictionary(spark), code_point_translator, A.RUN_TIME, 2024)
    whole, part = J.enrich(*args), J.enrich_incremental(*args)
    shown = lambda t: sorted(str(r) for r in t.drop("updated_at").collect())
    assert shown(part.flat) == shown(whole.flat) and part.converged
    assert sorted(map(tuple, part.dictionary.collect())) == sorted(map(tuple, whole.dictionary.collect()))
    assert [r["normalised"] for r in part.rounds][0] == raw.count() > part.rounds[1]["normalised"] > 0


def test_exports_of_a_span_of_days(spark, tmp_path):
    import datetime as dt
    from listing_engine.sources import reports as RP
    for day in ("2024-03-01", "2024-03-02", "2024-03-03", "notes"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "active.csv").write_text(f"{day}|added|x|u|m|n|2020|5|1\n")
    got = RP.read_daily_exports(spark, str(tmp_path), dt.date(2024, 3, 2))
    assert sorted((r.inner_id, str(r.day)) for r in got.collect()) == [("2024-03-02", "2024-03-02"), ("2024-03-03", "2024-03-03")]
    assert RP.read_daily_exports(spark, str(tmp_path), dt.date(2025, 1, 1)).collect() == []
