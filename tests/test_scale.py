"""Plans that have to hold on large tables: what runs once, and where."""

from pyspark.sql import functions as F

from listing_engine.operators import flat as FL
from listing_engine.operators import mining as MI
from listing_engine.operators import serving as SV
from listing_engine.operators.normalise import normalise_rows
from listing_engine.plans import adapters as A
from listing_engine.plans import jobs as J

RAW = ("id long, inner_id string, change_type string, created_at timestamp_ntz, data string, first_loaded_at timestamp_ntz, "
       "last_updated_at timestamp_ntz, source string, active_status int, is_processed boolean")
PAYLOAD = ('{"mark":"标准","model":"未知","configuration":{"paramtypeitems":[{"paramitems":['
           '{"id":"93","name":"前驱","value":null},{"id":" 9_1 ","name":"x"},{"id":90.0},{"id":true},7,{"id":93,"value":"标配"}]}]}}')


def _raw(spark, keys, data=PAYLOAD):
    rows = [(i, k, "added", A.SNAPSHOT_TIME, data, A.SNAPSHOT_TIME, A.SNAPSHOT_TIME, "s", 0, False) for i, k in enumerate(keys)]
    return spark.createDataFrame(rows, RAW)


def test_dictionary_is_broadcast_and_texts_stay(spark):
    """No text is shuffled to a small dictionary: one exchange, of the payloads."""
    rows = normalise_rows(_raw(spark, ["a", "b"]), A.seed_dictionary(spark), 2026).rows
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 2
    assert plan.count("Exchange hashpartitioning") == 1


def test_small_payloads_keep_their_partitions(spark):
    """Adaptive execution goes by compressed bytes and would merge these into one task."""
    keys = [str(i) for i in range(400)]
    rows = normalise_rows(_raw(spark, keys), A.seed_dictionary(spark), 2026).rows
    tasks = rows.select("inner_id", "mark").groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) == 8 and sum(r["count"] for r in tasks) == 400


def test_missing_texts_and_configuration(spark):
    r = normalise_rows(_raw(spark, ["a"]), A.seed_dictionary(spark), 2026).rows.first()
    assert (r.mark, r.model, r.color, r.options) == ("Стандарт", "未知", None, [])
    assert {k: tuple(v) for k, v in r.configuration.items()} == {
        "93": ("", "Стандартная комплектация"), "91": ("x", "")}


def test_once_mines_once(spark):
    """The translator's texts come from one pass over the listings."""
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    raw = _raw(spark, ["a", "b", "c"])
    counted = raw.select("inner_id", "data").mapInPandas(touch, "inner_id string, data string")
    flat = normalise_rows(raw.drop("data").join(counted, "inner_id"), A.seed_dictionary(spark), 2026).rows
    out = J.enrich_once(None, flat, A.seed_dictionary(spark), lambda t: t + "!", A.RUN_TIME, 2026, dry_run=True)
    assert out["new_entries"] == out["dict_added"] == 1
    assert seen.value == 3


def test_normalising_counts_in_the_pass_that_parses(spark):
    """Pending and rejected rows are counted without reading the payloads again."""
    from listing_engine.schemas import FLAT
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    raw = _raw(spark, ["a", "a", None, "b", "c"]).withColumn("data", F.when(F.col("inner_id") == "b", "7").otherwise(F.col("data")))
    n = J.normalise_tables(raw.mapInPandas(touch, RAW), spark.createDataFrame([], FLAT), A.seed_dictionary(spark), A.RUN_TIME, 2026)
    assert seen.value == 5
    assert {k: n.stats.counters[k] for k in ("pending", "errors", "created", "updated", "processed")} == {
        "pending": 5, "errors": 2, "created": 2, "updated": 0, "processed": 2}
    assert sorted(r.inner_id for r in n.keys.collect()) == ["a", "c"] and n.rejected.count() == 2
    none = J.normalise_tables(raw.where("false"), spark.createDataFrame([], FLAT), A.seed_dictionary(spark), A.RUN_TIME, 2026)
    assert none.stats.counters["pending"] == none.stats.counters["errors"] == 0


def test_incremental_rounds_read_due_listings_once(spark, monkeypatch):
    """Each round reads the listings it normalises once, counters included."""
    from listing_engine.plans.catalog import code_point_translator
    from listing_engine.schemas import FLAT
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    found = FL.pending
    monkeypatch.setattr(FL, "pending", lambda raw, limit=None: found(raw, limit).mapInPandas(touch, RAW))
    raw = _raw(spark, ["a", "b"]).unionByName(_raw(spark, ["c"], '{"mark":"标准"}'))
    res = J.enrich_incremental(raw, spark.createDataFrame([], FLAT), A.seed_dictionary(spark), code_point_translator, A.RUN_TIME, 2026)
    assert [r["normalised"] for r in res.rounds] == [3, 2] and seen.value == 5


def test_page_reads_listings_once(spark):
    rows = spark.range(50).select(F.format_string("%03d", "id").alias("inner_id"), F.lit(1).alias("price"))
    page, meta = SV.offers_page(rows, page=2, size=20)
    assert "Range" not in page._jdf.queryExecution().optimizedPlan().toString()
    assert [r.inner_id for r in page.collect()] == [f"{i:03d}" for i in range(20, 40)] and meta.first().next_page == 3


def test_retranslate_keeps_rows_without_key_and_repeats(spark):
    raw = _raw(spark, ["a", "b"])
    once = normalise_rows(raw, A.seed_dictionary(spark), 2026).rows.withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    keyless = once.where("inner_id = 'b'").withColumn("inner_id", F.lit(None).cast("string"))
    flat = once.unionByName(once.where("inner_id = 'a'")).unionByName(keyless)
    more = A.seed_dictionary(spark).unionByName(spark.createDataFrame([("未知", "Неизвестно")], "cn string, ru string"))
    table, stats = FL.retranslate(flat, raw, more, A.RUN_TIME, fields=["model"])
    got = sorted((r.inner_id or "", r.model, r.updated_at is None) for r in table.collect())
    assert got == [("", "未知", True), ("a", "Неизвестно", False), ("a", "Неизвестно", False), ("b", "Неизвестно", False)]
    assert stats.first().updated == 3
    assert MI.untranslated_records(table).first().records_with_han == 1
