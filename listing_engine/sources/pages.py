"""Landed API pages -> record DataFrames.

A page file holds one envelope `{result: [...], meta: {...}}`.  Pages are read
with a declared schema (never inferred); `data` is declared STRING so the
payload keeps its JSON text, key order and duplicate keys.  All pages of a
directory form one feed (G3): one multi-file scan.  A page is parsed once, with
its whole schema, and its rows are staged by kind with their counters observed
on the way: what the count calls bad is exactly what the data leave out, and a
record that doesn't fit its schema is left out alone, not with its page.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quality import has_key
from ..functions.scalars import default_change_type, default_payload, event_time
from ..schemas import CHANGE_PAGE, OFFER_PAGE
from ..session import checkpoint_dir

CORRUPT = "_corrupt_record"
# Fixed value: failed pages tolerated before a load stops.
BAD_PAGE_BUDGET = 10


class BadPageBudgetExceeded(RuntimeError):
    pass


def _envelope(page: T.StructType) -> T.StructType:
    """The page with its records as JSON texts, so that one bad record spoils no other."""
    return T.StructType([T.StructField(f.name, T.ArrayType(T.StringType()) if f.name == "result" else f.dataType)
                         for f in page.fields] + [T.StructField(CORRUPT, T.StringType())])


def parsed_pages(texts: DataFrame, page: T.StructType) -> DataFrame:
    """One row per page text: `meta`, `result` (record texts) and `bad`.

    The envelope is parsed once, with all its fields, and both the count of
    bad pages and the records come from that parse.  Works on a batch and on
    a stream."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = texts.where(F.trim("value") != "").select(
        F.from_json("value", _envelope(page), options).alias("p"), F.col("value").alias("page_text"))
    bad = F.col(f"p.{CORRUPT}").isNotNull() | F.col("p.meta").isNull()
    return rows.select("p.meta", "p.result", F.coalesce(bad, F.lit(True)).alias("bad"), "page_text")


def _record_type(page: T.StructType) -> T.StructType:
    return page["result"].dataType.elementType


def _texts(reader, path: str, multi_line: bool) -> DataFrame:
    return reader.text(path, wholetext=multi_line)


def landed_rows(pages: DataFrame, page: T.StructType, page_field: str, now) -> DataFrame:
    """What pages hold, a row each with its `kind`: `good` records in columns,
    bad `record`s and bad `page`s as `text`, and `empty` pages."""
    fields = T.StructType(_record_type(page).fields + [T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    rows = (pages.select("bad", "page_text", "meta", F.posexplode_outer(F.when(~F.col("bad"), F.col("result"))).alias("pos", "record_text"))
            .withColumn("r", F.from_json("record_text", fields, options)))
    wrong = F.col("record_text").isNull() | F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    kind = F.when(F.col("bad"), "page").when(F.col("pos").isNull(), "empty").when(wrong, "record").otherwise("good")
    good = kind == "good"
    return rows.select(
        kind.alias("kind"), F.when(F.col("bad"), F.col("page_text")).when(kind == "record", F.col("record_text")).alias("text"),
        F.col("r.id").alias("id"), F.col(f"meta.{page_field}").alias("page"), "pos", F.col("r.inner_id").alias("inner_id"),
        F.when(good, default_change_type(F.col("r.change_type"))).alias("change_type"),
        F.when(good, event_time(F.col("r.created_at"), now)).alias("created_at"),
        F.when(good, default_payload(F.col("r.data"))).alias("data"))


# What a load counts while it passes the rows on.
def _counters() -> list:
    kind = F.col("kind")
    n = lambda c, name: F.count_if(c).cast("bigint").alias(name)
    return [n(kind.isin("page", "empty") | (F.col("pos") == 0), "pages"), n(kind == "page", "bad_pages"), n(kind == "good", "records"),
            n(kind == "record", "bad_records"), n((kind == "good") & F.coalesce(~has_key(F.col("inner_id")), F.lit(True)), "keyless")]


@dataclass
class PageRead:
    records: DataFrame   # the good records
    left_out: DataFrame  # kind and text of bad pages and bad records
    counters: dict       # pages, bad_pages, records, bad_records, keyless
    path: str            # the staged rows, a folder per kind

    def drop_good(self) -> None:
        """Remove the staged good records, once they are applied."""
        _delete(self.records.sparkSession, f"{self.path}/kind=good")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(rows: DataFrame, path: str, budget: int = BAD_PAGE_BUDGET) -> PageRead:
    """Write `landed_rows` once, a folder per kind, and read them
    back.  The counters are observed in that one pass, so a page is read and
    parsed once, whatever is done with its rows.  More bad pages than `budget`
    raise before anything is applied."""
    spark, seen = rows.sparkSession, Observation()
    rows.observe(seen, *_counters()).write.mode("overwrite").partitionBy("kind").parquet(path)
    counters = {k: int(v or 0) for k, v in seen.get.items()}
    if counters["bad_pages"] > budget:
        raise BadPageBudgetExceeded(f"{counters['bad_pages']} bad pages > budget {budget}")
    staged = spark.read.schema(rows.schema).parquet(path)
    return PageRead(staged.where("kind = 'good'").drop("kind", "text"),
                    staged.where("kind in ('page', 'record')").select("kind", "text"), counters, path)


def read_pages(pages: DataFrame, page: T.StructType, page_field: str, now, budget: int) -> PageRead:
    """Stage parsed pages in a fresh folder of the session's shared checkpoint folder."""
    path = f"{checkpoint_dir(pages.sparkSession).rstrip('/')}/pages-{uuid.uuid4().hex}"
    return stage(landed_rows(pages, page, page_field, now), path, budget)


def load_offer_pages(spark: SparkSession, path: str, now, max_pages: int | None = None,
                     multi_line: bool = True, budget: int = BAD_PAGE_BUDGET) -> PageRead:
    """A1 (+ A5, A6, E10): snapshot records with their page number.
    `max_pages` keeps pages 1..n, before the records are exploded."""
    pages = parsed_pages(_texts(spark.read, path, multi_line), OFFER_PAGE)
    if max_pages:
        pages = pages.where(F.col("bad") | (F.col("meta.page") <= max_pages))
    return read_pages(pages, OFFER_PAGE, "page", now, budget)


def load_change_pages(spark: SparkSession, path: str, now, from_change_id: int | None = None,
                      multi_line: bool = True, budget: int = BAD_PAGE_BUDGET) -> PageRead:
    """A2 (+ A6, E10): change records in feed order (id, then position in the
    page).  A page whose next cursor is not past `from_change_id` is dropped
    before its records are exploded."""
    pages = parsed_pages(_texts(spark.read, path, multi_line), CHANGE_PAGE)
    if from_change_id is not None:
        pages = pages.where(F.col("bad") | F.col("meta.next_change_id").isNull() | (F.col("meta.next_change_id") > from_change_id))
    rows = landed_rows(pages, CHANGE_PAGE, "cur_change_id", now)
    if from_change_id is not None:
        rows = rows.where((F.col("kind") != "good") | (F.col("id") >= from_change_id))
    return stage(rows, f"{checkpoint_dir(spark).rstrip('/')}/pages-{uuid.uuid4().hex}", budget)


def read_offer_pages(spark: SparkSession, path: str, now, max_pages: int | None = None,
                     multi_line: bool = True, budget: int = BAD_PAGE_BUDGET) -> tuple[DataFrame, int]:
    """A1 as (records, bad page count)."""
    read = load_offer_pages(spark, path, now, max_pages, multi_line, budget)
    return read.records, read.counters["bad_pages"]


def read_change_pages(spark: SparkSession, path: str, now, from_change_id: int | None = None,
                      multi_line: bool = True, budget: int = BAD_PAGE_BUDGET) -> tuple[DataFrame, int]:
    """A2 as (records, bad page count)."""
    read = load_change_pages(spark, path, now, from_change_id, multi_line, budget)
    return read.records, read.counters["bad_pages"]


def stream_page_texts(spark: SparkSession, path: str, max_files: int = 100, multi_line: bool = True) -> DataFrame:
    """A3: the page texts as a stream (one page file = one unit of progress,
    `maxFilesPerTrigger` bounds a micro-batch)."""
    return _texts(spark.readStream.option("maxFilesPerTrigger", max_files), path, multi_line)


def stage_batch(texts: DataFrame, now, path: str, batch_id: int, budget: int = BAD_PAGE_BUDGET) -> PageRead:
    """The rows of one micro-batch of `stream_page_texts`, parsed once; a
    folder per batch, which a replay writes again in place."""
    rows = landed_rows(parsed_pages(texts, CHANGE_PAGE), CHANGE_PAGE, "cur_change_id", now)
    return stage(rows, f"{path.rstrip('/')}/batch_id={batch_id}", budget)


def stream_change_pages(spark: SparkSession, path: str, now, max_files: int = 100,
                        multi_line: bool = True) -> DataFrame:
    """A3: the records of the good pages of the stream.  A job that wants the
    bad ones too stages the texts batch by batch, as H2 does."""
    rows = landed_rows(parsed_pages(stream_page_texts(spark, path, max_files, multi_line), CHANGE_PAGE), CHANGE_PAGE, "cur_change_id", now)
    return rows.where("kind = 'good'").drop("kind", "text")


def page_chain_gaps(pages: DataFrame, cur: str, nxt: str, size: str | None = None) -> DataFrame:
    """A4: pages whose next cursor names no page (a gap), and terminal pages
    (next cursor NULL, or an empty page).  `pages` holds one row per page
    with columns `cur`, `nxt` (and optionally the record count `size`)."""
    p = pages.select(F.col(cur).alias("cur"), F.col(nxt).alias("nxt"),
                     (F.col(size) if size else F.lit(None)).alias("size"))
    known = p.select(F.col("cur").alias("nxt"))
    gaps = p.filter(F.col("nxt").isNotNull()).join(known, "nxt", "left_anti").withColumn("kind", F.lit("gap"))
    ends = p.filter(F.col("nxt").isNull() | (F.col("size") == 0)).withColumn("kind", F.lit("terminal"))
    return gaps.unionByName(ends).select("cur", "nxt", "kind")


def write_change_pages(changes: DataFrame, path: str, page_size: int = 20, files: int | None = None) -> None:
    """Land a change feed as page envelopes (JSON lines, one page a line):
    page n holds the records with id in [n * page_size, (n + 1) * page_size),
    sorted by id; its next cursor is the first id of page n + 1 (an equi-join
    of each page with its successor), NULL when that page is empty, which
    `page_chain_gaps` reports as the end of the chain.  Used to replay a
    feed through A2 / A3 / H2; a page is a bounded group of records."""
    recs = changes.select(
        F.floor(F.col("id") / page_size).cast("bigint").alias("pg"),
        F.struct(F.col("id"), F.col("inner_id"), F.col("change_type"),
                 F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("created_at"),
                 F.col("data")).alias("r"))
    pages = recs.groupBy("pg").agg(F.array_sort(F.collect_list("r")).alias("result")) \
        .withColumn("cur_change_id", F.col("result")[0]["id"])
    succ = pages.select((F.col("pg") - 1).alias("pg"), F.col("cur_change_id").alias("next_change_id"))
    out = pages.join(succ, "pg", "left").select(F.to_json(F.struct(
        F.col("result"),
        F.struct("cur_change_id", "next_change_id", F.lit(page_size).alias("limit")).alias("meta"))).alias("value"))
    if files:
        out = out.repartition(files)
    out.write.mode("overwrite").text(path)
