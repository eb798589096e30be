"""Report sinks (A12, A13, A14 out, A15) and the daily export scan.

Reports hold distinct mined texts (bounded by the vocabulary, not by the
data); they are assembled by Spark aggregations and written as text.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import EXPORT


def write_mining_report(entries: DataFrame, metadata: DataFrame, summary: DataFrame, path: str,
                        extracted_at: str) -> None:
    """A12 as JSON Lines, written in parallel: one line
    {"metadata": ..., "summary_by_priority": ...} and one line per entry
    {"translations_by_field": {field: {text: {count, priority[, translation,
    auto_translated]}}}}, so each line is itself a document of the
    structured format and no task or group holds the whole report.

    `entries`: (field, text, count, priority[, translation]); `metadata`:
    one row (E3); `summary`: one row (E4)."""
    info_cols = [F.col("count"), F.col("priority")] + \
        ([F.col("translation"), F.lit(True).alias("auto_translated")] if "translation" in entries.columns else [])
    entry_lines = entries.select(F.to_json(F.struct(F.create_map(
        F.col("field"), F.create_map(F.col("text"), F.struct(*info_cols)))
        .alias("translations_by_field"))).alias("value"))
    meta = metadata.withColumn("extracted_at", F.lit(extracted_at))
    head = meta.select(F.struct(*meta.columns).alias("metadata"), F.lit(1).alias("_k")).join(
        summary.select(F.struct(*summary.columns).alias("summary_by_priority"), F.lit(1).alias("_k")), "_k")
    head_line = head.select(F.to_json(F.struct("metadata", "summary_by_priority")).alias("value"))
    head_line.unionByName(entry_lines).write.mode("overwrite").text(path)



def untranslated_report_lines(entries: DataFrame, freq: DataFrame, top: int = 100) -> DataFrame:
    """Report lines with what they are ordered by: the totals, each
    field's texts by count (fields by total occurrences), the global top
    `top`.  The order is left to one range-partitioned sort; nothing is ranked
    in a window over all texts of a field."""
    line = lambda kind, total, field, n, text, shown: (
        F.lit(kind).alias("kind"), total.cast("bigint").alias("field_total"), field.alias("field"),
        n.cast("bigint").alias("n"), text.alias("text"), shown.alias("line"))
    zero, empty = F.lit(0), F.lit("")
    totals = entries.agg(F.sum("count").alias("occ"), F.count(F.lit(1)).alias("cnt")).select(*line(
        0, zero, empty, zero, empty, F.format_string("total occurrences %d, distinct entries %d", "occ", "cnt")))
    by_field = entries.groupBy(F.col("field")).agg(F.sum("count").alias("occ"))
    per_field = entries.join(by_field, "field").select(*line(
        1, F.col("occ"), F.col("field"), F.col("count"), F.col("text"), F.format_string("%s\t%6d\t%s", "field", "count", "text")))
    most = freq.orderBy(F.col("total").desc(), "text").limit(top).select(*line(
        2, zero, empty, F.col("total"), F.col("text"), F.format_string("TOP\t%6d\t%s", "total", "text")))
    return totals.unionByName(per_field).unionByName(most)


def write_untranslated_report(lines: DataFrame, path: str) -> None:
    """A13 sink: ordered text (range-partitioned sort, no single-task sort)."""
    lines.orderBy("kind", F.desc("field_total"), "field", F.desc("n"), "text").select("line").write.mode("overwrite").text(path)


def preview(flat: DataFrame, n: int = 3) -> DataFrame:
    """First n listings: scalar columns, option count, first 3 options,
    first 5 configuration ids, the first parameter."""
    keys = F.array_sort(F.map_keys("configuration"))
    return flat.orderBy("id").limit(n).select(
        "id", "inner_id", "mark", "model", "year", "price", "km_age", "color",
        F.size("options").alias("n_options"), F.slice("options", 1, 3).alias("first_options"),
        F.slice(keys, 1, 5).alias("first_config_ids"),
        F.element_at("configuration", keys[0]).alias("first_param"))


def read_daily_export(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-separated daily export files (one directory per date)."""
    return spark.read.option("sep", "|").option("header", False).schema(EXPORT).csv(path)


def read_daily_exports(spark: SparkSession, root: str, since: dt.date | None = None, until: dt.date | None = None) -> DataFrame:
    """J7 over many days: the exports below `root`, one folder per date
    (`2024-01-31`), with the date as `day`.  Folders outside the span, and
    those whose name is no date, are not read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    days = []
    for status in fs.listStatus(folder):
        try:
            day = dt.date.fromisoformat(status.getPath().getName())
        except ValueError:
            continue
        if status.isDirectory() and (since is None or day >= since) and (until is None or day <= until):
            days.append(day)
    if not days:
        return spark.createDataFrame([], EXPORT).withColumn("day", F.lit(None).cast("date"))
    paths = [f"{root.rstrip('/')}/{day.isoformat()}" for day in sorted(days)]
    rows = spark.read.option("sep", "|").option("header", False).schema(EXPORT).csv(paths)
    name = F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{4}-\d{2}-\d{2})/[^/]*$", 1)
    return rows.select(*EXPORT.names, F.to_date(name).alias("day"))
