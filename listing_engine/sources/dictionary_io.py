"""Dictionary files (A11) and the translated mining file (A14 in / out).

Two formats are read:
  (a) {"translations_by_field": {field: {cn: {"translation"|"ru": ru, ...}}}}
  (b) {cn: ru}  (non-string values skipped)
Format (a) wins when its key exists; entries with neither `translation` nor
`ru` are skipped; across fields (and files) the last entry of a cn wins.
A JSON document cannot be split, so each file is parsed by one task; a
dictionary is many small files or one bounded file, never the data itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON document: its file, its position in the file, its
    text and the `translations_by_field` object as JSON text (NULL in the
    flat format).  A file is either one (pretty-printed) document or JSON
    Lines; maps are parsed with `from_json`, which keeps document order
    (VARIANT objects sort their keys)."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), "value")
    lines = F.filter(F.split("value", "\n"), lambda ln: F.trim(ln) != "")
    json_lines = F.forall(lines, lambda ln: F.try_parse_json(ln).isNotNull())
    docs = files.select("file", F.when(json_lines, lines).otherwise(F.array("value")).alias("lines")) \
        .select("file", F.posexplode("lines").alias("line", "value")) \
        .filter(F.trim("value") != "")
    return docs.select("file", "line", "value",
                       F.from_json("value", "struct<translations_by_field: string>")
                       ["translations_by_field"].alias("tbf"))


def _structured(docs: DataFrame) -> DataFrame:
    """(file, fpos, field, epos, cn, info VARIANT) of format (a)."""
    return (docs.filter(F.col("tbf").isNotNull())
            .select("file", "line", F.posexplode(F.from_json("tbf", "map<string,string>")).alias("fpos", "field", "fv"))
            .select("file", "line", "fpos", "field",
                    F.posexplode(F.from_json("fv", "map<string,variant>")).alias("epos", "cn", "info")))


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(cn, ru) pairs with unique cn."""
    docs = _docs(spark, path)
    structured = _structured(docs).select(
        "file", "line", "fpos", "epos", "cn",
        F.coalesce(F.try_variant_get("info", "$.translation", "string"),
                   F.try_variant_get("info", "$.ru", "string")).alias("ru"))
    flat = (docs.filter(F.col("tbf").isNull())
            .select("file", "line", F.posexplode(F.from_json("value", "map<string,variant>")).alias("epos", "cn", "v"))
            .filter(F.schema_of_variant("v") == "STRING")
            .select("file", "line", F.lit(0).alias("fpos"), "epos", "cn",
                    F.try_variant_get("v", "$", "string").alias("ru")))
    entries = structured.unionByName(flat).filter(F.col("ru").isNotNull())
    return entries.groupBy("cn").agg(F.max_by("ru", F.struct("file", "line", "fpos", "epos")).alias("ru"))


def read_mined_file(spark: SparkSession, path: str) -> DataFrame:
    """A14 in: (field, text, count, priority) of a mining report file."""
    return _structured(_docs(spark, path)).select(
        "field", F.col("cn").alias("text"),
        F.try_variant_get("info", "$.count", "bigint").alias("count"),
        F.try_variant_get("info", "$.priority", "string").alias("priority"))


def write_dictionary(dictionary: DataFrame, path: str) -> None:
    """Format (b) as JSON Lines, one {cn: ru} object a line (readable by
    A11), written in parallel."""
    dictionary.select(F.to_json(F.create_map("cn", "ru")).alias("value")).write.mode("overwrite").text(path)
