"""A walk over any nested payload, and the rewrite of its texts (§1.4).

The payload is JSON text; a walk gives (path, text) with paths like
`a.b[0].c`, each pair once per record.  Recursion over values of any shape has
no column expression, so both are small Python functions per record that Spark
calls on Arrow batches (a UDTF by lateral join, a UDF); the lookup between them
is a join.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PATH_AND_TEXT = T.StructType([T.StructField("path", T.StringType()), T.StructField("text", T.StringType())])


def _leaves(value, path: str) -> Iterator[tuple[str, str]]:
    """(path, text) of every text in a parsed value; a stack, so that depth is no limit."""
    stack = [(value, path)]
    while stack:
        v, p = stack.pop()
        if isinstance(v, str):
            yield p, v
        elif isinstance(v, dict):
            stack += [(x, f"{p}.{k}" if p else k) for k, x in reversed(v.items())]
        elif isinstance(v, list):
            stack += [(x, f"{p}[{i}]") for i, x in reversed(list(enumerate(v)))]


def _parsed(text: str | None):
    try:
        return json.loads(text) if text else None
    except ValueError:
        return None


@F.udtf(returnType=_PATH_AND_TEXT)
class TextPaths:
    """The texts of a payload that hold a character between `low` and `high`."""

    def eval(self, payload: str, root: str, low: str, high: str):
        seen = set()
        for path, text in _leaves(_parsed(payload), root or ""):
            if (path, text) not in seen and any(low <= c <= high for c in text):
                seen.add((path, text))
                yield path, text


def text_paths(df: DataFrame, payload: str, keep: tuple[str, ...] = ("inner_id",), root: str = "",
               low: str = "一", high: str = "鿿") -> DataFrame:
    """`keep` columns, path and text of every Han text (by default) in `payload`.

    A payload that isn't JSON, is NULL or has no such text gives no row."""
    rows = df.select(*keep, F.col(payload).alias("__payload"))
    walked = rows.lateralJoin(TextPaths(F.col("__payload").outer(), F.lit(root), F.lit(low), F.lit(high)))
    return walked.select(*keep, "path", "text")


@F.arrow_udf(T.StringType())
def _rewritten(payload: pa.Array, old: pa.Array, new: pa.Array) -> pa.Array:
    out = []
    for text, a, b in zip(payload.to_pylist(), old.to_pylist(), new.to_pylist()):
        value = _parsed(text) if a else None
        if value is None:
            out.append(text)
            continue
        put, holder = dict(zip(a, b)), [value]
        stack = [holder]
        while stack:  # texts are replaced in place: keys keep their order, empty containers stay
            v = stack.pop()
            for k, x in list(v.items() if isinstance(v, dict) else enumerate(v)):
                if isinstance(x, str):
                    v[k] = put.get(x, x)
                elif isinstance(x, (dict, list)):
                    stack.append(x)
        out.append(json.dumps(holder[0], ensure_ascii=False, separators=(",", ":")))
    return pa.array(out, pa.string())


def rewrite_texts(payload: Column, old: Column, new: Column) -> Column:
    """The payload with each text that is in `old` replaced by its partner in `new`."""
    return _rewritten(payload, old, new)


def translate_nested(df: DataFrame, payload: str, dictionary: DataFrame, key: str = "inner_id") -> DataFrame:
    """§1.4 on whole payloads: every text that the dictionary (cn, ru) has is
    replaced, wherever it stands; others and everything else stay.

    Records without a known text don't pass the rewrite.  `key` is unique."""
    known = (text_paths(df, payload, (key,)).select(key, "text").distinct()
             .join(dictionary.select(F.col("cn").alias("text"), "ru"), "text")
             .groupBy(key).agg(F.array_sort(F.collect_list(F.struct("text", "ru"))).alias("__pairs")))
    joined = df.join(known, key, "left")
    return joined.withColumn(payload, rewrite_texts(F.col(payload), F.col("__pairs.text"), F.col("__pairs.ru"))).drop("__pairs")


cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this package
