"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `vnodes` points of a 32-bit ring.  A document belongs to the
first point clockwise of the hash of its doc_id, its arc.  A shard accepts at
most its capacity; what an arc offers beyond that goes on clockwise to the
next point whose shard has room.

Only the number of documents per arc matters for who overflows, so Spark
counts the arcs (shards x vnodes numbers, whatever the input size), the driver
settles the overflow on those counts as intervals of rank within an arc, and
Spark ranks the documents of each arc and looks their interval up.  Ranks are
prefix sums over cells (arc, hash slice) of about sqrt(rows) rows, so no task
holds a whole arc or shard.  Equal (doc_id, size, crc) rows are counted before
the shuffle and expanded at the end, so a repeated row can hold any share.

With `headroom=0` the capacities are the floor and ceiling of the mean, which
all shards then reach: counts differ by one at most (law `rows`).  With more
headroom fewer documents move when a shard is added.

Defined results: NULL text has size 16 and the CRC of no bytes; NULL doc_ids
share one ring place and overflow like any other key; repeated rows are
placed one by one; the order within an arc is by hash, then by the columns; an
empty table gives an empty table.  Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import math
import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F

from ..session import cut_lineage

RING = 1 << 32
CHUNK = 1 << 16  # copies of one row made at a time


def ring_points(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """(position, shard), clockwise; a shard's points don't depend on the others."""
    return sorted((int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=4).digest(), "big"), s)
                  for s in range(shards) for v in range(vnodes))


def capacities(rows: int, shards: int, headroom: float) -> list[int]:
    if headroom:
        return [math.ceil((1 + headroom) * rows / shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def settle(counts: dict[int, int], owners: list[int], capacity: list[int]) -> list[tuple[int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot) of every accepted interval."""
    free, taken, out = list(capacity), [0] * len(capacity), []
    pending = [(arc, arc, 0, n) for arc, n in sorted(counts.items()) if n]
    while pending:
        over = []
        for place, arc, low, high in pending:
            shard = owners[place]
            n = min(free[shard], high - low)
            if n:
                out.append((arc, low, low + n, shard, taken[shard]))
                free[shard] -= n
                taken[shard] += n
            if low + n < high:
                over.append(((place + 1) % len(owners), arc, low + n, high))
        pending = sorted(over)
    return out


def place(docs: DataFrame, shards: int = 40, vnodes: int = 128, headroom: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row."""
    spark = docs.sparkSession
    points = ring_points(shards, vnodes)
    positions, owners = [p for p, _ in points], [s for _, s in points]

    @F.pandas_udf("int")
    def arc_of(position: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series(np.searchsorted(np.array(positions), position.to_numpy(), side="left") % len(positions))

    text = F.coalesce("text", F.lit(""))
    rows = cut_lineage(
        docs.select("doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("arc", arc_of(F.xxhash64("doc_id").bitwiseAND(F.lit(RING - 1))))
        .withColumn("tie", F.xxhash64("doc_id", "size", "text_crc32"))
    )
    counts = {r.arc: r.n for r in rows.groupBy("arc").agg(F.sum("copies").alias("n")).collect()}
    total = sum(counts.values())
    intervals = spark.createDataFrame(
        settle(counts, owners, capacities(total, shards, headroom)),
        "arc int, low long, high long, shard int, first_slot long")

    slices = math.ceil(math.sqrt(total) / len(points)) or 1
    rows = rows.withColumn("slice", F.pmod("tie", F.lit(slices)))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    cells = rows.groupBy("arc", "slice").agg(F.sum("copies").alias("n")).select(
        "arc", "slice",
        F.coalesce(F.sum("n").over(before.partitionBy("arc").orderBy("slice")), F.lit(0)).alias("cell_rank"))
    inside = before.partitionBy("arc", "slice").orderBy("tie", "doc_id", "size", "text_crc32")
    ranked = (rows.withColumn("inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
              .join(cells, ["arc", "slice"])
              .withColumn("rank", F.col("cell_rank") + F.col("inside")))
    # The intervals are bounded by shards x vnodes, not by the data.
    placed = (ranked.join(F.broadcast(intervals), "arc")
              .where("low < rank + copies and rank < high")
              .withColumn("start", F.greatest("rank", "low"))
              .withColumn("n", F.least(F.col("rank") + F.col("copies"), "high") - F.col("start"))
              .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (n - 1) div {CHUNK})")))
              .withColumn("i", F.explode(F.expr(
                  f"sequence(chunk * {CHUNK}L, least(n - 1, chunk * {CHUNK}L + {CHUNK - 1}))"))))
    return placed.select("doc_id", "size", "text_crc32", "shard",
                         (F.col("first_slot") + F.col("start") - F.col("low") + F.col("i")).alias("slot"))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
