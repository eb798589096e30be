"""N-gram Jaccard join by MinHash banding.

Two documents are linked if the sets of their word n-grams have a Jaccard
likeness of `threshold` or more.

1. One scan turns each text into its n-gram set: an identity of the set (128
   bits), its size and the hashes of its bands.  Documents of equal sets are
   copies; one representative goes on, the others share its result.
2. Representatives meet on band hashes.  `choose_bands` takes rows and bands
   so that a pair at the threshold shares a band with probability `recall`.
   Each bucket of two or more is a star around its smallest member, and the
   components of these stars are the candidate groups: every pair that shares
   a band is in one group, and no pairs are written down.
3. The full n-gram sets of the members of a group meet in blocks: a group is
   cut by hash into blocks of a bounded number of members and n-grams, and
   every two blocks form a task that counts common n-grams of all its pairs
   exactly and emits, per member, its number of links and one edge of a
   spanning forest.  A group of thousands of near copies is so spread over
   many tasks, and all its pairs are verified though none is emitted.
4. Components of the forests are the classes.

The result has a row per document: its class (the smallest doc_id of all
documents connected by links), the smallest doc_id of its copies, and its
number of links, copies included.

Defined results: words are runs of anything but ASCII white space; a text of
fewer than `n` words has one n-gram, the whole; NULL text is empty, and texts
without words are copies of each other and linked to nothing else; NULL doc_id
counts as larger than any other and is given back as NULL; repeated rows are
copies; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from ..session import cut_lineage
from .components import connected_components
from .shingles import byte_tables, mixed, window_hashes, word_hashes
from .substring_dedup import LAST_ID, keyed

N, THRESHOLD, RECALL = 5, 0.8, 0.9999
MOST_HASHES = 96
BLOCK_MEMBERS, BLOCK_GRAMS = 256, 1 << 16
COLUMNS = 4096  # n-grams counted at a time


def choose_bands(threshold: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): as many rows as `most` hashes allow at the wanted recall."""
    best = (1, 1)
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows > most:
            break
        best = (bands, rows)
    return best


def gram_set(raw: bytes, tables, n: int):
    """The different n-grams of a text as sorted 64-bit hashes."""
    import numpy as np

    words = word_hashes(raw, tables)
    return np.unique(window_hashes(words, min(n, max(1, len(words)))))


def band_hashes(grams, multipliers, bands: int, rows: int):
    import numpy as np

    least = np.full(len(multipliers), np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(grams), 1 << 14):
        part = grams[start:start + (1 << 14)]
        least = np.minimum(least, (mixed(part)[None, :] * multipliers[:, None]).min(axis=1))
    band = np.zeros(bands, dtype=np.uint64)
    for column in least.reshape(bands, rows).T:
        band = mixed(band * np.uint64(0x9E3779B97F4A7C15) + column)
    return band


def described(rows: DataFrame, n: int, bands: int, per_band: int) -> DataFrame:
    """doc, tie, set_id, size and bands of every row of `keyed` documents."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        tables = byte_tables()
        multipliers = mixed(np.arange(1, bands * per_band + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in batches:
            ids, sizes, values = [], [], []
            for raw in batch.column(2):
                grams = gram_set(raw.as_py(), tables, n)
                ids.append(xxhash.xxh3_128_digest(grams.tobytes()))
                sizes.append(len(grams))
                values.append(band_hashes(grams, multipliers, bands, per_band).view(np.int64) if len(grams) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(values, pa.list_(pa.int64()))], ["doc", "tie", "set_id", "size", "bands"])

    return rows.mapInArrow(run, "doc long, tie long, set_id binary, size long, bands array<long>")


def candidate_groups(sets: DataFrame) -> DataFrame:
    """(node, label): the members of groups whose members share bands, smallest left out."""
    banded = sets.select("set_id", F.posexplode("bands").alias("band", "value"))
    buckets = (banded.groupBy("band", "value").agg(F.min("set_id").alias("hub"), F.count(F.lit(1)).alias("n"))
               .where("n > 1").drop("n"))
    return connected_components(banded.join(buckets, ["band", "value"]).where("set_id <> hub")
                                .select(F.col("set_id").alias("a"), F.col("hub").alias("b")).distinct())


def verified(members: DataFrame, threshold: float) -> DataFrame:
    """node, root and links from rows (label, low, high, block, node, copies, grams).

    Rows of one (label, low, high) are two blocks of a group, or one block if
    low = high.
    """
    # likeness >= threshold as whole numbers: inter * 10^6 >= threshold * 10^6 * union
    scale = 10 ** 6
    least = round(threshold * scale)

    def linked(sets, blocks, one_block):
        import numpy as np

        count = len(sets)
        owner = np.repeat(np.arange(count), [len(s) for s in sets])
        _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = times > 1
        column_of = np.cumsum(shared) - 1
        keep = shared[column]
        owner, column = owner[keep], column_of[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common = np.zeros((count, count), dtype=np.int64)
        for start in range(0, int(shared.sum()), COLUMNS):
            low, high = np.searchsorted(column, [start, start + COLUMNS])
            m = np.zeros((count, min(COLUMNS, int(shared.sum()) - start)), dtype=np.float32)
            m[owner[low:high], column[low:high] - start] = 1
            common += (m @ m.T).astype(np.int64)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        union = sizes[:, None] + sizes[None, :] - common
        links = common * scale >= least * union
        np.fill_diagonal(links, False)
        if not one_block:
            links &= blocks[:, None] != blocks[None, :]
        return links

    def roots(links, nodes):
        import numpy as np

        label = np.argsort(np.argsort(np.array(nodes, dtype=object)))  # the order of the nodes
        while True:
            near = np.where(links, label[None, :], len(label)).min(axis=1, initial=len(label))
            new = np.minimum(label, near)
            if (new == label).all():
                return label
            label = new

    def run(batches):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("node", pa.binary()), ("root", pa.binary()), ("links", pa.int64())])

        def settle(group, one_block):
            nodes = [g[0] for g in group]
            links = linked([g[3] for g in group], np.array([g[1] for g in group]), one_block)
            copies = np.array([g[2] for g in group], dtype=np.int64)
            label, ordered = roots(links, nodes), sorted(nodes)
            has = np.flatnonzero(links.any(axis=1))
            return pa.RecordBatch.from_arrays(
                [pa.array([nodes[i] for i in has], pa.binary()), pa.array([ordered[label[i]] for i in has], pa.binary()),
                 pa.array((links[has] @ copies).astype(np.int64))], schema=schema)

        at, group = None, {}
        for batch in batches:
            for label, low, high, block, node, copies, grams in zip(*batch.columns):
                here = (label.as_py(), low.as_py(), high.as_py())
                if here != at:
                    if len(group) > 1:
                        yield settle(list(group.values()), at[1] == at[2])
                    at, group = here, {}
                # A repeated row of a representative is the same node.
                group.setdefault(node.as_py(), (node.as_py(), block.as_py(), copies.as_py(),
                                                grams.values.to_numpy(zero_copy_only=False).view(np.uint64)))
        if len(group) > 1:
            yield settle(list(group.values()), at[1] == at[2])

    keys = ["label", "low", "high"]
    return (members.repartition(*keys).sortWithinPartitions(*keys)
            .select(*keys, "block", "node", "copies", "grams")
            .mapInArrow(run, "node binary, root binary, links long"))


def with_grams(rows: DataFrame, n: int) -> DataFrame:
    """`rows` with their n-gram sets instead of their bytes."""
    from pyspark.sql import types as T

    kept = [f for f in rows.schema.fields if f.name != "raw"]
    rows = rows.select(*[f.name for f in kept], "raw")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tables = byte_tables()
        for batch in batches:
            grams = [gram_set(raw.as_py(), tables, n).view(np.int64) for raw in batch.columns[-1]]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(grams, pa.list_(pa.int64()))],
                                             [*batch.schema.names[:-1], "grams"])

    return rows.mapInArrow(run, T.StructType([*kept, T.StructField("grams", T.ArrayType(T.LongType()))]))


def join(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc, tie (the text's hash), label (of the class), class_id, copy_id and n_links of every row."""
    bands, per_band = choose_bands(threshold, recall)
    rows = keyed(docs)
    every = cut_lineage(described(rows, n, bands, per_band))
    sets = every.groupBy("set_id").agg(
        F.min(F.struct("doc", "tie")).alias("first"), F.count(F.lit(1)).alias("copies"),
        F.any_value("size").alias("size"), F.any_value("bands").alias("bands"))
    sets = cut_lineage(sets.select("set_id", "first.doc", "first.tie", "copies", "size", "bands"))

    label = candidate_groups(sets)
    grouped = label.union(label.select("label", "label").distinct())
    nodes = sets.drop("bands").join(grouped, F.col("set_id") == F.col("node")).drop("set_id")
    parts = nodes.groupBy("label").agg(F.ceil(F.greatest(
        F.sum("size") / BLOCK_GRAMS, F.count(F.lit(1)) / BLOCK_MEMBERS)).cast("int").alias("parts"))
    nodes = (nodes.join(parts, "label")
             .withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
             .select("doc", "tie", "label", "node", "copies", "parts", "block"))
    full = with_grams(rows.join(nodes, ["doc", "tie"]), n)
    pairs = (full.withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
             .withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")))
    found = cut_lineage(verified(pairs, threshold))

    final = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    of = (sets.select("set_id", "doc", "copies")
          .join(final.withColumnRenamed("node", "set_id"), "set_id", "left")
          .join(links.withColumnRenamed("node", "set_id"), "set_id", "left")
          .select("set_id", F.col("doc").alias("copy_id"), F.coalesce("label", "set_id").alias("label"),
                  (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    classes = of.groupBy("label").agg(F.min("copy_id").alias("class_id"))
    of = of.join(classes, "label")
    return every.select("doc", "tie", "set_id").join(of, "set_id").select(
        "doc", "tie", "label", "class_id", "copy_id", "n_links")


def report(joined: DataFrame) -> DataFrame:
    """doc_id, class_id, copy_id and n_links, NULL ids as they came."""
    ids = [F.nullif(c, F.lit(LAST_ID)).alias(a) for c, a in (("doc", "doc_id"), ("class_id", "class_id"), ("copy_id", "copy_id"))]
    return joined.select(*ids, "n_links")


def deduplicate(docs: DataFrame, n: int = N, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of each class: the one with the smallest doc_id, all columns."""
    columns = docs.columns
    joined = join(docs, n, threshold, recall)
    # Rows of one doc_id may be in one class with different texts; the least hash stays.
    stays = (joined.where("doc = class_id").groupBy("label").agg(F.min(F.struct("doc", "tie")).alias("s"))
             .select(F.col("s.doc").alias("__s_doc"), F.col("s.tie").alias("__s_tie")))
    marked = docs.withColumns({"__doc": F.coalesce(F.col("doc_id"), F.lit(LAST_ID)),
                               "__tie": F.xxhash64(F.coalesce("text", F.lit("")))})
    kept = marked.join(stays, (F.col("__doc") == F.col("__s_doc")) & (F.col("__tie") == F.col("__s_tie")), "left_semi")
    return kept.dropDuplicates(["__doc", "__tie"]).select(*columns)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
