"""Substring dedup: remove passages that start in a document of smaller id.

A window is `window` consecutive words.  Every word covered by a window whose
word sequence also starts in a document with a smaller doc_id goes.

1. Sketch.  All runs of `seed` words inside a window are hashed; the smallest
   hash is the window's seed.  Equal windows have equal seeds, and consecutive
   windows mostly share one, so a document has about one seed for
   (window - seed) / 2 words.  Each partition builds a count-min sketch of the
   different seeds of its documents (two rows, cells counted 0, 1, many), as
   sparse blocks of cells; the blocks are shuffled by place and added up.  A
   cell is at least as full as the number of documents that have the seed, so
   the merged sketch overestimates in how many documents a window occurs.
2. Exact.  Windows whose seed is estimated to be in two documents or more are
   grouped by their own hash together with the seed (128 bits) into the
   smallest doc_id of each; a window of a larger doc_id is repeated.  What the
   sketch rules out occurs in one document only, so nothing is lost.
3. Rebuild.  The repeated starts of each document meet its text.

The merged sketch is a bit per cell ("two or more"), sized to the input in
bytes up to `max_sketch_bits` a row, which bounds what is collected and
broadcast (2 x 64 MB by default).  Beyond that size the filter lets more
windows through to the exact step; the result is the same.  A window that a
third of all documents share is reduced to its smallest doc_id before the
shuffle.  The join that takes this back to the occurrences streams those of one
window through one partition, as narrow rows that are never held together.

Defined results: NULL text has no words; NULL doc_id counts as larger than any
other; rows of equal doc_id, whatever their texts, don't remove from each other; texts of fewer than
`window` words stay whole; an empty table gives an empty table; other columns
are passed on by `dedup` and ignored by `kept`.
"""

from __future__ import annotations

import sys

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .shingles import byte_tables, window_hashes, word_hashes

WINDOW, SEED = 50, 20
BLOCK_BITS = 16
BYTES_PER_SEED = 6 * (WINDOW - SEED + 2) // 2  # of text, about
CELLS_PER_SEED = 4
MAX_SKETCH_BITS = 1 << 29
FLUSH = 1 << 20
LAST_ID = (1 << 63) - 1
TIE_BITS = 31
TIE_MASK = (1 << TIE_BITS) - 1
CHECK_BITS = 32  # of a repeated window's hash, which its text has to have at that place


def seeds(words, window: int, seed: int):
    """The seed of every window: the smallest hash of a run of `seed` words in it."""
    import numpy as np

    if len(words) < window:
        return np.zeros(0, dtype=np.uint64)
    return np.lib.stride_tricks.sliding_window_view(window_hashes(words, seed), window - seed + 1).min(axis=1)


def cells(keys, bits: int):
    """The cell of each key in the two rows of a sketch of 2^bits cells."""
    import numpy as np

    mask = np.uint64((1 << bits) - 1)
    return keys & mask, (keys >> np.uint64(32)) & mask


def keyed(docs: DataFrame) -> DataFrame:
    """Rows with the columns that identify them: the id as a number, the text's hash, the text's bytes."""
    raw = F.coalesce("text", F.lit(""))
    return docs.select(F.coalesce(F.col("doc_id"), F.lit(LAST_ID)).alias("doc"), F.xxhash64(raw).alias("tie"),
                       raw.cast("binary").alias("raw"))


def sketch(rows: DataFrame, bits: int, window: int, seed: int) -> tuple[bytes, bytes]:
    """The merged sketch: per row a bit for each cell that two documents or more reach."""
    block_cells = 1 << min(BLOCK_BITS, bits)

    def local(batches):
        import numpy as np
        import pyarrow as pa

        tables, held, n = byte_tables(), [], 0
        schema = pa.schema([("row", pa.int32()), ("block", pa.int32()), ("once", pa.binary()), ("many", pa.binary())])

        def flush():
            out = []
            keys = np.concatenate(held) if held else np.zeros(0, dtype=np.uint64)
            for row, at in enumerate(cells(keys, bits)):
                cell, count = np.unique(at, return_counts=True)
                block, place = (cell // block_cells).astype(np.int64), (cell % block_cells).astype("<u2")
                for part in np.split(np.arange(len(cell)), np.flatnonzero(np.diff(block)) + 1):
                    if len(part):
                        out.append((row, int(block[part[0]]), place[part][count[part] == 1].tobytes(), place[part][count[part] > 1].tobytes()))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [()] * 4, schema)], schema=schema)

        for batch in batches:
            for raw in batch.column(0):
                held.append(np.unique(seeds(word_hashes(raw.as_py(), tables), window, seed)))
                n += len(held[-1])
                if n >= FLUSH:
                    yield flush()
                    held.clear()
                    n = 0
        yield flush()

    def merge(batches):
        import numpy as np
        import pyarrow as pa

        schema = pa.schema([("row", pa.int32()), ("block", pa.int32()), ("bits", pa.binary())])
        at, count = None, np.zeros(block_cells, dtype=np.uint8)

        def packed():
            return pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int32()), pa.array([at[1]], pa.int32()),
                                               pa.array([np.packbits(count >= 2, bitorder="little").tobytes()])], schema=schema)

        for batch in batches:
            for row, block, once, many in zip(*(c.to_pylist() for c in batch.columns)):
                if at != (row, block):
                    if at is not None:
                        yield packed()
                    at, count[:] = (row, block), 0
                place = np.frombuffer(once, dtype="<u2")
                count[place] = np.minimum(count[place] + 1, 2)
                count[np.frombuffer(many, dtype="<u2")] = 2
        if at is not None:
            yield packed()

    blocks = (rows.select("raw").mapInArrow(local, "row int, block int, once binary, many binary")
              .repartition("row", "block").sortWithinPartitions("row", "block")
              .mapInArrow(merge, "row int, block int, bits binary"))
    size = block_cells // 8 or 1
    merged = [bytearray(max(1, (1 << bits) // 8)) for _ in range(2)]
    for r in blocks.toLocalIterator(prefetchPartitions=True):
        merged[r.row][r.block * size:(r.block + 1) * size] = r.bits
    return bytes(merged[0]), bytes(merged[1])


def sketch_bits(rows: DataFrame, max_bits: int) -> int:
    total = rows.agg(F.sum(F.octet_length("raw")).alias("n")).first().n or 0
    wanted = min(max_bits, CELLS_PER_SEED * total // BYTES_PER_SEED)
    return max(10, int(wanted).bit_length())


def estimated_repeated(rows: DataFrame, window: int, seed: int, max_sketch_bits: int) -> DataFrame:
    """doc, at, hash and seed of every window that the sketch doesn't rule out.

    `at` has the window's place and, below it, TIE_BITS of the text's hash,
    which tell rows of one doc_id apart: these rows are the bulk of what is
    shuffled, so they are kept narrow."""
    bits = sketch_bits(rows, max_sketch_bits // 2)
    merged = rows.sparkSession.sparkContext.broadcast(sketch(rows, bits, window, seed))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        tables = byte_tables()
        filled = [np.frombuffer(x, dtype=np.uint8) for x in merged.value]
        names = ["doc", "at", "hash", "seed"]

        def many(row, at):
            return (filled[row][at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1

        held, n = [], 0
        for batch in batches:
            for doc, tie, raw in zip(*batch.columns):
                words = word_hashes(raw.as_py(), tables)
                of = seeds(words, window, seed)
                first, second = cells(of, bits)
                place = np.flatnonzero(many(0, first) & many(1, second))
                if not len(place):
                    continue
                held.append((np.full(len(place), doc.as_py(), dtype=np.int64), place << TIE_BITS | (tie.as_py() & TIE_MASK),
                             window_hashes(words, window)[place].view(np.int64), of[place].view(np.int64)))
                n += len(place)
                if n >= FLUSH // 8:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*held)], names)

    return rows.mapInArrow(run, "doc long, at long, hash long, seed long")


def repeated_starts(rows: DataFrame, window: int = WINDOW, seed: int = SEED, max_sketch_bits: int = MAX_SKETCH_BITS) -> DataFrame:
    """doc, mark (the low bits of tie) and `starts`, the windows that start in a
    smaller doc: their place and, below it, CHECK_BITS of their hash.

    Rows of one doc_id whose marks agree share `starts`; the hash tells in which
    of their texts a window stands."""
    windows = estimated_repeated(rows, window, seed, max_sketch_bits)
    first = windows.groupBy("hash", "seed").agg(F.min("doc").alias("least"))
    mark = F.col("at").bitwiseAND(F.lit(TIE_MASK))
    place = F.shiftleft(F.shiftright("at", TIE_BITS), CHECK_BITS).bitwiseOR(F.col("hash").bitwiseAND(F.lit((1 << CHECK_BITS) - 1)))
    return (windows.join(first, ["hash", "seed"]).where("doc > least")
            .groupBy("doc", mark.alias("mark")).agg(F.collect_set(place).alias("starts")))


def mark_of(tie: Column) -> Column:
    return tie.bitwiseAND(F.lit(TIE_MASK))


def without(raw: bytes, starts, window: int, tables) -> tuple[list[bytes], list[bytes]]:
    """(all words, words that no window at `starts` covers) of a text.

    A window counts if the text has it there: `starts` may hold those of
    another row of the same doc_id."""
    import numpy as np

    words = raw.split()
    if starts is None or not len(starts) or len(words) < window:
        return words, words
    starts = np.asarray(starts, dtype=np.int64)
    at, check = starts >> CHECK_BITS, starts & ((1 << CHECK_BITS) - 1)
    hashes = window_hashes(word_hashes(raw, tables), window).view(np.int64) & ((1 << CHECK_BITS) - 1)
    inside = at < len(hashes)
    at = at[inside][hashes[at[inside]] == check[inside]]
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + window, -1)
    stays = np.cumsum(edge[:-1]) == 0
    return words, [w for w, s in zip(words, stays.tolist()) if s]


def kept(docs: DataFrame, window: int = WINDOW, seed: int = SEED, max_sketch_bits: int = MAX_SKETCH_BITS) -> DataFrame:
    """doc_id, n_words, n_removed and `kept`, the words that stay joined by one space."""
    rows = keyed(docs)
    starts = repeated_starts(rows, window, seed, max_sketch_bits)

    def run(batches):
        import pyarrow as pa

        tables, names = byte_tables(), ["doc", "n_words", "n_removed", "kept"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        for batch in batches:
            for low in range(0, batch.num_rows, 256):
                out = []
                for doc, raw, at in zip(*batch.slice(low, 256).columns):
                    words, stay = without(raw.as_py(), at.as_py(), window, tables)
                    out.append((doc.as_py(), len(words), len(words) - len(stay), b" ".join(stay).decode()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    marked = rows.select("doc", mark_of(F.col("tie")).alias("mark"), "raw")
    joined = marked.join(starts, ["doc", "mark"], "left").select("doc", "raw", "starts")
    return (joined.mapInArrow(run, "doc long, n_words long, n_removed long, kept string")
            .select(F.nullif("doc", F.lit(LAST_ID)).alias("doc_id"), "n_words", "n_removed", "kept"))


def dedup(docs: DataFrame, window: int = WINDOW, seed: int = SEED, max_sketch_bits: int = MAX_SKETCH_BITS) -> DataFrame:
    """`docs` without repeated passages, all columns; documents of which no word stays go.

    A document that loses nothing keeps its text as it is; in others the words
    that stay are joined by one space.
    """
    starts = (repeated_starts(keyed(docs), window, seed, max_sketch_bits)
              .select(F.col("doc").alias("__s_doc"), F.col("mark").alias("__s_mark"), F.col("starts").alias("__starts")))
    text = F.coalesce("text", F.lit(""))

    @F.arrow_udf("string")
    def remaining(raw: pa.Array, at: pa.Array) -> pa.Array:
        tables = byte_tables()
        return pa.array([b" ".join(without(r.as_py(), a.as_py(), window, tables)[1]).decode() if a.is_valid else None for r, a in zip(raw, at)],
                        pa.string())

    marked = docs.withColumns({"__doc": F.coalesce(F.col("doc_id"), F.lit(LAST_ID)), "__mark": mark_of(F.xxhash64(text))})
    joined = marked.join(starts, (F.col("__doc") == F.col("__s_doc")) & (F.col("__mark") == F.col("__s_mark")), "left")
    # Only the texts that lose something go through Python.
    cut = F.when(F.col("__starts").isNotNull(), text.cast("binary"))
    left = joined.withColumn("__left", remaining(cut, "__starts"))
    return (left.where("__starts is null or __left <> ''")
            .select(*[F.when(F.col("__starts").isNull(), F.col("text")).otherwise(F.col("__left")).alias(c) if c == "text" else F.col(c)
                      for c in docs.columns]))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
