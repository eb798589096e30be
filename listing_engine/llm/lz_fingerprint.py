"""Document fingerprints from Lempel-Ziv phrases.

A text is parsed into the phrases of an incremental (LZ78) dictionary: each
phrase is the shortest string not met before.  Texts that would compress each
other share phrases.  A fingerprint is the SIZE smallest distinct 32-bit hashes
of the phrase set, in order, as base64; the likeness of two fingerprints is
the share of the smallest hashes of both together that both have, an estimate
of the Jaccard likeness of the phrase sets (exact below SIZE phrases).

`fingerprints` is a single scan.  `with_neighbours` also needs each document's
successor in descending doc_id: documents are dealt into slices of the id
range, an id with many rows (or none) into slices of its texts' hash, sorted
within them, and the first document of the next slice is dealt to both, so no
task sees more than a few slices and no order of all rows is ever built.  Each
text is shuffled once.  Only rows of one id with one and the same text stay
together; such a text is parsed once.

Defined results: NULL text is empty; an empty text has an empty fingerprint,
like another empty one to degree 1 and any other to degree 0; NULL doc_ids
come after the smallest; equal doc_ids go by a hash of their text, so repeated
rows follow each other; a single row follows itself; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

SIZE = 128
SLICES_PER_PARTITION = 4


def parse(text: str, seen: set[str], phrases: list[str], open_phrase: str = "") -> str:
    """Add the phrases of `text` to `seen` and `phrases`; returns the open phrase."""
    add, append, w = seen.add, phrases.append, open_phrase
    for c in text:
        w += c
        if w not in seen:
            add(w)
            append(w)
            w = ""
    return w


def hashes(phrases: list[str]):
    import numpy as np
    import xxhash

    h = xxhash.xxh32_intdigest
    return np.fromiter((h(p) for p in phrases), dtype="<u4", count=len(phrases))


def smallest(values):
    import numpy as np

    return np.unique(values)[:SIZE]


def text_of(signature) -> str:
    import base64

    return base64.b64encode(signature.tobytes()).decode("ascii")


def signature_of(fingerprint: str):
    import base64

    import numpy as np

    return np.frombuffer(base64.b64decode(fingerprint), dtype="<u4")


def likeness(a, b) -> float:
    import numpy as np

    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = smallest(np.concatenate([a, b]))
    return float(np.isin(both, np.intersect1d(a, b, assume_unique=True), assume_unique=True).mean())


def signature(text: str):
    phrases: list[str] = []
    parse(text, set(), phrases)
    return smallest(hashes(phrases))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint of its whole text."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            made = [text_of(signature(t.as_py() or "")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


class Parsed:
    """One document, parsed once, ready to be edited in its last third."""

    def __init__(self, doc_id, text: str):
        self.doc_id, self.text = doc_id, text
        self.third = len(text) // 3
        self.seen: set[str] = set()
        self.phrases: list[str] = []
        self.open = parse(text[:len(text) - self.third], self.seen, self.phrases)
        self.shared = len(self.phrases)
        parse(text[len(text) - self.third:], self.seen, self.phrases, self.open)
        self.hashes = hashes(self.phrases)
        self.signature = smallest(self.hashes)

    def next(self, doc_id, text: str) -> "Parsed":
        """The document behind this one; the same text isn't parsed again."""
        import copy

        if text != self.text:
            return Parsed(doc_id, text)
        same = copy.copy(self)
        same.doc_id = doc_id
        return same

    def compared(self, following: "Parsed") -> tuple:
        import hashlib

        import numpy as np

        tail, new = following.text[:self.third], []
        parse(tail, set(self.phrases[:self.shared]), new, self.open)
        edited = smallest(np.concatenate([self.hashes[:self.shared], hashes(new)]))
        text = self.text[:len(self.text) - self.third] + tail
        return (self.doc_id, len(self.text), hashlib.sha256(text.encode()).hexdigest(), text_of(self.signature),
                text_of(edited), likeness(self.signature, edited), likeness(self.signature, following.signature))


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of its edited text and the likeness
    to it and to the next document in descending doc_id."""

    spark = docs.sparkSession
    slices = SLICES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = [int(c) for c in docs.approxQuantile("doc_id", [i / slices for i in range(1, slices)], 0.25 / slices)]
    # An id that stands at several cuts has the rows of as many slices: it gets
    # a slice of its own, cut again by its texts' hash, the second sort key.
    # So do the rows without an id.
    hot = {c: found.count(c) + 1 for c in set(found) if found.count(c) > 1}
    cuts = sorted({*found, *(c + 1 for c in hot if c < (1 << 63) - 1)})
    n, without_id = docs.agg(F.count("doc_id"), F.count_if(F.col("doc_id").isNull())).first()
    parts = {len(cuts) - cuts.index(c) - 1: k for c, k in hot.items()}
    parts[len(cuts) + 1] = max(1, slices * without_id // max(1, n + without_id))

    @F.pandas_udf("int")
    def slice_of(doc_id: pd.Series) -> pd.Series:
        import numpy as np

        return pd.Series(len(cuts) - np.searchsorted(np.array(cuts, dtype=np.int64), doc_id.to_numpy(dtype=np.int64), side="right"))

    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text")).withColumn(
        "range", F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 1)).otherwise(slice_of(F.coalesce("doc_id", F.lit(0)))))
    k = F.coalesce(F.get(F.array(*[F.lit(parts.get(r, 1)) for r in range(len(cuts) + 2)]), F.col("range")), F.lit(1))
    part = F.least(k - 1, F.floor((0.5 - F.col("tie") / float(1 << 64)) * k))
    rows = rows.withColumn("slice", (F.col("range") * (slices + 1) + part).cast("int")).drop("range")
    # The first document of each slice: one narrow row a slice.
    first = {r.slice: r.top for r in rows.groupBy("slice").agg(F.max(F.struct("doc_id", "tie")).alias("top")).collect()}
    order = sorted(first)
    also = [(first[order[(i + 1) % len(order)]].doc_id, first[order[(i + 1) % len(order)]].tie, s) for i, s in enumerate(order)]
    heads = spark.createDataFrame(also, "head_id long, head_tie long, also int")
    here = F.struct(F.col("slice"), F.lit(0).alias("follows"))
    dealt = (rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")), "left")
             .withColumn("to", F.explode(F.when(F.col("also").isNull(), F.array(here)).otherwise(
                 F.array(here, F.struct(F.col("also").alias("slice"), F.lit(1).alias("follows"))))))
             .select("to.slice", "to.follows", "doc_id", "tie", "text")
             .repartition("slice")
             .sortWithinPartitions("slice", "follows", F.col("doc_id").desc_nulls_last(), F.col("tie").desc()))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        import pyarrow as pa

        schema = pa.schema(list(zip(names, [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()])))
        waiting, done = None, []
        for batch in batches:
            for _, follows, doc_id, _, text in zip(*(c for c in batch.columns)):
                if follows.as_py() and waiting is None:
                    continue  # a further copy of the head
                current = Parsed(doc_id.as_py(), text.as_py()) if waiting is None else waiting.next(doc_id.as_py(), text.as_py())
                if waiting is not None:
                    done.append(waiting.compared(current))
                waiting = None if follows.as_py() else current
                if len(done) >= 256:
                    yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in done], schema)
                    done = []
        yield pa.RecordBatch.from_pylist([dict(zip(names, x)) for x in done], schema)

    return dealt.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string,"
                                 " edited_fingerprint string, near_edited double, near_next double")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
