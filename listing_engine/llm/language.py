"""Language identification by rank-order profiles of character n-grams.

A profile is the list of the most frequent n-grams (n = 1 to 3, words padded
with a boundary mark) of a language, in rank order.  A document is given the
language whose profile its own most frequent n-grams are least out of place
in: the sum of rank differences, with the longest distance for n-grams that a
profile lacks.

`learn` counts n-grams on a sample of the labelled rows, about
`sample_per_language` a language (a documented bound: rows are kept by a hash
of doc_id at a rate of that number over the language's rows).  Equal texts in
the sample count once, so a group of copies can't make a profile.  Executors
count n-grams per task, Spark adds them up, and only the top of each language
reaches the driver.  `predict` reads every text whole, in one scan without a
shuffle, and sees nothing but the text.

Defined results: NULL text, or one without a letter, is `und` with score 0;
equal distances go to the first language in code point order; without any
labelled row every text is `und`; repeated rows are judged one by one; n-grams
of equal count rank by code point; other columns are only passed on if named
in `keep`; an empty table gives an empty table.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

RANKS = 300
SAMPLE_PER_LANGUAGE = 1000
CHUNK = 1 << 20  # characters counted at a time
BOUNDARY = 0x110000  # beyond every code point


def letter_table():
    """True where a code point of the basic plane is a letter."""
    import numpy as np

    return np.array([chr(c).isalpha() for c in range(0x10000)])


def gram_counts(text: str, letters):
    """(n-gram codes, counts) of one text, codes ascending.

    A code has 21 bits per character; no character is 0, so codes of different
    lengths differ.  Words are runs of letters, in lower case.
    """
    import numpy as np

    found = []
    # Chunks overlap in no n-gram: each starts with the last two places of the one before.
    carry = np.array([BOUNDARY], dtype=np.int64)
    for start in range(0, len(text), CHUNK):
        points = np.frombuffer(text[start:start + CHUNK].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        high = points > 0xFFFF
        is_letter = letters[np.where(high, 0, points)]
        for c in np.unique(points[high]):
            is_letter[points == c] = chr(c).isalpha()
        a = np.concatenate([carry, np.where(is_letter, points, BOUNDARY)])
        fresh = np.ones(len(a), dtype=bool)
        fresh[1:] = (a[1:] != BOUNDARY) | (a[:-1] != BOUNDARY)  # runs of marks become one
        old = int(fresh[:len(carry)].sum())
        a = a[fresh]
        if start + CHUNK >= len(text) and a[-1] != BOUNDARY:
            a = np.append(a, BOUNDARY)
        inner = a != BOUNDARY
        one = a[old:][inner[old:]]
        two = (a[:-1] << 21 | a[1:])[max(old - 1, 0):]
        three = (a[:-2] << 42 | a[1:-1] << 21 | a[2:])[inner[1:-1]] if len(a) > 2 else a[:0]
        found += [one, two, three]
        carry = a[-2:]
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.unique(np.concatenate(found), return_counts=True)


def ranked(codes, counts, ranks: int):
    """The `ranks` most frequent codes, most frequent first."""
    import numpy as np

    return codes[np.lexsort((codes, -counts))[:ranks]]


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's digits leaves 2 on division by 4; false for a NULL id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learn(labelled: DataFrame, ranks: int = RANKS, sample_per_language: int = SAMPLE_PER_LANGUAGE) -> dict[str, list[int]]:
    """Profiles from the rows (doc_id, lang, text) of `labelled`."""
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("rows"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    # One row a language, as in the profiles that the driver reads.
    sample = (labelled.select("doc_id", "lang", "text")
              .join(F.broadcast(sizes), "lang").where(share * F.col("rows") < sample_per_language)
              .select("lang", "text").distinct())

    def count(batches):
        from collections import defaultdict

        import numpy as np
        import pyarrow as pa

        letters, totals = letter_table(), defaultdict(lambda: defaultdict(int))
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                codes, counts = gram_counts(text or "", letters)
                total = totals[lang]
                for code, n in zip(codes.tolist(), counts.tolist()):
                    total[code] += n
        for lang, total in totals.items():
            codes, counts = np.array(list(total), dtype=np.int64), np.array(list(total.values()), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes), pa.array(counts)],
                                             ["lang", "code", "n"])

    counts = (sample.mapInArrow(count, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    profiles: dict[str, list[int]] = {}
    for row in counts.withColumn("place", place).where(F.col("place") <= ranks).orderBy("lang", "place").collect():
        profiles.setdefault(row.lang, []).append(row.code)
    return profiles


def predict(docs: DataFrame, profiles: dict[str, list[int]], keep: tuple[str, ...] = ("doc_id",), ranks: int = RANKS) -> DataFrame:
    """`keep` columns plus `lang_pred` and `score`, 1 less the share of the longest distance."""
    rows = docs.select(*keep, F.col("text").alias("__text")) if "text" not in keep else docs.select(*keep)
    names, text_at, kept = sorted(profiles), (keep.index("text") if "text" in keep else len(keep)), len(keep)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        letters = letter_table()
        codes = np.unique(np.concatenate([np.array(p, dtype=np.int64) for p in profiles.values()] or [np.zeros(0, dtype=np.int64)]))
        # Rank of each known n-gram in each profile, -1 where it lacks it.
        table = np.full((len(names), len(codes)), -1, dtype=np.int64)
        for i, name in enumerate(names):
            table[i, np.searchsorted(codes, profiles[name])] = np.arange(len(profiles[name]))

        def judge(text):
            own = ranked(*gram_counts(text or "", letters), ranks)
            if not len(own) or not names:
                return "und", 0.0
            at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
            place = np.where(codes[at] == own, table[:, at], -1)
            distance = np.where(place < 0, ranks, np.abs(place - np.arange(len(own)))).sum(axis=1)
            best = int(distance.argmin())
            return names[best], 1.0 - float(distance[best]) / (ranks * len(own))

        for batch in batches:
            judged = [judge(text.as_py()) for text in batch.column(text_at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], pa.array([x for x, _ in judged], pa.string()), pa.array([x for _, x in judged], pa.float64())],
                [*batch.schema.names[:kept], "lang_pred", "score"])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:kept], T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType())]))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
