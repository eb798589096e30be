"""Collocations by the layout of external language-model estimation.

Counts of words and phrases are kept as sorted streams: once in prefix order
(by first word, then second, ...) and once in suffix order (by last word, then
the one before, ...).  In prefix order a phrase stands behind its own first
words, so one pass over the stream in lockstep with itself meets every left
part's count before the phrases it begins; in suffix order the same pass meets
the right parts.  No hash table of phrases is built and no join is made.

1. Counting.  Each task counts the runs of `max_words` words (shorter at the
   end of a piece) of its documents and sends them, sorted, to ranges of the
   prefix order.  Only these longest runs are shuffled: in a sorted range the
   count of a shorter phrase is the sum over the run of entries it begins.
   What such a run has on either side of a range's border is added up.
   Phrases below `min_count` end here; a frequent phrase's parts are frequent.
2. Suffix order, then prefix order.  Each is a range partitioning, a sort and
   two passes: the first learns from every partition what crosses its borders
   (a few rows a partition reach the driver), the second gives each phrase the
   counts of its parts and the largest count among the phrases one word longer.
   So a word with which a third of all phrases begin is dealt over partitions
   like any other part of the order, and a pass holds one entry per word of
   the phrase at hand.

The borders of the ranges are quantiles of the runs in about SAMPLE_BYTES of
text; they decide where a row is counted, not what is counted.

Defined results: NULL text is empty; NULL lang is `und`; doc_id isn't used, so
equal rows count once each; an empty table, or one without a phrase that is
frequent enough, gives no rows; other columns are ignored.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

PIECE_ENDS = b".,;:!?\n\x0b\x0c\r"
END = b"\xff"           # stands for the end of a piece; no byte of UTF-8
HELD = 800_000          # words that a task holds
PART_BYTES = 16 << 20  # of text, for a range
MOST_PARTS = 20_000
SAMPLE_BYTES = 8 << 20
KEYS_PER_PART = 32
ROWS = 10_000          # of a record batch
UNKNOWN = "und"
HEAD_BYTES = 7         # of a run, for comparisons
RUNS = "part int, head long, lang string, gram binary, n long"


def words_of(text: str) -> list[bytes]:
    """The words of a text in order, as lower-cased bytes, with END behind each piece."""
    ends = bytes(0xFF if c in PIECE_ENDS else c for c in range(256))
    raw = text.encode().lower().translate(ends)  # bytes.lower touches A-Z only
    return (raw.replace(END, b" \xff ") + b" \xff").split()  # of white space, blanks and tabs are left


def _rows(batch):
    """(lang, text) one after the other: a batch may hold many long texts."""
    for lang, text in zip(*batch.columns):
        yield lang.as_py(), text.as_py()


class _Held:
    """Words of several texts, numbered, and their longest runs."""

    def __init__(self):
        self.number, self.places, self.size = {END: 0}, {}, 0

    def add(self, lang: str, words: list[bytes]) -> None:
        number = self.number
        self.places.setdefault(lang, []).append([number.setdefault(w, len(number)) for w in words])
        self.size += len(words)

    def runs(self, most: int):
        """(lang, runs as bytes in order, how often) of each language.

        A run has a space behind each word, so that in byte order the runs that
        begin alike stand together; numbers in the order of the words with
        their space give the same order."""
        from itertools import chain

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        spelt = sorted((w + b" ", i) for w, i in self.number.items() if i)
        rank = np.zeros(len(spelt) + 1, dtype=np.int64)
        rank[[i for _, i in spelt]] = np.arange(1, len(spelt) + 1)
        table = pa.array([b"", *(w for w, _ in spelt)], pa.binary())
        for lang in sorted(self.places):
            at = rank[np.fromiter(chain.from_iterable(self.places[lang]), dtype=np.int64)]
            columns = [at]
            for k in range(1, most):  # behind the end of a piece a run has no words
                following = np.concatenate([at[k:], np.zeros(min(k, len(at)), dtype=np.int64)])
                columns.append(np.where(columns[-1] > 0, following, 0))
            columns = [c[at > 0] for c in columns]
            if len(rank) ** most < 1 << 63:  # a run as one number
                key = columns[0]
                for c in columns[1:]:
                    key = key * len(rank) + c
                key, n = np.unique(key, return_counts=True)
                columns = [key // len(rank) ** (most - 1 - k) % len(rank) for k in range(most)]
            else:
                columns, n = np.unique(np.stack(columns), axis=1, return_counts=True)
            yield lang, pc.binary_join_element_wise(*(table.take(pa.array(c)) for c in columns), pa.scalar(b"", pa.binary())), n


class _Listed:
    """An Arrow array as a sequence that `bisect` can search."""

    def __init__(self, array):
        self.array = array

    def __len__(self):
        return len(self.array)

    def __getitem__(self, i):
        return self.array[i].as_py()


def _head(borders: list[tuple[str, bytes]], part: int, lang: str) -> tuple[int, int]:
    """(group, bytes to leave out) of a language's runs in a range, for `_heads`.

    The groups of a range are in the order of languages: that of its lower
    border, those between, that of its upper one.  What both borders begin
    with, all runs between them do."""
    low = borders[part - 1] if part else (None, b"")
    high = borders[part] if part < len(borders) else (None, b"")
    if lang != low[0]:
        return (2 if lang == high[0] else 1), 0
    if lang != high[0]:
        return 0, 0
    alike = 0
    while alike < min(len(low[1]), len(high[1])) and low[1][alike] == high[1][alike]:
        alike += 1
    return 0, alike


def _heads(keys, group, left_out):
    """Numbers in the order of (lang, run) within a range, alike for some runs that
    differ: the sort compares few runs whole.  Group 1 may hold several languages."""
    import numpy as np

    if not len(keys):
        return np.zeros(0, dtype=np.int64)
    offsets = np.frombuffer(keys.buffers()[1], dtype=np.int32)[keys.offset:keys.offset + len(keys) + 1].astype(np.int64)
    letters = np.frombuffer(keys.buffers()[2], dtype=np.uint8)
    head, at, end = group.astype(np.int64), offsets[:-1] + left_out, offsets[1:]
    for k in range(HEAD_BYTES):
        inside = at + k < end
        head = (head << 8) | np.where(inside, letters[np.where(inside, at + k, 0)], 0)
    return np.where(group == 1, np.int64(1) << (8 * HEAD_BYTES), head)


def _borders(rows: DataFrame, parts: int, total: int, max_words: int) -> list[tuple[str, bytes]]:
    """About equal ranges of (lang, run), from the runs of a share of the texts."""
    if parts < 2:
        return []
    share = min(1.0, SAMPLE_BYTES / max(1, total))
    step = max(1, int(share * total / 6 / (parts * KEYS_PER_PART)))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            held = _Held()
            for lang, text in _rows(batch):
                held.add(lang, words_of(text))
            for lang, keys, n in held.runs(max_words):
                upto = np.cumsum(n)
                some = keys.take(pa.array(np.searchsorted(upto, np.arange(step // 2, upto[-1] if len(upto) else 0, step), side="right")))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), some], ["lang", "gram"])

    sample = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20))) if share < 1 else rows
    keys = sorted((r.lang, bytes(r.gram)) for r in sample.mapInArrow(run, "lang string, gram binary").collect())
    return sorted({keys[len(keys) * k // parts] for k in range(1, parts)}) if keys else []


def _counted_runs(rows: DataFrame, borders: list[tuple[str, bytes]], max_words: int) -> DataFrame:
    """part, head, lang, gram (bytes of a longest run), n: the runs of each task, in order within a batch."""
    bounds = rows.sparkSession.sparkContext.broadcast(borders)

    def run(batches):
        from bisect import bisect_left

        import numpy as np
        import pyarrow as pa

        def flush(held):
            for lang, keys, n in held.runs(max_words):
                listed, before = _Listed(keys), bisect_left(bounds.value, (lang, b""))
                inside = [key for of, key in bounds.value[before:] if of == lang]
                part = before + np.searchsorted([bisect_left(listed, key) for key in inside], np.arange(len(keys)), side="right")
                head = np.array([_head(bounds.value, p, lang) for p in range(before, before + len(inside) + 1)], dtype=np.int64)[part - before]
                table = pa.table([pa.array(part, pa.int32()), pa.array(_heads(keys, head[:, 0], head[:, 1])),
                                  pa.array([lang], pa.string()).take(pa.array(np.zeros(len(keys), dtype=np.int64))),
                                  keys, pa.array(n, pa.int64())], ["part", "head", "lang", "gram", "n"])
                yield from table.to_batches(ROWS)

        held = _Held()
        for batch in batches:
            for lang, text in _rows(batch):
                held.add(lang, words_of(text))
                if held.size > HELD:
                    yield from flush(held)
                    held = _Held()
        yield from flush(held)

    return rows.mapInArrow(run, RUNS)


def _phrase_counts(sorted_runs: DataFrame, min_count: int, max_words: int) -> DataFrame:
    """lang, gram, words, n and `border`: the counts of all phrases of a range.

    `words` 0 is the number of words of a language.  A phrase at either end of
    a range may go on in the next and is marked; others stay if frequent.  Of
    each length one phrase is open at a time."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        types = [pa.string(), pa.binary(), pa.int32(), pa.int64(), pa.bool_()]
        names, out, totals = ["lang", "gram", "words", "n", "border"], [], {}
        open_: list = [None] * (max_words + 1)  # by length: [(lang, words), n, at the range's first entry]
        first = True

        def close(k: int, last: bool):
            if open_[k] is not None:
                (lang, words), n, at_first = open_[k]
                if at_first or last or n >= min_count:
                    out.append((lang, b" ".join(words), k, n, at_first or last))
            open_[k] = None

        for batch in batches:
            if not batch.num_rows:
                continue
            lang, n = batch.column(0), batch.column(2).to_numpy(zero_copy_only=False)
            split = pc.split_pattern(batch.column(1), b" ")
            size = pc.list_value_length(split).to_numpy(zero_copy_only=False) - 1
            offset, flat = split.offsets.to_numpy()[:-1], split.values
            change = np.zeros(len(n), dtype=bool)
            change[1:] = pc.not_equal(lang[1:], lang[:-1]).to_numpy(zero_copy_only=False)
            at_start = np.flatnonzero(np.concatenate(([True], change[1:])))
            for i, total in zip(at_start.tolist(), np.add.reduceat(n, at_start).tolist()):
                of = lang[i].as_py()
                totals[of] = totals.get(of, 0) + total
            for k in range(1, max_words + 1):
                # A run without a k-th word has the empty word behind its last one there.
                word = flat.take(pa.array(offset + np.minimum(k - 1, size)))
                change[1:] |= pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
                start = np.flatnonzero(np.concatenate(([True], change[1:])))
                total = np.add.reduceat(n, start)
                there = size[start] >= k

                def phrase(i):
                    return lang[i].as_py(), [flat[int(offset[i]) + j].as_py() for j in range(k)]

                begins = phrase(0) if there[0] else None
                if open_[k] is not None and open_[k][0] == begins:
                    open_[k][1] += int(total[0])
                else:
                    close(k, False)
                    open_[k] = [begins, int(total[0]), first] if there[0] else None
                if len(start) > 1:
                    close(k, False)
                    for s in (np.flatnonzero((total[1:-1] >= min_count) & there[1:-1]) + 1).tolist():
                        of, words = phrase(int(start[s]))
                        out.append((of, b" ".join(words), k, int(total[s]), False))
                    open_[k] = [phrase(int(start[-1])), int(total[-1]), False] if there[-1] else None
            first = False
            if len(out) >= ROWS:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)
                out = []
        for k in range(1, max_words + 1):
            close(k, True)
        out += [(of, b"", 0, n, True) for of, n in totals.items()]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return sorted_runs.mapInArrow(run, "lang string, gram binary, words int, n long, border boolean")


def frequent_phrases(docs: DataFrame, max_words: int, min_count: int, part_bytes: int = PART_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, gram, n) of all phrases of 1 to max_words words counted min_count times
    or more, and (lang, n), the number of words."""
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = int(max(1, min(MOST_PARTS, -(-total // part_bytes))))
    borders = _borders(rows, parts, total, max_words)
    runs = _counted_runs(rows, borders, max_words)
    ranged = (runs.repartitionById(len(borders) + 1, F.col("part")).sortWithinPartitions("head", "lang", "gram")
              .select("lang", "gram", "n"))
    found = cut_lineage(_phrase_counts(ranged, min_count, max_words).select("lang", F.col("gram").cast("string").alias("gram"), "words", "n", "border"))
    # What crosses borders, a few rows a range, is added up by phrase.
    crossing = found.where("border").groupBy("lang", "gram", "words").agg(F.sum("n").alias("n"))
    counts = (found.where("not border").select("lang", "gram", "n")
              .union(crossing.where((F.col("words") > 0) & (F.col("n") >= min_count)).select("lang", "gram", "n")))
    return counts, crossing.where("words = 0").select("lang", "n")


def _in_order(rows: DataFrame, key: Column) -> DataFrame:
    """`rows` in the order of (lang, key), as partitions of ranges that stay as they are."""
    return cut_lineage(rows.withColumn("key", key).repartitionByRange("lang", "key").sortWithinPartitions("lang", "key"))


class _Open:
    """The phrases that the entry at hand begins with."""

    __slots__ = ("words", "n", "extension", "row")

    def __init__(self, words, n, row=None):
        self.words, self.n, self.extension, self.row = words, n, 0, row


def _lockstep(rows: DataFrame, parts: str, extension: str) -> DataFrame:
    """`rows` (lang, key, n, ...) in order, with `parts`, the counts of the
    phrases of 1, 2, ... words that an entry's key begins with, and `extension`,
    the largest count of an entry that is one word longer and begins with it."""
    columns = rows.columns
    lang_at, key_at, n_at = (columns.index(c) for c in ("lang", "key", "n"))

    def entries(batches):
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                yield row, (row[lang_at], *row[key_at].split(" ")[:-1]), row[n_at]

    def crossing(batches):
        """One row a partition: its first phrase's words, the largest counts of what its
        beginnings (that stand before the partition) are extended to, and the open phrases at its end."""
        import pyarrow as pa
        from pyspark import TaskContext

        first, larger, open_ = None, {}, []
        for _, words, n in entries(batches):
            if first is None:
                first = words
            while open_ and open_[-1].words != words[:len(open_[-1].words)]:
                open_.pop()
            if words[:-1] == first[:len(words) - 1] and len(words) > 2:
                larger[len(words) - 1] = max(n, larger.get(len(words) - 1, 0))
            open_.append(_Open(words, n))
        if first is not None:
            yield pa.RecordBatch.from_arrays([
                pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([list(first)], pa.list_(pa.string())),
                pa.array([list(larger)], pa.list_(pa.int32())), pa.array([list(larger.values())], pa.list_(pa.int64())),
                pa.array([list(open_[-1].words)], pa.list_(pa.string())), pa.array([[len(o.words) for o in open_]], pa.list_(pa.int32())),
                pa.array([[o.n for o in open_]], pa.list_(pa.int64()))],
                ["part", "first", "longer", "largest", "last", "open", "n"])

    border_rows = sorted(rows.mapInArrow(crossing, "part int, first array<string>, longer array<int>, largest array<long>, "
                                                   "last array<string>, open array<int>, n array<long>").collect())
    before, at_end = {}, []  # partition -> the open phrases before it
    for r in border_rows:
        first = tuple(r.first)
        before[r.part] = [(w, n) for w, n in at_end if w == first[:len(w)] and len(w) < len(first)]
        own = [(tuple(r["last"][:k]), n) for k, n in zip(r.open, r.n)]
        lengths = {len(w) for w, _ in own}
        kept = [(w, n) for w, n in before[r.part] if w == tuple(r["last"][:len(w)]) and len(w) not in lengths]
        at_end = sorted(kept + own, key=lambda x: len(x[0]))
    after = {}  # phrase -> largest extension in later partitions than its own
    for r in border_rows:
        known = {len(w) for w, _ in before[r.part]}
        for k, n in zip(r.longer, r.largest):
            if k in known:
                phrase = tuple(r.first[:k])
                after[phrase] = max(n, after.get(phrase, 0))
    borders = rows.sparkSession.sparkContext.broadcast((before, after))

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        before, after = borders.value
        open_ = [_Open(words, n) for words, n in before.get(TaskContext.get().partitionId(), [])]
        out, schema = [], None

        def close(o):
            if o.row is not None:
                row, counts = o.row
                out.append((*row, counts, max(o.extension, after.get(o.words, 0))))

        def batch_of(done):
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)

        def remembered(batches):
            nonlocal schema
            for batch in batches:
                schema = pa.schema([*batch.schema, pa.field(parts, pa.list_(pa.int64())), pa.field(extension, pa.int64())])
                yield batch

        for row, words, n in entries(remembered(batches)):
            while open_ and open_[-1].words != words[:len(open_[-1].words)]:
                close(open_.pop())
            if open_ and len(open_[-1].words) == len(words) - 1:
                open_[-1].extension = max(open_[-1].extension, n)
            open_.append(_Open(words, n, (row, [o.n for o in open_])))
            if len(out) >= ROWS:
                yield batch_of(out)
                out = []
        while open_:
            close(open_.pop())
        if out:
            yield batch_of(out)

    return rows.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields),
                                           f"{parts} array<bigint>", f"{extension} bigint"]))


def collocations(docs: DataFrame, max_words: int = 3, min_count: int = 10, contained_percent: int = 50, top: int = 2000,
                 part_bytes: int = PART_BYTES) -> DataFrame:
    """The best phrases of 2 to `max_words` words of each language: lang, rank,
    phrase, a, l, r, n, score.

    A phrase counted a times, cut into parts counted l and r, scores
    floor(1000000 a a / (l r)) at its lowest-scoring cut.  A phrase inside one
    that is longer and counted `contained_percent` of its times or more is left
    out (looking one word further is enough: whatever lies between is counted
    at least as often as the longer one)."""
    counts, sizes = frequent_phrases(docs, max_words, min_count, part_bytes)
    backwards = F.concat(F.array_join(F.reverse(F.split("gram", " ")), " "), F.lit(" "))
    right = _lockstep(_in_order(counts, backwards), "ends", "before").drop("key")
    both = _lockstep(_in_order(right, F.concat("gram", F.lit(" "))), "begins", "behind").drop("key")
    length = F.size("begins") + 1
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = both.where(F.size("begins") > 0).withColumns({
        "cut": F.explode(F.sequence(F.lit(1), length - 1)), "a": F.col("n"), "words": length})
    cuts = cuts.withColumns({"l": F.element_at("begins", F.col("cut")), "r": F.element_at("ends", F.col("words") - F.col("cut"))})
    cuts = cuts.withColumns({"aa": (F.lit(1000000).cast("decimal(7,0)") * wide("a")).cast("decimal(38,0)"), "lr": (wide("l") * wide("r")).cast("decimal(38,0)")})
    scored = (cuts.where((100 * F.greatest("before", "behind")) < contained_percent * F.col("a"))
              .withColumn("score", F.expr("cast(cast(aa * cast(a as decimal(20,0)) as decimal(38,0)) div lr as bigint)"))
              .groupBy("lang", "gram", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("low")))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = (scored.select("lang", F.col("gram").alias("phrase"), "a", "low.l", "low.r", "low.score")
            .withColumn("rank", place.cast("long")).where(F.col("rank") <= top))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


cloudpickle.register_pickle_by_value(sys.modules[__name__])
