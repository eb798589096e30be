"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document has a size in words and a quality weight w.  Its key is
-ln(u) / w with u hashed from its doc_id and size: the exponential form of the
Efraimidis-Spirakis key, so documents in the order of their keys are a
weighted sample without replacement.  A source with target T and size S is
taken floor(T / S) times as a whole; the rest, T - S * floor(T / S), is filled
with its documents in the order of their keys until the prefix sum of sizes
comes nearest to it.

The order is settled without sorting a source, since one may hold most rows: a
source is cut into about sqrt(rows) buckets by 1 - exp(-key), which keeps the
order; bucket sums show the bucket in which the budget ends, and only the rows
of that bucket are sorted and prefix-summed.  The result is a few values per
source, and every row decides by its own key.  One pass over the texts; all
that is shuffled is narrow.

Targets: sources in code point order (NULL last) have the given weights in
turn and share all words; a target stops at `most` times its source's size
and the excess goes to the others by weight until none is above.  That end
state is direct: with sources in the order of cap / weight, a source is capped
exactly when its cap is at most its weight's share of what the capped ones
before it leave.

Defined results: NULL text has size 0 and is taken 0 words; NULL doc_id and
NULL source are values of their own; equal keys go by doc_id, then by size;
rows of equal key, doc_id, source and size are one unit, and of the unit on
which a budget ends as many rows are taken as come nearest to it (which ones
is open); a source without words has target 0; an empty table gives an empty table; other columns
pass through `apply` untouched and are ignored elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage
from .common import let, words

LEAST_WEIGHT = 0.05
MOST_BROADCAST = 100_000  # sources, of some 100 bytes each
SALT = "mix"


def quality_weight(word_array: Column) -> Column:
    """Share of different words, on the logarithmic scale that takes the
    length out: ln(1 + different) / ln(1 + all), at least LEAST_WEIGHT."""
    return let(word_array, lambda w: F.greatest(
        F.lit(LEAST_WEIGHT),
        F.coalesce(F.log(1 + F.size(F.array_distinct(w)).cast("double")) / F.nullif(F.log(1 + F.size(w).cast("double")), F.lit(0.0)),
                   F.lit(LEAST_WEIGHT))))


def unit_hash(*cols) -> Column:
    """A number in (0, 1) from the MD5 of the columns."""
    joined = F.concat_ws("/", F.lit(SALT), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.md5(joined), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def sized(docs: DataFrame, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, key and the named columns, in one pass over the texts."""
    text = words(F.col("text"))
    stats = let(text, lambda w: F.struct(F.size(w).cast("long").alias("size"), quality_weight(w).alias("weight")))
    rows = docs.select("doc_id", "source", *extra, stats.alias("stats"))
    return (rows.select("doc_id", "source", *extra, "stats.size", "stats.weight")
            .withColumn("key", -F.log(unit_hash("doc_id", "size")) / F.col("weight")).drop("weight"))


def source_targets(sources: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """From source, source_size, n_rows: target, whole epochs and the rest to fill.

    One row per source goes through an unpartitioned window; sources are
    names, counted in thousands at most, never rows.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights)))
    given = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("long"))
    given = given.withColumn("cap", F.lit(most).cast("long") * F.col("source_size"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    given = (given
             .withColumn("total", F.sum("source_size").over(every))
             .withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             .withColumn("weight_left", F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
             .withColumn("capped", F.col("cap") * F.col("weight_left") <= F.col("left") * F.col("weight")))
    # The first source that isn't capped sets the share of all after it.
    first = lambda c: F.first(F.when(~F.col("capped"), F.col(c)), ignorenulls=True).over(every)
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.col("weight") * (first("left").cast("double") / first("weight_left").cast("double")))
    return (given.withColumn("target", target)
            .withColumn("epochs", F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0)))
            .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
            .select("source", "source_size", "n_rows", "target", "epochs", "rest"))


def cutoffs(rows: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per source its targets and where its sample ends: all of the buckets
    before `edge`, and in that bucket the units up to `last` (none if NULL),
    of which the unit `last` itself gives `quota` of its `members` rows."""
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    targets = cut_lineage(source_targets(sources, weights, most)).withColumnRenamed("source", "t_source")
    bucketed = with_bucket(rows, targets)
    sums = bucketed.groupBy("t_source", "bucket", "rest").agg(F.sum("size").alias("n"))
    upto = Window.partitionBy("t_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    edges = (sums.withColumn("end", F.sum("n").over(upto))
             .where("end >= rest").groupBy("t_source")
             .agg(F.min_by(F.struct("bucket", (F.col("end") - F.col("n")).alias("offset")), "bucket").alias("e"))
             .select(F.col("t_source").alias("e_source"), F.col("e.bucket").alias("edge"), "e.offset"))
    units = (bucketed.join(edges, F.col("t_source").eqNullSafe(F.col("e_source")) & (F.col("bucket") == F.col("edge")))
             .groupBy("t_source", "offset", "rest", order_key().alias("at"))
             .agg(F.sum("size").alias("n"), F.count(F.lit(1)).alias("members")))
    before = Window.partitionBy("t_source").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("offset") + F.coalesce(F.sum("n").over(before), F.lit(0))
    # A row on the edge is in when that leaves the sum nearer to the rest: the
    # i-th of a unit, from 0, if start + (i + 1/2) * size is below it.
    quota = F.least("members", F.ceil((F.col("rest") - F.col("start")) / F.nullif(F.col("at.size"), F.lit(0)) - 0.5))
    last = (units.withColumn("start", start).where("start + at.size / 2.0D < rest")
            .withColumn("quota", F.greatest(F.lit(1), quota))
            .groupBy("t_source").agg(F.max_by(F.struct("at", "quota", "members"), "at").alias("l"))
            .select(F.col("t_source").alias("l_source"), F.col("l.at").alias("last"), "l.quota", "l.members"))
    return cut_lineage(
        targets.join(edges, F.col("t_source").eqNullSafe(F.col("e_source")), "left")
        .join(last, F.col("t_source").eqNullSafe(F.col("l_source")), "left")
        .select("t_source", "source_size", "n_rows", "target", "epochs", "rest", "edge", "last", "quota", "members"))


def order_key() -> Column:
    return F.struct("key", "doc_id", "size")


def with_bucket(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """`targets` has a row per source and is read from a checkpoint, so that
    counting it is cheap: up to MOST_BROADCAST rows it is broadcast, and rows
    that may carry whole texts aren't shuffled by a hot source."""
    n = F.ceil(F.sqrt("n_rows"))
    small = targets.count() <= MOST_BROADCAST
    return (rows.join(F.broadcast(targets) if small else targets, F.col("source").eqNullSafe(F.col("t_source")))
            .withColumn("bucket", F.least(n - 1, F.floor((1 - F.exp(-F.col("key"))) * n))))


def with_copies(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """`rows` with source_size, target and `copies`, the times the mix takes each."""
    at_edge = F.col("bucket") == F.col("edge")
    chosen = F.coalesce((F.col("bucket") < F.col("edge")) | (at_edge & (order_key() <= F.col("last"))), F.lit(False))
    with_ends = with_bucket(rows, ends)
    copied = lambda df, c: df.withColumn("copies", F.col("epochs") + c.cast("long"))
    if ends.where("quota < members").isEmpty():
        return copied(with_ends, chosen)
    split = F.coalesce(at_edge & (order_key() == F.col("last")) & (F.col("quota") < F.col("members")), F.lit(False))
    return copied(with_ends.where(~split), chosen).unionByName(
        copied(ranked(with_ends.where(split)), F.col("rank") < F.col("quota")).drop("rank"))


def ranked(members: DataFrame) -> DataFrame:
    """The rows of each source's split unit with `rank`; those below `quota` are taken.

    The rows go by a hash of their text, so that every run takes the same
    texts.  The text at which the quota ends is found on counts per hash, in
    about sqrt(members) ranges of it; only rows with that very text, which can't
    be told apart, are kept once, numbered, and ranked by slices of the number."""
    slices = F.ceil(F.sqrt("members")).cast("long")
    tie = F.xxhash64(F.coalesce("__row.text", F.lit(""))) if "__row" in members.columns else F.lit(0).cast("long")
    rows = members.withColumn("tie", tie)
    span = F.least(slices - 1, F.floor((F.col("tie") / float(1 << 64) + 0.5) * slices))
    ties = (rows.groupBy("t_source", "quota", span.alias("span"), "tie").agg(F.count(F.lit(1)).alias("n")))
    earlier = Window.partitionBy("c_source").orderBy("c_span").rowsBetween(Window.unboundedPreceding, -1)
    spans = (ties.groupBy(F.col("t_source").alias("c_source"), F.col("span").alias("c_span")).agg(F.sum("n").alias("n"))
             .select("c_source", "c_span", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")))
    inner = Window.partitionBy("t_source", "span").orderBy("tie").rowsBetween(Window.unboundedPreceding, -1)
    ends = cut_lineage(  # one row a source
        ties.join(spans, F.col("t_source").eqNullSafe(F.col("c_source")) & (F.col("span") == F.col("c_span")))
        .withColumn("start", F.col("offset") + F.coalesce(F.sum("n").over(inner), F.lit(0)))
        .where("start < quota and start + n >= quota")
        .select(F.col("t_source").alias("b_source"), F.col("tie").alias("b_tie"), F.col("start").alias("b_start"), F.col("n").alias("b_n")))
    small = ends.count() <= MOST_BROADCAST
    judged = rows.join(F.broadcast(ends) if small else ends, F.col("t_source").eqNullSafe(F.col("b_source")))
    clear = judged.where("tie <> b_tie").withColumn("rank", F.when(F.col("tie") < F.col("b_tie"), F.lit(0)).otherwise(F.col("members")).cast("long"))
    equal = cut_lineage(judged.where("tie = b_tie").withColumn("row", F.monotonically_increasing_id())
                        .withColumn("slice", F.pmod(F.xxhash64("row"), F.ceil(F.sqrt("b_n")).cast("long"))))
    cells = (equal.groupBy(F.col("t_source").alias("c_source"), F.col("slice").alias("c_slice")).agg(F.count(F.lit(1)).alias("n"))
             .select("c_source", "c_slice", F.coalesce(F.sum("n").over(
                 Window.partitionBy("c_source").orderBy("c_slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset")))
    within = Window.partitionBy("t_source", "slice").orderBy("row")
    placed = (equal.withColumn("within", F.row_number().over(within) - 1)
              .join(cells, F.col("t_source").eqNullSafe(F.col("c_source")) & (F.col("slice") == F.col("c_slice")))
              .withColumn("rank", (F.col("b_start") + F.col("offset") + F.col("within")).cast("long")))
    names = [*members.columns, "rank"]
    return clear.select(*names).unionByName(placed.select(*names))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """Per row: doc_id, source, size, source_size, target, copies and taken words."""
    rows = cut_lineage(sized(docs))
    return with_copies(rows, cutoffs(rows, weights, most)).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"))


def apply(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = 3) -> DataFrame:
    """The mixed corpus: every row of `docs` as often as the mix takes it.

    Whether a row is in depends on its own key and its source's end, so the
    texts are read twice and never shuffled; only the rows of a unit that is
    taken in part are read once more and dealt out.
    """
    rows = cut_lineage(sized(docs))
    whole = F.struct(*[docs[c] for c in docs.columns])
    taken = with_copies(sized(docs.withColumn("__row", whole), ("__row",)), cutoffs(rows, weights, most))
    return (taken.where("copies > 0").withColumn("i", F.explode(F.expr("sequence(1L, copies)")))
            .select("__row.*"))
