"""Quality rules: a decision list learned from labelled text statistics.

`statistics` computes per document, in one native pass, counts of words, word
characters, symbols, capitals, repeated lines and repeated three-word windows.
`learn` joins them with the labels, bins each share at quantiles of the good and
of the bad documents (every 5 % and the tails), and reduces equal bins to one
row.  Sequential covering grows one conjunction of thresholds after another on
one half of the labels: each step is one aggregation that gives, per feature and
bin, the good and bad documents under the rule so far, from which the gain of
every threshold follows; the driver sees that table of bounded size.  A rule is
pruned on the other half and drops what it covers.  The list ends when no rule
that a threshold could still open is precise enough and covers enough; a feature
and direction that opened a refused rule opens no other.  `verdict` turns the
ordered rules into one Spark conditional expression.

Defined results: NULL text has no words, symbols or lines; shares of a text
without words are 0; labels that are NULL, or NULL doc_ids, teach nothing;
a document labelled more than once counts as bad if one label says so; with no
labels, or of one kind only, there are no rules and every document passes;
repeated rows are judged one by one; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..session import cut_lineage
from .common import let, words

FEATURES = ("symbol_share", "capital_share", "mark_share", "dup_line_share", "repeat_share", "word_length")
# Of the good and of the bad documents: the cut points.
QUANTILES = (0.005, 0.01, *(k / 20 for k in range(1, 20)), 0.99, 0.995, 1.0)


def repeated_window_words(w: Column) -> Column:
    """Words covered by three-word windows that occur twice or more in the text.

    Window hashes sorted with their places put equal windows side by side;
    each repeated place then covers up to three words, fewer where the next
    repeated place follows sooner.
    """
    def places(s):
        same = lambda x, k: (F.get(s, k - 1).g == x.g) | (F.get(s, k + 1).g == x.g)
        return F.sort_array(F.transform(F.filter(s, lambda x, k: F.coalesce(same(x, k), F.lit(False))), lambda x: x.i))

    def covered(p):
        return F.aggregate(F.transform(p, lambda v, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - v, F.lit(3)))),
                           F.lit(0), lambda a, b: a + b)

    hashed = F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("g"), i.alias("i")))
    return let(F.sort_array(hashed), lambda s: let(places(s), covered))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts of every document."""
    text = F.coalesce("text", F.lit(""))
    count = lambda keep: F.length(F.regexp_replace(text, F.lit(f"[^{keep}]+"), F.lit(""))).cast("long")
    by_words = let(words(F.col("text")), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        repeated_window_words(w).cast("long").alias("n_repeat_words")))
    by_lines = let(F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return (docs.select("doc_id", by_words.alias("w"), by_lines.alias("l"), count("#*$%&|<>").alias("n_symbols"),
                        count(r"\p{Lu}").alias("n_capitals"), count("!?").alias("n_marks"))
            .select("doc_id", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words",
                    "l.n_lines", "n_capitals", "n_marks"))


def with_features(stats: DataFrame) -> DataFrame:
    share = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b).cast("double")), F.lit(0.0))
    return stats.withColumns({
        "symbol_share": share("n_symbols", "word_chars"),
        "capital_share": share("n_capitals", "word_chars"),
        "mark_share": share("n_marks", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_length": share("word_chars", "n_words"),
    })


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def column(self) -> Column:
        return F.col(self.feature) > self.cut if self.above else F.col(self.feature) <= self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.cut:.6g}"


Choice = tuple[str, bool, int]  # feature, above, which cut


def binned(labelled: DataFrame) -> tuple[dict[str, list[float]], DataFrame]:
    """Cut points per feature, and good and bad counts per half and bins."""
    cuts: dict[str, set] = {f: set() for f in FEATURES}
    for row in labelled.groupBy("bad").agg(*[F.percentile_approx(f, list(QUANTILES), 10000).alias(f) for f in FEATURES]).collect():
        for f in FEATURES:
            cuts[f] |= set(row[f] or [])
    ordered = {f: sorted(c) for f, c in cuts.items()}

    def bin_of(f: str) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, ordered[f])).cast("array<double>"), lambda c: F.col(f) > c)).alias(f)

    bins = [bin_of(f) for f in FEATURES]
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("half")
    return ordered, cut_lineage(labelled.select(half, *bins, "bad").groupBy("half", *FEATURES)
                                .agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")))


def _holds(choice: Choice) -> Column:
    f, above, k = choice
    return F.col(f) > k if above else F.col(f) <= k


def _covered(rule: list[Choice]) -> Column:
    return reduce(lambda a, b: a & b, map(_holds, rule), F.lit(True))


def _by_bin(rows: DataFrame) -> dict[str, dict[int, tuple[int, int]]]:
    """Bad and good documents per feature and bin."""
    pairs = F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("bin")) for f in FEATURES])
    counts: dict = {f: {} for f in FEATURES}
    for r in rows.select(F.explode(pairs).alias("x"), "bad", "good").groupBy("x.f", "x.bin").agg(
            F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect():
        counts[r.f][r.bin] = (r.bad, r.good)
    return counts


def _best(counts, choices: list[Choice]) -> tuple[float, Choice | None]:
    """The choice of the highest gain in bits, the first of equals."""
    import math

    p0, n0 = (sum(x[i] for x in counts[FEATURES[0]].values()) for i in range(2))
    best: tuple[float, Choice | None] = (0.0, None)
    for f, above, k in choices:
        inside = [x for b, x in counts[f].items() if (b > k) == above]
        p, n = sum(x[0] for x in inside), sum(x[1] for x in inside)
        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p else 0.0
        if gain > best[0] + 1e-9:
            best = gain, (f, above, k)
    return best


def learn(features: DataFrame, labels: DataFrame, least_precision: float = 0.9, least_cover: int = 5) -> list[tuple[Condition, ...]]:
    """Rules for bad documents, in the order in which they were learned."""
    marked = (labels.where("doc_id is not null and quality is not null")
              .groupBy("doc_id").agg(F.max((F.col("quality") == 0).cast("int")).alias("bad")))
    cuts, table = binned(features.join(marked, "doc_id").select("doc_id", "bad", *FEATURES))
    choices = [(f, above, k) for f in FEATURES for k in range(len(cuts[f])) for above in (True, False)]
    openings, rules, left = list(choices), [], table
    opening_counts = _by_bin(left.where("half = 0"))
    while openings:
        rule: list[Choice] = []
        counts = opening_counts
        while sum(x[0] for x in counts[FEATURES[0]].values()) and sum(x[1] for x in counts[FEATURES[0]].values()):
            _, choice = _best(counts, choices if rule else openings)
            if choice is None:
                break
            rule.append(choice)
            counts = _by_bin(left.where((F.col("half") == 0) & _covered(rule)))
        if not rule:
            break
        sums = [F.sum(F.when(_covered(rule[:k]), F.col(c)).otherwise(0)).alias(f"{c}{k}") for k in range(1, len(rule) + 1) for c in ("bad", "good")]
        held = left.where("half = 1").agg(*sums).first()
        of = lambda k: (held[f"bad{k}"] or 0, held[f"good{k}"] or 0)
        value = lambda k: (lambda p, n: (p - n) / (p + n) if p + n else -1.0)(*of(k))
        length = max(range(1, len(rule) + 1), key=value)  # the shortest of the best prefixes
        p, n = of(length)
        if p < least_cover or p < least_precision * (p + n):
            openings = [c for c in openings if c[:2] != rule[0][:2]]
            continue
        rules.append(rule[:length])
        left = left.where(~_covered(rule[:length]))
        opening_counts = _by_bin(left.where("half = 0"))
    return [tuple(Condition(f, above, cuts[f][k]) for f, above, k in rule) for rule in rules]


def verdict(rules: list[tuple[Condition, ...]]) -> tuple[Column, Column]:
    """(kept, rule): false for the first rule that holds, and its number and text."""
    kept, name = F.lit(True), F.lit(None).cast("string")
    for n, rule in reversed(list(enumerate(rules, 1))):
        holds = reduce(lambda a, b: a & b, [c.column() for c in rule])
        kept = F.when(holds, F.lit(False)).otherwise(kept)
        name = F.when(holds, F.lit(f"{n}: " + " and ".join(map(str, rule)))).otherwise(name)
    return kept, name


def judge(features: DataFrame, rules: list[tuple[Condition, ...]]) -> DataFrame:
    kept, name = verdict(rules)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return features.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                           failed.alias("base_failed"), (~failed & kept).alias("kept"), name.alias("rule"))
