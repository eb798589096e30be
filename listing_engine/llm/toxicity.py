"""Toxicity by a subsequence string kernel and a support vector machine.

The kernel compares two units (words, and runs of single letters such as
`i d i o t`) by the subsequences of three letters they share, each weighted by
DECAY for every place it spans; a character that isn't a letter widens the
span and matches nothing.  So `id*i.ot` and `idixot` stay close to `idiot`.
Spans are at most SPAN places.  A sentence is the sum of its different units, scaled to
length 1 each and taken to the power POWER.  As the kernel is a scalar product
of weighted subsequences, its value against a fixed set of landmarks comes from
one table from subsequence to landmarks.

1. Landmarks (Nystroem): units of the training documents, half of them with the
   letters that most tell toxic documents apart, half the most frequent ones,
   none too like another.
2. Training sentences.  A label marks a document, not the sentence it is for.
   Each training document gives its most suspicious sentence, first by its
   likeness to the landmarks of toxic documents, then by the machine of the
   round before; toxic ones give it a second time with a letter inserted.  The machine is linear in the Nystroem features of these
   sentences (squared hinge loss, classes weighing the same).
3. Scores.  A document's margin is that of its highest sentence.  A logistic
   curve over the training documents' margins turns it into the score.

The sample is bounded: about `sample_per_label` documents of each label, by a
hash of doc_id.  The driver sees landmarks and one feature vector a document of it;
units are counted and sentences chosen on executors.  Scoring is one scan
without a shuffle: a unit's margin is one number, so a task remembers units'
margins and adds them up; every text is judged whole.

Defined results: NULL and empty texts score what a sentence without units
does; repeated rows are scored one by one; labels of unknown or NULL doc_id
are not learnt from; several labels of one doc_id count as toxic if one is;
without labels of both kinds every score is 0; an empty table gives an empty
table; other columns are passed on only if named in `keep`.
"""

from __future__ import annotations

import math
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..session import cut_lineage
from .language import held_out, letter_table
from .shingles import mixed

DECAY, SPAN = 0.85, 6
UNIT_BITS = 11         # 2^11 units are compared at a time
POWER = 2
PER_GRAM = 3           # landmarks for one such run
LANDMARKS = 64
MARKS = ".,;:!?()[]\"'"  # at a unit's ends
START = 1              # stands before a unit's first character, as a letter
GRAM = 4               # letters of the runs that tell toxic documents apart
CANDIDATES = 600       # units of each kind among which the landmarks are chosen
LIKE = 0.6            # landmarks are less like each other
LEAST_ODDS = 2         # of a toxic document, for a landmark of that kind
MIN_DOCUMENTS = 3      # a landmark stands in so many training documents
SAMPLE_PER_LABEL = 4000
ROUNDS = 2
SENTENCE_UNITS = 40    # longer sentences are cut
UNIT_CHARS, UNIT_STEP = 32, 16  # longer units are cut into overlapping windows
REMEMBERED = 700_000
THRESHOLD = 0.3


# --- units

def sentences_of(text: str):
    """The different units of each sentence of a text, in lower case, without marks at their ends."""
    import re

    text = text.lower()
    # Letters set apart by white space are a unit together.
    spaced = re.search(r"(?<!\S)\S\s+\S(?!\S)", text)
    for sentence in re.split(r"(?<=[.!?])\s+|\n+", text):
        units = [u.strip(MARKS) for u in sentence.split()]
        if not units:
            continue
        if spaced:
            units += [" ".join(run[0].split()) for run in re.finditer(r"(?<!\S)\S(?:\s+\S)+(?!\S)", sentence)]
        if max(map(len, units)) > UNIT_CHARS:
            units = [w for u in units for w in windows_of(u)]
        for low in range(0, len(units), SENTENCE_UNITS):
            yield list(dict.fromkeys(units[low:low + SENTENCE_UNITS]))


def windows_of(unit: str) -> list[str]:
    if len(unit) <= UNIT_CHARS:
        return [unit]
    return [unit[low:low + UNIT_CHARS] for low in range(0, len(unit) - UNIT_CHARS + UNIT_STEP, UNIT_STEP)]


# --- the kernel

def subsequences(units: list[str], letters):
    """(unit index, code, weight) of each weighted subsequence, by unit, and each
    unit's length, the square root of its kernel with itself.  A code may come twice."""
    import numpy as np

    # All units at once: letters only, START before and room for a span behind each.
    points = np.frombuffer("\n".join(units).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    high = points > 0xFFFF
    letter = letters[np.where(high, 0, points)]
    for c in np.unique(points[high]):
        letter[points == c] = chr(c).isalpha()
    owner = np.cumsum(points == 10)[letter]
    size = np.bincount(owner, minlength=len(units))
    place = np.arange(len(owner)) - (np.cumsum(size) - size)[owner]
    start = np.cumsum(size + 1 + SPAN) - (size + 1 + SPAN)
    flat = np.zeros(int((size + 1 + SPAN).sum()), dtype=np.int64)
    flat[start[owner] + 1 + place] = np.where(size[owner] > 2, points[letter], 0)
    flat[start[size > 2]] = START
    of = np.repeat(np.arange(len(units)), size + 1 + SPAN)
    found, letter = [], flat > 0
    for second in range(1, SPAN - 1):
        for third in range(second + 1, SPAN):
            n = max(0, len(flat) - third)
            at = np.flatnonzero(letter[:n] & letter[second:second + n] & letter[third:])
            found.append((of[at], flat[at] << 42 | flat[at + second] << 21 | flat[at + third], np.full(len(at), DECAY ** (third - 2))))
    unit, code, weight = (np.concatenate(c) for c in zip(*found))
    # One sort brings a unit's equal codes together: the unit above a hash of the code.
    key = unit.astype(np.uint64) << np.uint64(64 - UNIT_BITS) | mixed(code.astype(np.uint64)) >> np.uint64(UNIT_BITS)
    order = np.argsort(key)
    unit, code, weight, key = unit[order], code[order], weight[order], key[order]
    if not len(unit):
        return unit, code, weight, np.ones(len(units))
    start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    total = np.add.reduceat(weight, start)
    return unit, code, weight, np.sqrt(np.maximum(np.bincount(unit[start], total * total, len(units)), 1e-12))


class Landmarks:
    """The kernel of any unit with each of a set of units, both scaled to length 1."""

    def __init__(self, units: list[str]):
        import numpy as np

        self.units, self.letters = units, letter_table()
        unit, code, weight, length = (np.concatenate(x) for x in zip(*self._parts(units)))
        self.codes, at = np.unique(code, return_inverse=True)
        self.table = np.zeros((len(self.codes), len(units)), dtype=np.float32)
        np.add.at(self.table, (at, unit), weight / length[unit])

    def _parts(self, units: list[str]):
        for low in range(0, max(1, len(units)), 1 << UNIT_BITS):
            unit, code, weight, length = subsequences(units[low:low + (1 << UNIT_BITS)], self.letters)
            yield unit + low, code, weight, length

    def kernel(self, units: list[str]):
        import numpy as np

        return np.concatenate([self._kernel(units[low:low + (1 << UNIT_BITS)]) for low in range(0, len(units), 1 << UNIT_BITS)]
                              or [np.zeros((0, len(self.units)), dtype=np.float32)])

    def _kernel(self, units: list[str]):
        """A row a unit: its kernel with each landmark, to the power POWER (a
        product of kernels is one), so that slight likenesses don't add up."""
        import numpy as np

        out = np.zeros((len(units), len(self.units)), dtype=np.float32)
        unit, code, weight, length = subsequences(units, self.letters)
        if len(self.codes) and len(code):
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            known = np.flatnonzero(self.codes[at] == code)
            unit, at = unit[known], at[known]
            if len(unit):
                value = self.table[at] * (weight[known] / length[unit]).astype(np.float32)[:, None]
                start = np.flatnonzero(np.concatenate(([True], unit[1:] != unit[:-1])))
                out[unit[start]] = np.add.reduceat(value, start, axis=0)
        return out ** POWER

    def margins(self, units: list[str], alpha):
        """The sum over the landmarks of kernel times `alpha`, one number a unit."""
        import numpy as np

        return np.concatenate([self._kernel(units[low:low + (1 << UNIT_BITS)]) @ alpha for low in range(0, len(units), 1 << UNIT_BITS)]
                              or [np.zeros(0)])


# --- training

def _sample(docs: DataFrame, labels: DataFrame, per_label: int) -> DataFrame:
    """(toxic, text): labelled documents that aren't held out, about `per_label` of each label."""
    marked = (labels.where("doc_id is not null and toxic is not null").groupBy("doc_id")
              .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic")))
    ids = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct().join(marked, "doc_id")
    sizes = ids.groupBy("toxic").agg(F.count(F.lit(1)).alias("rows"))
    share = F.pmod(F.xxhash64("doc_id", F.lit(13)), F.lit(1 << 30)) / float(1 << 30)
    # Which documents: narrow rows.  Their texts: a join with that bounded list, without a shuffle.
    chosen = cut_lineage(ids.join(F.broadcast(sizes), "toxic").where(share * F.col("rows") < per_label).select("doc_id", "toxic"))
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("toxic", "text")


def _document_counts(sample: DataFrame, parts_of) -> DataFrame:
    """part, bad and good: in how many training documents of each label a unit or a part of one stands."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        counts = (Counter(), Counter())
        for batch in batches:
            for toxic, text in zip(*batch.columns):
                units = {u for sentence in sentences_of(text.as_py()) for u in sentence}
                counts[toxic.as_py() > 0].update({x for u in units for x in parts_of(u)})
        parts = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays([pa.array(parts, pa.string()), pa.array([counts[1][x] for x in parts], pa.int64()),
                                          pa.array([counts[0][x] for x in parts], pa.int64())], ["part", "bad", "good"])

    return (sample.mapInArrow(run, "part string, bad long, good long")
            .groupBy("part").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")))


def _grams(unit: str) -> list[str]:
    letters = "".join(c for c in unit if c.isalpha())
    return [letters[k:k + GRAM] for k in range(len(letters) - GRAM + 1)]


def choose_landmarks(sample: DataFrame, n_bad: int, n_good: int, landmarks: int = LANDMARKS) -> tuple[list[str], list[str]]:
    """(units of toxic documents, frequent units): the landmarks of both kinds.

    A unit counts as one of toxic documents by its most telling run of GRAM
    letters, so that rare forms of one insult count together."""
    odds = F.log((F.col("bad") + 0.5) / (n_bad + 1.0)) - F.log((F.col("good") + 0.5) / (n_good + 1.0))
    enough = F.col("bad") + F.col("good") >= MIN_DOCUMENTS
    telling = (_document_counts(sample, _grams).where(enough).withColumn("weight", odds * F.sqrt("bad"))
               .orderBy(F.desc("weight"), "part").limit(CANDIDATES))
    units = _document_counts(sample, lambda u: [u] if len(u) > 1 else []).where(enough)
    letters = F.regexp_replace("part", r"[^\p{L}]", "")
    grams = F.transform(F.sequence(F.lit(1), F.greatest(F.length(letters) - GRAM + 1, F.lit(1))), lambda k: letters.substr(k, F.lit(GRAM)))
    suspicious = (units.where(odds >= math.log(LEAST_ODDS)).select(F.col("part").alias("unit"), "bad", F.explode(grams).alias("part"))
                  .join(telling.select("part", "weight"), "part").groupBy("unit", "bad").agg(F.max("weight").alias("weight"), F.max_by("part", F.struct("weight", "part")).alias("part")))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("bad"), "unit"))
    suspicious = suspicious.withColumn("place", place).where(F.col("place") <= PER_GRAM)
    candidates = ([r.unit for r in suspicious.orderBy(F.desc("weight"), F.desc("bad"), "unit").limit(CANDIDATES).collect()],
                  [r.part for r in units.orderBy(F.desc("good"), "part").limit(CANDIDATES).collect()])
    kinds: list[list[str]] = []
    for units_of in candidates:
        before = [u for kind in kinds for u in kind]
        like = Landmarks(units_of + before).kernel(units_of)
        taken: list[int] = []
        for i in range(len(units_of)):
            others = taken + list(range(len(units_of), len(units_of) + len(before)))
            if len(taken) < landmarks // 2 and like[i, i] > 0 and (not others or like[i, others].max() < LIKE):
                taken.append(i)
        kinds.append([units_of[i] for i in taken])
    return kinds[0], kinds[1]


class _Margins:
    """Units' margins, remembered."""

    def __init__(self, landmarks: Landmarks, alpha):
        self.landmarks, self.alpha, self.known = landmarks, alpha, {}

    def of(self, texts: list[str]):
        """The margins of each text's sentences, with the sentences."""
        split = [list(sentences_of(t)) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        fresh = list({u for units in split for sentence in units for u in sentence if u not in known})
        known.update(zip(fresh, self.landmarks.margins(fresh, self.alpha).tolist()))
        return [([sum([known[u] for u in sentence]) for sentence in units], units) for units in split]


def _texts(column, rows: int = 256, chars: int = 1 << 20):
    """(first row, texts) of a few rows at a time."""
    held, low, n = [], 0, 0
    for at, text in enumerate(column, 1):
        held.append(text.as_py() or "")
        n += len(held[-1])
        if len(held) == rows or n >= chars or at == len(column):
            yield low, held
            held, low, n = [], at, 0


def _with_insertion(unit: str) -> str:
    """The unit with another letter inside."""
    k = len(unit) // 2
    return unit[:k] + "xqkz"[len(unit) % 4] + unit[k:]


def _highest_sentences(sample: DataFrame, landmarks: Landmarks, alpha):
    """(kernel sums, labels): a row per training document, of its sentence with
    the highest margin, and for toxic ones a second with a letter put into its highest unit."""
    import numpy as np

    shared = sample.sparkSession.sparkContext.broadcast((landmarks, alpha))

    def run(batches):
        import pyarrow as pa

        margins = _Margins(*shared.value)
        for batch in batches:
            labels = batch.column(0).to_pylist()
            for low, texts in _texts(batch.column(1)):
                marks, sentences = [], []
                for toxic, (of_text, units) in zip(labels[low:low + len(texts)], margins.of(texts)):
                    sentence = units[int(np.argmax(of_text))] if units else []
                    marks.append(toxic)
                    sentences.append(sentence)
                    if toxic > 0 and sentence:
                        high = max(sentence, key=margins.known.get)
                        marks.append(toxic)
                        sentences.append([_with_insertion(u) if u == high else u for u in sentence])
                sums = [margins.landmarks.kernel(s).sum(axis=0).astype(np.float32).tobytes() for s in sentences]
                yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int32()), pa.array(sums, pa.binary())], ["toxic", "sums"])

    found = sample.mapInArrow(run, "toxic int, sums binary").collect()  # the bounded sample
    x = np.array([np.frombuffer(r.sums, dtype=np.float32) for r in found], dtype=np.float64).reshape(len(found), len(landmarks.units))
    y = np.where(np.array([r.toxic for r in found]) > 0, 1.0, -1.0)
    order = np.lexsort((*x.T, y))  # rows come in any order, sums of floats shouldn't
    return x[order], y[order]


def _whitening(landmarks: Landmarks):
    """The inverse square root of the landmarks' kernel matrix (its Nystroem map)."""
    import numpy as np

    values, vectors = np.linalg.eigh(landmarks.kernel(landmarks.units).astype(np.float64))
    keep = values > 1e-6 * max(1.0, values.max())
    return (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T


def _support_vector_machine(x, y, penalty: float = 1.0, rounds: int = 50):
    """(w, b) of the squared hinge loss with classes weighing the same, by Newton's method."""
    import numpy as np

    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    a = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.eye(a.shape[1]) / penalty
    ridge[-1, -1] = 1e-6
    w, active = np.zeros(a.shape[1]), np.ones(len(y), dtype=bool)
    for _ in range(rounds):
        part, weight = a[active], share[active]
        w = np.linalg.solve(ridge + part.T @ (part * weight[:, None]), part.T @ (weight * y[active]))
        now = y * (a @ w) < 1
        if (now == active).all():
            break
        active = now
    return w[:-1], w[-1]


def _logistic(margin, y, rounds: int = 50):
    """(slope, shift) of the curve from margins to the share of toxic documents, with smoothed targets."""
    import numpy as np

    n_bad, n_good = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n_bad + 1) / (n_bad + 2), 1 / (n_good + 2))
    a, p = np.stack([margin, np.ones(len(margin))], axis=1), np.zeros(2)
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a @ p, -30, 30)))
        step = np.linalg.solve(a.T @ (a * (q * (1 - q))[:, None]) + 1e-4 * np.eye(2), a.T @ (target - q) - 1e-4 * p)
        p = p + step
        if np.abs(step).max() < 1e-9:
            break
    return float(p[0]), float(p[1])


class Model:
    """Landmarks, their weights, and the curve from margins to scores."""

    def __init__(self, landmarks: Landmarks, alpha, shift: float, curve: tuple[float, float]):
        self.landmarks, self.alpha, self.shift, self.curve = landmarks, alpha, shift, curve

    def score(self, margin: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.curve[0] * (margin + self.shift) + self.curve[1]))))


def learn(docs: DataFrame, labels: DataFrame, landmarks: int = LANDMARKS, sample_per_label: int = SAMPLE_PER_LABEL) -> Model | None:
    """A model from the labelled documents that aren't held out; None without labels of both kinds."""
    import numpy as np

    sample = cut_lineage(_sample(docs, labels, sample_per_label))
    n = {r.toxic: r["count"] for r in sample.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    if len(n) < 2:
        return None
    bad, frequent = choose_landmarks(sample, n[True], n[False], landmarks)
    if not bad and not frequent:
        return None
    known = Landmarks(bad + frequent)
    white = _whitening(known)
    alpha, shift = np.array([1.0] * len(bad) + [0.0] * len(frequent)), 0.0
    seen_x, seen_y = [], []
    for _ in range(ROUNDS):
        x, y = _highest_sentences(sample, known, alpha)
        # Toxic documents stand for their latest sentence only, the others for all they gave.
        seen_x = [x] + [old[of < 0] for old, of in zip(seen_x, seen_y)]
        seen_y = [y] + [of[of < 0] for of in seen_y]
        w, shift = _support_vector_machine(np.concatenate(seen_x) @ white, np.concatenate(seen_y))
        alpha = white @ w
    x, y = _highest_sentences(sample, known, alpha)
    return Model(known, alpha, float(shift), _logistic(x @ alpha + shift, y))


def score(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",), threshold: float = THRESHOLD) -> DataFrame:
    """`keep` columns plus `score` (0 to 1) and `predicted` (1 from `threshold` on)."""
    rows, kept = docs.select(*keep, F.col("text").alias("__text")), len(keep)
    names = [*keep, "score", "predicted"]
    if model is None:
        return rows.select(*keep, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa

        model = shared.value
        margins = _Margins(model.landmarks, model.alpha)
        for batch in batches:
            for low, texts in _texts(batch.column(kept)):
                scores = [model.score(max(of_text, default=0.0)) for of_text, _ in margins.of(texts)]
                yield pa.RecordBatch.from_arrays([
                    *batch.slice(low, len(texts)).columns[:kept], pa.array(scores, pa.float64()),
                    pa.array([int(s >= threshold) for s in scores], pa.int32())], names)

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:kept], T.StructField("score", T.DoubleType()),
                                              T.StructField("predicted", T.IntegerType())]))


cloudpickle.register_pickle_by_value(sys.modules[__name__])
