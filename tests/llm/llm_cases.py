"""Awkward documents, and brute-force versions of the operators."""

import random
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST_ID = (1 << 63) - 1
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long,"
          " words string, size int, starts string, label string, bucket int, doc string, tie int, slice string")


def odd_documents(spark, rows=None):
    """Nulls in every column, empty and very long texts, ties, repeated rows, extra columns with clashing names."""
    rng = random.Random(7)
    prose = lambda n: " ".join(rng.choice(["the", "of", "Apache", "License", "MIT", "ab", "é", "CC", "BY", "中文"]) for _ in range(n))
    long_run, long_words = "a" * 150_000, prose(30_000)
    shared = prose(80)
    if rows is None:
        rows = [
            (1, None, "en", "s1"), (2, "", "en", None), (3, " \n\t ", None, "s1"), (4, "...", "de", "s2"),
            (5, shared, "en", "s1"), (6, shared, "en", "s1"), (6, shared, "en", "s1"), (6, shared + " x", "en", "s2"),
            (None, shared, None, None), (None, None, None, None), (7, long_run, "fr", "s3"), (8, long_words, "en", "s3"),
            (9, "x " + shared + " y", "en", "s2"), (10, "one line\none line\n\none line", "en", "s4"), (11, "K\x1c\x85İ MIT License", "en", "s4"),
        ]
    return spark.createDataFrame([(*r, len(r[1] or ""), "w", 1, "s", "l", 2, "d", 3, "z") for r in rows], SCHEMA)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs_of(docs):
    return [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]


def as_id(i):
    return LAST_ID if i is None else i


def brute_substring(rows, k):
    tokens = [(as_id(i), WORD.findall(t or "")) for i, t in rows]
    first = {}
    for d, w in tokens:
        for i in range(len(w) - k + 1):
            key = tuple(w[i:i + k])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, w in tokens:
        gone = {p for i in range(len(w) - k + 1) if first[tuple(w[i:i + k])] < d for p in range(i, i + k)}
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def brute_join(rows, n):
    """(id, class, links) at a likeness of 4/5 or more."""
    sets = []
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset())
    near = defaultdict(set)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and (len(a & b) * 5 >= 4 * len(a | b)):
                near[i].add(j)
    label = [as_id(i) for i, _ in rows]
    changed = True
    while changed:
        changed = False
        for i in near:
            least = min([label[i], *(label[j] for j in near[i])])
            changed |= least != label[i]
            label[i] = least
    return sorted((as_id(r[0]), label[i], len(near[i])) for i, r in enumerate(rows))


def brute_quality(t):
    t = t or ""
    w = WORD.findall(t)
    times, covered, seen, dup = Counter(zip(w, w[1:], w[2:])), set(), set(), 0
    for i in range(len(w) - 2):
        if times[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(covered)


LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
PHRASES = {"gpl": "gnu general public license", "apache": "apache license", "cc-by": "cc by", "mit": "mit license"}


def brute_license(t):
    w, starts, labels = LICENSE_WORD.findall((t or "").translate(LOWER)), [], set()
    for label, phrase in PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(w)) if w[i:i + len(p)] == p]
        starts += here
        labels |= {label} if here else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))
