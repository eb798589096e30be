"""License scans with a positional index of rare words.

A template is a licence text with a mandatory key phrase.  One pass counts in
how many documents each template word occurs; the postings index keeps, per
template, the rarest word of its key phrase (the anchor) and its rarest words
overall, each with its position.  In a file only the anchors are looked up.
An anchor at word i whose template position is p says that the template would
start at i - p; the key phrase must stand there word for word, and the other
rare words of the template vote by their relative positions.  A file's
evidence for a template is the IDF share of its rare words that stand in
place; the template's label is given from `least_evidence` on.

A key phrase contains its anchor, so no place of a phrase is missed, whatever
the counts are.  Everything is native: arrays and lambdas inside one scan; the
only data that leaves Spark is one count per template word.

Defined results: NULL text is empty; a file without labels has score 0 and
NULL places; overlapping places all count; repeated rows are scanned one by
one; texts are scanned whole; other columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import let

# Words: ASCII letters and digits and everything beyond ASCII.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    key: tuple[str, ...]
    base: bool = False

    @property
    def key_at(self) -> int:
        n = len(self.key)
        return next(i for i in range(len(self.words)) if self.words[i:i + n] == self.key)


def template(label: str, text: str, key: str | None = None, base: bool = False) -> Template:
    return Template(label, tuple(text.split()), tuple((key or text).split()), base)


# The base phrases with their labels, then well-known licence wordings.
TEMPLATES = (
    template("gpl", "gnu general public license", base=True),
    template("apache", "apache license", base=True),
    template("cc-by", "cc by", base=True),
    template("mit", "mit license", base=True),
    template("all-rights-reserved", "all rights reserved"),
    template("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    template("bsd", "redistribution and use in source and binary forms with or without modification are permitted"
             " provided that the following conditions are met", "redistribution and use in source and binary forms"),
    template("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    template("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    template("gpl-3.0", "this work is licensed under the gnu general public license version 3",
             "gnu general public license version 3"),
    template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee"
             " is hereby granted", "permission to use copy modify"),
    template("lgpl", "gnu lesser general public license"),
    template("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software",
             "permission is hereby granted free of charge"),
    template("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    template("public-domain", "this is free and unencumbered software released into the public domain",
             "released into the public domain"),
)


def words(text: Column) -> Column:
    """Words with A-Z in lower case.

    `lower` maps one sign beyond ASCII into ASCII, the Kelvin sign; it is
    replaced first, by a letter that stays a word character.
    """
    plain = F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("κ"))
    return F.array_remove(F.split(F.lower(plain), SEPARATORS, -1), "")


def document_counts(docs: DataFrame, templates: tuple[Template, ...]) -> tuple[int, dict[str, int]]:
    """The number of documents, and for each template word those that have it."""
    vocabulary = sorted({w for t in templates for w in t.words})
    literal = F.array(*map(F.lit, vocabulary))
    marked = docs.select(F.explode(F.concat(F.array(F.lit("")), F.array_intersect(words(F.col("text")), literal))).alias("word"))
    counts = {r.word: r.n for r in marked.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return counts.pop("", 0), counts


def scan(docs: DataFrame, templates: tuple[Template, ...] = TEMPLATES, rare: int = 4,
         least_evidence: float = 0.5) -> DataFrame:
    """doc_id, n_words, and `found`: per template its label, base flag, places and evidence."""
    total, counts = document_counts(docs, templates)
    idf: Callable[[str], float] = lambda w: math.log((1 + total) / (1 + counts.get(w, 0))) + 1

    def postings(t: Template) -> list[tuple[str, int]]:
        # A word that no document has can't vote; it is the last to be taken.
        return sorted(((w, i) for i, w in enumerate(t.words)), key=lambda x: (x[0] not in counts, -idf(x[0]), x[1]))

    def anchor(t: Template) -> tuple[str, int]:
        return min(((w, i) for i, w in enumerate(t.key)), key=lambda x: (-idf(x[0]), x[1]))

    anchors = F.array(*map(F.lit, sorted({anchor(t)[0] for t in templates})))

    def places(w: Column, hits: Column, t: Template) -> Column:
        word, at = anchor(t)
        starts = F.transform(F.filter(hits, lambda h: h.w == word), lambda h: h.i - at)
        here = lambda s: F.array_join(F.slice(w, F.greatest(s, F.lit(0)) + 1, len(t.key)), " ") == " ".join(t.key)
        return F.filter(starts, lambda s: (s >= 0) & here(s))

    def evidence(w: Column, start: Column, t: Template) -> Column:
        chosen = postings(t)[:rare]
        whole = sum(idf(x) for x, _ in chosen)
        stands = lambda x, i: F.coalesce(F.get(w, start - t.key_at + i) == x, F.lit(False))
        return reduce(lambda a, b: a + b, [F.when(stands(x, i), F.lit(idf(x) / whole)).otherwise(F.lit(0.0)) for x, i in chosen])

    def entry(w: Column, hits: Column, t: Template) -> Column:
        return let(places(w, hits, t), lambda p: F.struct(
            F.lit(t.label).alias("label"), F.lit(t.base).alias("base"), p.alias("places"),
            F.coalesce(F.array_max(F.transform(p, lambda s: evidence(w, s, t))), F.lit(0.0)).alias("evidence")))

    def found(w: Column, hits: Column) -> Column:
        return F.array(*[entry(w, hits, t) for t in templates])

    def look_up(w: Column) -> Column:
        hits = F.filter(F.transform(w, lambda x, i: F.struct(x.alias("w"), i.alias("i"))),
                        lambda h: F.array_contains(anchors, h.w))
        matched = let(hits, lambda h: F.filter(
            found(w, h), lambda f: f.base & (F.size(f.places) > 0) | (f.evidence >= least_evidence)))
        empty = F.array().cast("array<struct<label:string,base:boolean,places:array<int>,evidence:double>>")
        return F.struct(F.size(w).cast("long").alias("n_words"),
                        F.when(F.arrays_overlap(w, anchors), matched).otherwise(empty).alias("found"))

    rows = docs.select("doc_id", let(words(F.col("text")), look_up).alias("r"))
    return rows.select("doc_id", "r.n_words", "r.found")


def report(scanned: DataFrame) -> DataFrame:
    base = F.filter("found", lambda f: f.base)
    starts = F.flatten(F.transform(base, lambda f: f.places))
    labels = lambda x: F.array_join(F.array_sort(F.array_distinct(F.transform(x, lambda f: f.label))), ",")
    return scanned.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("found", lambda f: f.evidence)), F.lit(0.0)), 6).alias("score"))
