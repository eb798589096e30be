"""Operators that judge or turn each text by itself."""

import hashlib
import random

import public_tokenizers as public
import pytest
import tiktoken
from llm_cases import brute_license, brute_quality, empty_documents, odd_documents, pairs_of
from pyspark.sql import functions as F

from listing_engine.llm import bpe, language, license_scan, quality_rules

SF = "/root/testdata/sf0.001"
RANKS = public.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- byte-level BPE

def test_bpe_equals_the_library_and_decodes_back(spark, docs):
    encoding = bpe._encoding(bpe._load_ranks(RANKS), public.PATTERN)
    for frame in (docs, odd_documents(spark)):
        want = []
        for doc_id, text in pairs_of(frame):
            ids = encoding.encode_ordinary(text or "")
            want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
        assert sorted_rows(bpe.digests(bpe.encode(frame, RANKS, public.PATTERN, round_trip=True))) == sorted(want, key=str)
        apart = bpe.decode(bpe.encode(frame, RANKS, public.PATTERN), RANKS, public.PATTERN)
        assert sorted_rows(bpe.digests(apart)) == sorted(want, key=str)


def test_bpe_of_an_empty_table(spark):
    assert bpe.digests(bpe.encode(empty_documents(spark), RANKS, public.PATTERN, round_trip=True)).collect() == []


def test_bpe_pieces_are_safe():
    import regex
    encoding, matcher, rng = bpe._encoding(bpe._load_ranks(RANKS), public.PATTERN), regex.compile(public.PATTERN), random.Random(3)
    assert isinstance(encoding, tiktoken.Encoding)
    for _ in range(1500):
        text = "".join(rng.choice("ab 1\n\t's.!\x1c\x85　中") for _ in range(rng.randrange(60)))
        for limit in (1, 2, 5):
            assert bpe.encode_text(encoding, text, matcher, limit) == encoding.encode_ordinary(text)
    for text in ("a" * 200_000, " " * 200_000 + "b", "\n \n" * 50_000 + "z", "é1" * 60_000):
        assert bpe.encode_text(encoding, text, matcher, 1 << 12) == encoding.encode_ordinary(text)


# --- language

def test_language_on_held_out_documents(docs):
    profiles = language.learn(language.training_rows(docs))
    assert set(profiles) == {"en", "de", "fr", "es"} and all(len(p) <= language.RANKS for p in profiles.values())
    judged = language.predict(docs, profiles, keep=("doc_id", "lang")).where(language.held_out(F.col("doc_id"))).collect()
    assert len(judged) > 30
    assert sum(r.lang == r.lang_pred for r in judged) >= 0.97 * len(judged)
    assert all(0 <= r.score <= 1 for r in judged)


def test_language_sees_only_the_text(spark, docs):
    profiles = language.learn(language.training_rows(docs))
    text = docs.where("lang = 'de'").first().text
    frame = odd_documents(spark, [(1, text, "en", "x"), (None, text, None, None), (2, "123 .,-", "en", "s"), (3, None, "de", "s"), (4, "", None, None)])
    judged = sorted_rows(language.predict(frame, profiles))
    assert [r[1] for r in judged if r[0] in (1, None)] == ["de", "de"]
    assert {r[1:] for r in judged if r[0] in (2, 3, 4)} == {("und", 0.0)}


def test_language_without_labels(spark):
    assert language.learn(language.training_rows(empty_documents(spark))) == {}
    assert {r.lang_pred for r in language.predict(odd_documents(spark), {}).collect()} == {"und"}
    assert language.predict(empty_documents(spark), {"en": [1]}).collect() == []


def test_ngram_counts_do_not_depend_on_chunks(monkeypatch):
    letters, rng = language.letter_table(), random.Random(5)
    texts = ["".join(rng.choice("ab é.1\n中😀B") for _ in range(rng.randrange(40))) for _ in range(300)]
    whole = [tuple(map(list, language.gram_counts(t, letters))) for t in texts]
    for chunk in (1, 2, 5):
        monkeypatch.setattr(language, "CHUNK", chunk)
        for text, want in zip(texts, whole):
            if any(c.isalpha() for c in text):
                assert tuple(map(list, language.gram_counts(text, letters))) == want, (chunk, text)


# --- licences

def test_license_places_equal_brute_force(spark, docs):
    for frame in (docs, odd_documents(spark)):
        got = sorted_rows(license_scan.report(license_scan.scan(frame)).select(
            "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"))
        assert got == sorted([(i, *brute_license(t)) for i, t in pairs_of(frame)], key=str)


def test_license_labels_of_the_method(spark):
    frame = odd_documents(spark, [
        (1, "Licensed under the Apache License, Version 2.0.", None, None),
        (2, "Permission is hereby granted, free of charge, to any person obtaining a copy", None, None),
        (3, "Permission is hereby refused, free of charge", None, None),
        (4, "CC BY, cc-by NC 4.0", None, None)])
    got = {r.doc_id: r for r in license_scan.report(license_scan.scan(frame)).collect()}
    assert got[1].labels == "apache,apache-2.0" and got[1].base_labels == "apache"
    assert got[2].labels == "mit-grant" and got[2].n_base == 0
    assert got[3].labels == "" and got[3].score == 0
    assert got[4].n_base == 2 and (got[4].first_word, got[4].last_word) == (0, 2)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert license_scan.report(license_scan.scan(empty_documents(spark))).collect() == []


# --- quality rules

def test_quality_counts_equal_brute_force(spark, docs):
    for frame in (docs, odd_documents(spark)):
        got = sorted_rows(quality_rules.statistics(frame).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == sorted([(i, *brute_quality(t)) for i, t in pairs_of(frame)], key=str)


def test_quality_rules_learn_thresholds_and_keep_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    features = quality_rules.with_features(quality_rules.statistics(docs)).cache()
    rules = quality_rules.learn(features, labels)
    assert rules and quality_rules.learn(features, labels) == rules
    judged = quality_rules.judge(features, rules).join(labels, "doc_id").collect()
    good = [r for r in judged if r.quality == 1 and not r.base_failed]
    bad = [r for r in judged if r.quality == 0]
    assert sum(r.kept for r in good) >= 0.98 * len(good)
    assert sum(r.kept for r in bad) <= 0.1 * len(bad)
    assert not any(r.kept for r in judged if r.base_failed)


def test_quality_without_labels(spark):
    features = quality_rules.with_features(quality_rules.statistics(odd_documents(spark)))
    none = spark.createDataFrame([(None, 0), (1, None)], "doc_id long, quality int")
    assert quality_rules.learn(features, none) == []
    assert quality_rules.learn(features, spark.createDataFrame([(5, 1)], "doc_id long, quality int")) == []
    assert all(r.kept != r.base_failed for r in quality_rules.judge(features, []).collect())
    assert quality_rules.judge(quality_rules.with_features(quality_rules.statistics(empty_documents(spark))), []).collect() == []
