"""Operators that compare texts with each other."""

import hashlib
import random

import pytest
from llm_cases import LAST_ID, as_id, brute_join, brute_substring, empty_documents, odd_documents, pairs_of

from listing_engine.llm import lz_fingerprint as lz, ngram_join, shingles, substring_dedup

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_word_and_window_hashes(monkeypatch):
    tables, rng = shingles.byte_tables(), random.Random(1)
    for chunk in (1 << 20, 1, 4):
        monkeypatch.setattr(shingles, "CHUNK", chunk)
        seen = {}
        for _ in range(300):
            raw = "".join(rng.choice(" ab\n\té\x0b") for _ in range(rng.randrange(40))).encode()
            words, got = raw.split(), shingles.word_hashes(raw, tables)
            assert len(words) == len(got)
            for w, h in zip(words, got.tolist()):
                assert seen.setdefault(w, h) == h
            for k in (2, 5):
                for i, h in enumerate(shingles.window_hashes(got, k).tolist()):
                    assert seen.setdefault(tuple(words[i:i + k]), h) == h
        assert len(set(seen.values())) == len(seen)


# --- n-gram join

def joined(df, **kw):
    return sorted((r.doc, r.class_id, r.n_links) for r in ngram_join.join(df, **kw).collect())


def test_join_equals_brute_force(spark, docs):
    assert joined(docs) == brute_join(pairs_of(docs), 5)
    frame = odd_documents(spark)
    assert joined(frame) == brute_join(pairs_of(frame), 5)
    assert ngram_join.join(empty_documents(spark)).collect() == []


@pytest.mark.parametrize("members", [4, 256])
def test_join_of_a_large_group_in_blocks(spark, monkeypatch, members):
    """One group of near copies over many blocks: every link is counted, classes are whole."""
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", members)
    rng = random.Random(members)
    base, rows = [rng.choice("abcdefgh") for _ in range(40)], []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(3)):
            words[rng.randrange(40)] = rng.choice("xyz")
        rows.append((rng.choice([None, i]), " ".join(words), None, None))
    frame = odd_documents(spark, rows)
    assert joined(frame, n=3) == brute_join(pairs_of(frame), 3)


def test_join_report_and_dedup(spark):
    frame = odd_documents(spark)
    report = ngram_join.report(ngram_join.join(frame)).collect()
    assert len(report) == frame.count() and {r.doc_id for r in report if r.doc_id is None}
    classes = {c for _, c, _ in brute_join(pairs_of(frame), 5)}
    kept = ngram_join.deduplicate(frame)
    assert kept.columns == frame.columns
    assert sorted(as_id(r.doc_id) for r in kept.collect()) == sorted(classes)


def test_bands_reach_the_recall():
    for threshold, recall in ((0.8, 0.9999), (0.8, 0.99), (0.5, 0.95)):
        bands, rows = ngram_join.choose_bands(threshold, recall)
        assert 1 - (1 - threshold ** rows) ** bands >= recall and bands * rows <= ngram_join.MOST_HASHES


# --- substring dedup

def test_dedup_equals_brute_force(spark, docs):
    for frame, kw in ((docs, {}), (odd_documents(spark), {}), (odd_documents(spark), {"window": 6, "seed": 3})):
        got = sorted((as_id(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring_dedup.kept(frame, **kw).collect())
        assert got == brute_substring(pairs_of(frame), kw.get("window", 50))
    assert substring_dedup.kept(empty_documents(spark)).collect() == []


def test_a_full_sketch_loses_nothing(spark):
    """With a sketch far too small every window goes to the exact step."""
    rng = random.Random(2)
    frame = odd_documents(spark, [(i, " ".join(rng.choice("abc") for _ in range(60)), None, None) for i in range(80)])
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept) for r in
                 substring_dedup.kept(frame, window=7, seed=3, max_sketch_bits=64).collect())
    assert got == brute_substring(pairs_of(frame), 7)


def test_rows_of_one_id_whose_marks_agree(spark, monkeypatch):
    """Many texts without an id, told apart by few bits: a window counts only where a text has it."""
    monkeypatch.setattr(substring_dedup, "TIE_BITS", 2)
    monkeypatch.setattr(substring_dedup, "TIE_MASK", 3)
    rng = random.Random(5)
    words = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared, rows = words(60), []
    rows.append((1, " ".join(shared), "en", None))
    for k in range(200):
        own = words(rng.choice([3, 60, 300]))
        if k % 3 == 0:
            at = rng.randrange(len(own) + 1)
            own[at:at] = shared
        rows.append((None, " ".join(own), "en", None))
    frame = odd_documents(spark, rows).repartition(5)
    want = brute_substring(pairs_of(frame), 50)
    got = sorted((as_id(r.doc_id), r.n_words, r.n_removed, r.kept) for r in substring_dedup.kept(frame).collect())
    assert got == want and sum(r[2] for r in want) == 67 * 60
    left = sorted(r.text for r in substring_dedup.dedup(frame).collect())
    assert left == sorted(text for _, _, _, text in want if text)


def test_dedup_keeps_columns_and_untouched_texts(spark):
    frame = odd_documents(spark)
    out = substring_dedup.dedup(frame)
    assert out.columns == frame.columns
    want = [(i, n, gone, text) for i, n, gone, text in brute_substring(pairs_of(frame), 50) if not gone or text]
    texts = {as_id(r.doc_id): r.text for r in frame.collect()}
    got = sorted((as_id(r.doc_id), r.text or "") for r in out.collect())
    assert len(got) == len(want)
    assert [i for i, _ in got] == [i for i, *_ in want]
    assert all(text == (texts[i] or "") for i, text in got if i in (1, 2, 3, 4, 7, 8))


# --- Lempel-Ziv fingerprints

def test_fingerprints_of_documents_and_their_edits(docs):
    got = {r.doc_id: r for r in lz.with_neighbours(docs).collect()}
    rows = sorted(pairs_of(docs), reverse=True)
    nearer = 0
    for k, (doc_id, text) in enumerate(rows):
        following, third = rows[(k + 1) % len(rows)][1], len(text) // 3
        edited = text[:len(text) - third] + following[:third]
        own, new, other = lz.signature(text), lz.signature(edited), lz.signature(following)
        r = got[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (lz.text_of(own), lz.text_of(new))
        assert (r.near_edited, r.near_next) == (lz.likeness(own, new), lz.likeness(own, other))
        nearer += r.near_edited > r.near_next or text == following
    assert nearer == len(rows)
    alone = {r.doc_id: r.fingerprint for r in lz.fingerprints(docs).collect()}
    assert alone == {i: r.fingerprint for i, r in got.items()}


def test_fingerprints_of_ids_with_many_rows(spark):
    """A third of the rows without an id, a third with one: cut by their texts, the order is whole."""
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice("abcdefg") for _ in range(30)), None, None) for i in [*[None] * 60, *[77] * 60, *range(60)]]
    rows += [(77, "the same text", None, None)] * 20
    frame = odd_documents(spark, rows).repartition(4)
    got = lz.with_neighbours(frame).collect()
    order = sorted(((as_id(i) if i is not None else -1), t) for i, t in pairs_of(frame))
    assert sorted((as_id(r.doc_id) if r.doc_id is not None else -1) for r in got) == [i for i, _ in order]
    ties = {r.text: r.tie for r in frame.selectExpr("text", "xxhash64(text) tie").distinct().collect()}
    ordered = sorted(pairs_of(frame), key=lambda x: (-1 if x[0] is None else x[0], ties[x[1]]), reverse=True)
    want = []
    for k, (doc_id, text) in enumerate(ordered):
        following, third = ordered[(k + 1) % len(ordered)][1], len(text) // 3
        want.append((str(doc_id), hashlib.sha256((text[:len(text) - third] + following[:third]).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.edited_sha256) for r in got) == sorted(want)


def test_likeness_estimates_the_phrase_sets(docs):
    texts = [t for _, t in pairs_of(docs)][:40]
    for a, b in zip(texts, texts[1:]):
        pa, pb = [], []
        lz.parse(a, set(), pa)
        lz.parse(b, set(), pb)
        exact = len(set(pa) & set(pb)) / len(set(pa) | set(pb))
        assert abs(lz.likeness(lz.signature(a), lz.signature(b)) - exact) < 0.2


def test_fingerprints_of_odd_documents(spark):
    frame = odd_documents(spark)
    got = lz.with_neighbours(frame).collect()
    assert sorted(as_id(r.doc_id) for r in got) == sorted(as_id(i) for i, _ in pairs_of(frame))
    assert all(0 <= x <= 1 for r in got for x in (r.near_edited, r.near_next))
    assert {r.fingerprint for r in got if r.doc_id in (1, 2)} == {""}
    single = lz.with_neighbours(odd_documents(spark, [(5, "abcabcabd", None, None)])).collect()
    assert len(single) == 1 and single[0].near_next == 1.0
    assert lz.with_neighbours(empty_documents(spark)).collect() == []
    assert LAST_ID not in {r.doc_id for r in got}
