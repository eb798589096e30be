"""Cross-tokenizer alignment, collocations, toxicity."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as public
import pytest
import sentencepiece
from llm_cases import empty_documents, odd_documents, pairs_of
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from listing_engine.llm import collocations, token_align, toxicity
from listing_engine.llm.perfect_hash import MinimalPerfectHash

SF = "/root/testdata/sf0.001"
A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- minimal perfect hashing

def test_minimal_perfect_hash():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        hashed = MinimalPerfectHash(keys)
        assert sorted(hashed.place(keys).tolist()) == list(range(len(keys)))
        others = np.setdiff1d(rng.integers(0, 1 << 62, 500, dtype=np.uint64), keys)
        assert (hashed.place(others) == -1).all()


# --- alignment

def brute_align(texts):
    a_side, b_side = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    symbol = {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}

    def b_bytes(i):
        piece = b_side.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b_side.is_byte(i) else piece.replace("▁", " ").encode()

    def ends(parts):
        return {e: k for k, e in enumerate(np.cumsum([len(p) for p in parts]).tolist())}

    count, docs = Counter(), []
    for text in texts:
        ids = (a_side.encode(" " + text, add_special_tokens=False).ids, b_side.encode(text)) if text else ([], [])
        spelt = [bytes(symbol[c] for c in a_side.id_to_token(i)) for i in ids[0]], [b_bytes(i) for i in ids[1]]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelt):
            docs.append(None)
            continue
        at_a, at_b = map(ends, spelt)
        links, groups, i, j = [], [], 0, 0
        for e in sorted(set(at_a) & set(at_b)):
            to = at_a[e] + 1, at_b[e] + 1
            groups.append(",".join(map(str, ids[0][i:to[0]])) + "|" + ",".join(map(str, ids[1][j:to[1]])))
            links.append((ids[0][to[0] - 1], ids[1][to[1] - 1]))
            i, j = to
        count.update(links)
        docs.append((len(ids[0]), len(ids[1]), len(groups), links, ";".join(groups)))
    best = {}
    for (_, y), n in count.items():
        best[y] = max(best.get(y, 0), n)
    return [(0, 0, 0, 0, 0, 0, "") if d is None else
            (*d[:3], len(d[3]), sum(count[x] == best[x[1]] for x in d[3]), sum(count[x] for x in d[3]), d[4]) for d in docs]


ODD_TEXTS = [" ", "  ", "\n", "\n\n x", "a  b\n  c\td ▁ x", "é́ ﬁ  ", "a   b", "<|endoftext|> <s> </s>", "x\x1c y", "😀 😀\n\n", "\tx",
             "tab\t\tq \n z", "if (a) {\r\n  b;\r\n}", "x" * 3000, "\x00 a", "a　 b", "𞓐 ͸ Ω я", "it's we'll 'S"]


def test_alignment_equals_brute_force(spark, docs):
    odd = odd_documents(spark, [(100 + i, t, None, None) for i, t in enumerate(ODD_TEXTS)])
    for frame in (docs, odd_documents(spark).unionByName(odd).repartition(5)):
        rows = pairs_of(frame)
        want = sorted(((i, *w) for (i, _), w in zip(rows, brute_align([t for _, t in rows]))), key=str)
        got = sorted((tuple(r) for r in token_align.align(frame, A, B).collect()), key=str)
        assert got == want


def test_alignment_of_an_empty_table(spark):
    assert token_align.align(empty_documents(spark), A, B).collect() == []
    assert token_align.align(odd_documents(spark, [(1, None, None, None)]), A, B).collect()[0].groups == ""


def test_pieces_are_safe_to_cut():
    both, rng = token_align.Tokenizers(token_align.read_bytes(A), token_align.read_bytes(B)), random.Random(8)
    assert both.cuts_are_safe and both.ranks is not None
    for _ in range(1500):
        text = "".join(rng.choice("ab 1\n\t's.!;{\r\x1cé▁ ") for _ in range(rng.randrange(1, 50)))
        x = both.align(both.pieces(text))
        if not x.bad.any():
            assert x.a.tolist() == both.a.encode(" " + text, add_special_tokens=False).ids and x.b.tolist() == both.b.encode(text)


def test_linked_pairs_stay_below_their_bound(docs):
    both = token_align.Tokenizers(token_align.read_bytes(A), token_align.read_bytes(B))
    pairs = {p for _, t in pairs_of(docs) for p in both.align(both.pieces(t)).pairs.tolist()}
    for p in pairs:
        a, b = both.a_bytes[p >> 32], both.b_bytes[p & 0xFFFFFFFF]
        assert a.endswith(b) or b.endswith(a)
    assert len(pairs) <= token_align.pair_bound(both)


# --- collocations

def brute_collocations(rows, max_words=3, least=10, top=2000):
    f, size = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            words = re.findall("[^ \t]+", piece)
            size[lang] += len(words)
            for k in range(1, max_words + 1):
                f[lang].update(tuple(words[i:i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, c in f.items():
        found, longer = {g: a for g, a in c.items() if len(g) > 1 and a >= least}, Counter()
        for g, a in found.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    longer[g[i:i + k]] = max(longer[g[i:i + k]], a)
        ranked = []
        for g, a in found.items():
            if 100 * longer[g] < 50 * a:
                score, k = min((1000000 * a * a // (c[g[:k]] * c[g[k:]]), k) for k in range(1, len(g)))
                ranked.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, size[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(ranked)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("part_bytes", [1 << 24, 3000])
def test_collocations_equal_brute_force(spark, docs, part_bytes):
    extra = [(None, "A b\x01 c "* 15), ("und", "a b\x01 c. a\x01 b "* 15), ("en", None), ("en", ""), ("x", " "), ("zz", "q " * 200),
             ("zz", "İ K é " * 20 + "\tq\tq"), ("hot", "the only line of many documents. " * 300)]
    frame = docs.select("lang", "text").union(spark.createDataFrame(extra, "lang string, text string")).repartition(5).cache()
    rows = [tuple(r) for r in frame.collect()]
    got = sorted(tuple(r) for r in collocations.collocations(frame, part_bytes=part_bytes).collect())
    assert got == brute_collocations(rows)
    few = sorted(tuple(r) for r in collocations.collocations(frame, min_count=4, top=7, part_bytes=part_bytes).collect())
    assert few == brute_collocations(rows, least=4, top=7)


def test_longer_phrases(spark):
    rng = random.Random(6)
    rows = [("a", " ".join(rng.choice("uvwxyz") for _ in range(120))) for _ in range(20)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    got = sorted(tuple(r) for r in collocations.collocations(frame, max_words=5, min_count=3, part_bytes=500).collect())
    assert got == brute_collocations(rows, 5, 3)


def test_runs_are_sorted_by_numbers_in_their_order(spark):
    """Within a range the heads follow (lang, run), and tell most runs apart."""
    import random

    rng = random.Random(3)
    pool = ["a", "ab", "abc", "abcdefghij", "abcdefghik", "Ж", "\x00", "zz"]
    rows = [(lang, " ".join(rng.choices(pool, k=9))) for lang in ("a", "a", "b", "c", "c", "a\x00") for _ in range(40)]
    frame = spark.createDataFrame(rows, "lang string, text string")
    borders = [("a", b"abcdefghij ab "), ("a", b"abcdefghij zz "), ("c", b"ab "), ("c", b"zz ")]
    got = collocations._counted_runs(frame, borders, 3).collect()
    for part in range(len(borders) + 1):
        mine = sorted((r for r in got if r.part == part), key=lambda r: (r.lang, bytes(r.gram)))
        assert mine and all(x["head"] <= y["head"] for x, y in zip(mine, mine[1:]))
    narrow = [r for r in got if r.part == 1]
    assert len({r["head"] for r in narrow}) > 1 and len({r["head"] for r in got if r.part == 3}) > 1


def test_collocations_of_odd_and_empty_tables(spark):
    frame = odd_documents(spark)
    rows = [(r.lang, r.text) for r in frame.collect()]
    assert sorted(tuple(r) for r in collocations.collocations(frame).collect()) == brute_collocations(rows)
    assert collocations.collocations(empty_documents(spark)).collect() == []


def test_scores_beyond_64_bits(spark):
    """The products of the score are exact: 1000000 a a is past 2^63 from a = 3.1 million on."""
    rows = spark.createDataFrame([("k v", 4_000_000_000, 5_000_000_000, 7_000_000_000)], "gram string, a long, l long, r long")
    wide = [F.col(c).cast("decimal(20,0)").alias(c) for c in "alr"]
    shown = rows.select(*wide).selectExpr("cast(cast(1000000 * a as decimal(38,0)) * a as decimal(38,0)) div cast(l * r as decimal(38,0)) as s").first().s
    assert shown == 1_000_000 * 4_000_000_000 ** 2 // (5_000_000_000 * 7_000_000_000)


# --- toxicity

def brute_subsequences(unit):
    letters, out = [chr(toxicity.START), *[c for c in unit if c.isalpha()]], Counter()
    if len(letters) < 4:
        return out
    for i in range(len(letters)):
        for j in range(i + 1, len(letters)):
            for k in range(j + 1, min(len(letters), i + toxicity.SPAN)):
                out[letters[i], letters[j], letters[k]] += toxicity.DECAY ** (k - i - 2)
    return out


def test_kernel_equals_its_definition():
    rng = random.Random(2)
    units = ["".join(rng.choice("abcé.1 ") for _ in range(rng.randrange(14))) for _ in range(60)] + ["", "ab", "abc", "aaaaaaa"]
    marks = [u for u in units if len(u) > 5][:9]
    got = toxicity.Landmarks(marks).kernel(units)
    for i, u in enumerate(units):
        a = brute_subsequences(u)
        for j, v in enumerate(marks):
            b = brute_subsequences(v)
            both = sum(x * b[k] for k, x in a.items())
            norm = (sum(x * x for x in a.values()) * sum(x * x for x in b.values())) ** 0.5
            assert abs(got[i, j] - ((both / norm) if norm else 0) ** toxicity.POWER) < 1e-4


def planted(spark, n=400):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice(["an", "er", "on", "th", "ly", "st", "re", "in"]) for _ in range(rng.randrange(1, 4)))
    insult = ["bladgop", "wumperk", "zonkfur"]
    docs, labels, toxic = [], [], {}
    for i in range(n):
        words = [word() + rng.choice(["", "", ".", ","]) for _ in range(rng.randrange(5, 120))]
        toxic[i] = int(i % 5 == 0)
        if toxic[i]:
            w = rng.choice(insult)
            if i % 2:
                w = rng.choice([".".join(w), w[:3] + "*" + w[3:], " ".join(w), w.upper(), w[:4] + "q" + w[4:]])
            words.insert(rng.randrange(len(words)), w)
        docs.append((i, " ".join(words), None, None))
        if i % 3:
            labels.append((i, toxic[i]))
    return odd_documents(spark, docs), spark.createDataFrame(labels, "doc_id long, toxic int"), toxic


def test_toxic_documents_are_found_and_clean_ones_left_alone(spark):
    docs, labels, toxic = planted(spark)
    model = toxicity.learn(docs, labels)
    rows = toxicity.score(docs, model).collect()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= toxicity.THRESHOLD) for r in rows)
    bad, good = [[r.predicted for r in rows if toxic[r.doc_id] == k] for k in (1, 0)]
    assert sum(bad) >= 0.9 * len(bad) and sum(good) <= 0.05 * len(good)
    again = toxicity.learn(docs.repartition(3), labels.repartition(2))
    assert np.allclose([r.score for r in sorted(toxicity.score(docs, again).collect())], [r.score for r in sorted(rows)], atol=1e-3)


def test_toxicity_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, toxicity.learn(docs, labels)).join(labels, "doc_id").withColumn("held", toxicity.held_out(F.col("doc_id"))).collect()
    clean = [r.predicted for r in rows if r.held and not r.toxic]
    assert sum(clean) <= 0.1 * len(clean)
    english = [r.score for r in rows if r.toxic]
    assert sorted(english)[len(english) // 2] > sorted(r.score for r in rows if not r.toxic)[int(0.9 * sum(not r.toxic for r in rows))]


def test_toxicity_of_odd_tables_and_labels(spark):
    docs, labels, _ = planted(spark, 200)
    model = toxicity.learn(docs.unionByName(odd_documents(spark)), labels.union(spark.createDataFrame([(None, 1), (5, None), (999, 1)], labels.schema)))
    odd = odd_documents(spark)
    scores = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert len(toxicity.score(odd, model).collect()) == odd.count() and scores[2] == scores[3] == scores[4]
    assert toxicity.score(empty_documents(spark), model).collect() == []
    assert toxicity.learn(docs, labels.where("toxic = 0")) is None and toxicity.learn(empty_documents(spark), labels) is None
    assert {(r.score, r.predicted) for r in toxicity.score(odd, None).collect()} == {(0.0, 0)}
