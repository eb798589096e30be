"""Operators that deal documents and dialogues out."""

from collections import Counter

import pytest
from llm_cases import WORD, empty_documents, odd_documents, pairs_of
from pyspark.sql import functions as F

from listing_engine.llm import chat, mixing, sharding

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


# --- sharding

@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_even_and_slots_gapless(spark, docs, shards):
    for frame in (docs, odd_documents(spark)):
        rows = sharding.place(frame, shards).collect()
        assert len(rows) == frame.count()
        counts = Counter(r.shard for r in rows)
        sizes = [counts.get(s, 0) for s in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        for s in counts:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(counts[s]))


def test_shard_sizes_and_reruns(spark, docs):
    import zlib
    want = sorted((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in pairs_of(docs))
    rows = sharding.place(docs).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert sorted(map(tuple, rows)) == sorted(map(tuple, sharding.place(docs.repartition(5)).collect()))
    assert sharding.place(empty_documents(spark)).collect() == []


def test_a_repeated_row_is_spread(spark):
    frame = odd_documents(spark, [(1, "same", None, None)] * 90 + [(i, "x", None, None) for i in range(2, 60)])
    counts = Counter(r.shard for r in sharding.place(frame, 10).collect())
    assert max(counts.values()) - min(counts.values()) <= 1


def test_more_headroom_moves_fewer_rows(spark):
    frame = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    before, after = ({r.doc_id: r.shard for r in sharding.place(frame, s, headroom=0.25).collect()} for s in (20, 21))
    moved = sum(before[i] != after[i] for i in before)
    assert moved < 0.25 * len(before)
    assert max(Counter(after.values()).values()) <= -(-1.25 * len(after) // 21)


# --- mixing

def targets_by_steps(sizes, most=3):
    """Share by weight, cap, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    target, left, free = {s: 0.0 for s in names}, float(sum(sizes.values())), set(names)
    while left > 1e-6 and free:
        unit = left / sum(weight[s] for s in free)
        left = 0.0
        for s in list(free):
            target[s] += unit * weight[s]
            if target[s] >= most * sizes[s]:
                left += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                free.discard(s)
    return target


def test_a_split_unit_gives_the_same_texts_however_it_is_read(spark):
    rows = [(None, f"a b c d e f g h i w{k % 30}", None, "one") for k in range(41)] + [(k, "x y z", None, "two") for k in range(40)]
    seen = {tuple(sorted(r.text for r in mixing.apply(odd_documents(spark, rows).repartition(n)).collect())) for n in (3, 7)}
    assert len(seen) == 1


def test_mix_meets_its_targets(spark, docs):
    for frame in (docs, odd_documents(spark)):
        rows = mixing.mix(frame).collect()
        assert len(rows) == frame.count()
        sizes = Counter()
        for r in rows:
            sizes[r.source] += r.size
        assert Counter(r.size for r in rows) == Counter(len(WORD.findall(t or "")) for _, t in pairs_of(frame))
        want = targets_by_steps(sizes)
        for source in sizes:
            own = [r for r in rows if r.source == source]
            assert {r.source_size for r in own} == {sizes[source]}
            assert all(abs(r.target - want[source]) < 1e-3 for r in own)
            assert all(r.taken in {r.size * c for c in range(4)} for r in own)
            copies = {r.copies for r in own if r.size}
            assert not copies or max(copies) - min(copies) <= 1  # whole epochs first
            unit = max(Counter((r.doc_id, r.size) for r in own).values()) * max(r.size for r in own)
            assert abs(sum(r.taken for r in own) - want[source]) <= unit / 2 + 1e-6
        assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(frame.repartition(3)).collect()))


def test_mixed_corpus_has_every_copy(spark, docs):
    for frame in (docs, odd_documents(spark)):
        copies = Counter()
        for r in mixing.mix(frame).collect():
            copies[r.doc_id, r.size] += r.copies
        out = mixing.apply(frame)
        assert out.columns == frame.columns
        assert Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in out.collect()) == +copies
    assert mixing.mix(empty_documents(spark)).collect() == [] and mixing.apply(empty_documents(spark)).collect() == []


def test_better_documents_come_first(spark):
    good, poor = " ".join(f"w{i}" for i in range(40)), " ".join(["same"] * 40)
    rows = [(i, good if i % 2 else poor, "en", "a") for i in range(400)] + [(1000, good * 200, "en", "b")]
    taken = [r for r in mixing.mix(odd_documents(spark, rows)).collect() if r.source == "a" and r.copies]
    assert sum(r.doc_id % 2 for r in taken) > 0.6 * len(taken)


def test_a_unit_on_the_edge_is_split(spark):
    rows = [(None, "one two three four", "en", "a")] * 40 + [(1, "w " * 400, "en", "b"), (2, "x y", "en", "b")]
    frame = odd_documents(spark, rows)
    taken = Counter()
    for r in mixing.mix(frame).collect():
        taken[r.source] += r.taken
        if r.source == "a":
            target, size = r.target, r.size
    # 40 equal rows without an id, whose target is no multiple of them all.
    assert target % 160 and abs(taken["a"] - target) <= size / 2 + 1e-6
    assert 4 * sum(r.source == "a" for r in mixing.apply(frame).collect()) == taken["a"]


# --- chat

def test_every_participant_gets_the_whole_dialogue(spark):
    talk = spark.read.parquet(f"{SF}/conversations.parquet")
    turns = {}
    for r in talk.orderBy("conv_id", "turn").collect():
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    blocks = {(r.conv_id, r.perspective): r for r in chat.render(chat.segments(talk)).collect()}
    assert set(blocks) == {(c, role) for c, said in turns.items() for role, _ in said}
    for (conv, who), r in blocks.items():
        want, spans = "", []
        for role, text in turns[conv]:
            want += "<|assistant|>\n" if role == who else f"<|user name={role}|>\n"
            if role == who:
                spans.append((len(want), len(want) + len(text) + 7))
            want += text + "<|end|>\n"
        assert r.dialogue == want and list(map(tuple, r.train_spans)) == spans


def test_odd_dialogues(spark):
    rows = [(1, 0, "a", "hi"), (1, 0, "a", "hi"), (1, None, "b", None), (1, 1, None, "x<|end|>"), (None, 5, "a", "é"),
            (2, 700, "a", "late"), (2, 3, "b", "early")]
    talk = spark.createDataFrame([(*r, "k", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, slice int")
    out = chat.segments(talk)
    for (conv, who) in {(r.conv_id, r.perspective) for r in out.collect()}:
        own = sorted((r.start, r.segment) for r in out.collect() if (r.conv_id, r.perspective) == (conv, who))
        at = 0
        for start, segment in own:
            assert start == at
            at += len(segment)
        assert len(own) == sum(r[0] == conv for r in rows)
    assert out.where(F.col("segment").contains("x<|end|>")).count() == 0
    assert chat.segments(talk.limit(0)).collect() == []
