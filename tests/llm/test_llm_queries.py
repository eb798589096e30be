"""The registered queries against DuckDB, and the pipeline against brute force."""

import hashlib
import os
import sys

import pytest
from llm_cases import WORD, brute_join, brute_substring

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import oracle_check as OC  # noqa: E402

import corpus_pipeline  # noqa: E402
from listing_engine.llm import bpe, mixing  # noqa: E402
from listing_engine.llm.queries import ORACLES, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_its_sql(spark, name):
    ok, msg = OC.compare(QUERIES[name](spark, SF), OC.duck(SF).sql(ORACLES[name]))
    assert ok, msg


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_a_row_for_each_document(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == list(range(200))


def test_registered_in_the_entry_module():
    import __spark_entry__ as entry
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stage_by_stage(spark):
    import public_tokenizers as public

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = docs.limit(1).selectExpr("100000L doc_id", "'12 34 .. 56' text", "lang", "source", "11L n_chars")
    first, join, dedup, mix, encode = (f for _, f in corpus_pipeline.STAGES)

    judged = first(spark, docs.union(extra), SF)
    assert judged.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(r.doc_id for r in judged.collect()) == list(range(200))  # only the text without letters goes

    rows = [(r.doc_id, r.text) for r in judged.collect()]
    joined = join(spark, judged, SF)
    assert sorted(r.doc_id for r in joined.collect()) == sorted({c for _, c, _ in brute_join(rows, 5)})

    rows = [(r.doc_id, r.text) for r in joined.collect()]
    texts = dict(rows)
    cut = dedup(spark, joined, SF).cache()
    want = {i: (text if gone else texts[i]) for i, _, gone, text in brute_substring(rows, 50) if not gone or text}
    assert {r.doc_id: r.text for r in cut.collect()} == want
    assert all(r.n_chars == len(r.text) for r in cut.collect())

    taken = {r.doc_id: r.copies for r in mixing.mix(cut).collect() if r.copies}
    mixed = mix(spark, cut, SF).cache()
    assert mixed.columns == list(corpus_pipeline.COLUMNS)
    assert sorted(r.doc_id for r in mixed.collect()) == sorted(i for i, n in taken.items() for _ in range(n))

    encoding = bpe._encoding(bpe._load_ranks(public.path("byte_bpe_50k.tiktoken")), public.PATTERN)
    for r in encode(spark, mixed, SF).collect():
        ids = encoding.encode_ordinary(want[r.doc_id])
        assert (r.n_tokens, r.decoded_sha256) == (len(ids), hashlib.sha256(want[r.doc_id].encode()).hexdigest())


def test_pipeline_of_awkward_and_empty_tables(spark):
    from llm_cases import empty_documents, odd_documents
    for frame, least in ((odd_documents(spark), 1), (empty_documents(spark), 0)):
        docs = frame
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
        assert docs.count() >= least
        assert WORD


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES if f is not corpus_pipeline.mix_sources])
def test_python_stage_bounds_its_batches(spark, stage):
    """A stage is given rows that anyone may have read."""
    from llm_cases import odd_documents
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(name)
    stage(spark, odd_documents(spark), SF)
    assert spark.conf.get(name) == "4m"
