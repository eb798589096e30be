"""Normaliser goldens (FIXTURES §4, §5) on literal payloads."""

import json

from pyspark.sql import functions as F

from listing_engine.operators.normalise import normalise_rows
from listing_engine.plans.adapters import SNAPSHOT_TIME


def _raw(spark, payloads):
    rows = [(i, f"k{i}", "added", SNAPSHOT_TIME, p if isinstance(p, str) else json.dumps(p, ensure_ascii=False),
             SNAPSHOT_TIME, SNAPSHOT_TIME, "t", 0, False) for i, p in enumerate(payloads)]
    from listing_engine.schemas import RAW
    return spark.createDataFrame(rows, RAW)


def _dict(spark, pairs):
    return spark.createDataFrame(pairs, "cn string, ru string")


CFG = {"paramtypeitems": [{"paramitems": [
    {"id": "93", "name": "驱动方式", "value": "前驱"},
    {"id": 91, "name": "a", "value": "b"},
    {"id": 93.0, "name": "skip", "value": "skip"},
    {"id": "x", "name": "skip", "value": "skip"},
    {"id": 999, "name": "skip", "value": "skip"},
    {"id": 93, "value": "后驱"},
]}]}


def test_normalise_goldens(spark):
    payloads = [
        {"mark": "大通", "model": "", "price": "8,000", "year": "2020", "color": 0,
         "extra": {"option": {"displayopts": [{"optionname": "天窗"}, {"optionname": "Люк"}, {"optionname": ""}],
                              "moreoptions": [{"opts": [{"optionname": "天窗"}, {"optionname": "导航"}]}]}},
         "configuration": CFG, "images": "[\"a\"]", "first_registration": "2019-02"},
        {"mark": "Kia", "year": 1899},                      # rejected: year
        "[1, 2]",                                           # quarantined: not an object
        {"mark": "X", "extra": {"option": {"displayopts": [5]}}},  # quarantined: entry type
        {"mark": "Y", "configuration": {"engine": "x"}},    # flat configuration -> NULL
        {"mark": "Z", "price": "0", "year": "0"},           # zero kept, not validated
    ]
    d = _dict(spark, [("大通", "Maxus"), ("天窗", "Люк"), ("前驱", "Передний"), ("后驱", "Задний")])
    n = normalise_rows(_raw(spark, payloads), d, current_year=2026)
    rows = {r.inner_id: r for r in n.rows.collect()}
    rej = {r.inner_id: r.reason for r in n.rejected.collect()}
    assert rej == {"k1": "year", "k2": "payload_not_object", "k3": "option_entry_type"}
    r0 = rows["k0"]
    assert (r0.mark, r0.model, r0.color, r0.price, r0.year) == ("Maxus", None, None, 8000, 2020)
    assert r0.options == ["Люк", "导航"]
    assert r0.configuration == {"93": {"name": "", "value": "Задний"}, "91": {"name": "a", "value": "b"}} or \
        dict(r0.configuration) == {"93": ("", "Задний"), "91": ("a", "b")}
    assert r0.images == ["a"]
    assert str(r0.first_registration) == "2019-02-01"
    assert rows["k4"].configuration is None
    assert (rows["k5"].price, rows["k5"].year) == (0, 0)


def test_each_text_is_translated_once(spark, tmp_path):
    """The hook appends every text it is given to a file of its own task."""
    import pandas as pd
    from listing_engine.plans import jobs as J
    calls = str(tmp_path)

    def hook(texts: pd.Series) -> pd.Series:
        import uuid
        with open(f"{calls}/{uuid.uuid4().hex}", "w", encoding="utf-8") as f:
            f.write("\n".join(texts))
        return texts.map(lambda t: "T" + t if t != "坏" else 1 / 0)

    mined = spark.createDataFrame([("mark", "红", 3), ("color", "红", 1), ("mark", "蓝", 1), ("address", "坏", 1)], "field string, text string, count long")
    entries, counts = J.translate_texts(mined, hook)
    assert entries.count() == 4
    row = counts.first()
    assert row.translated + row.skipped + row.error == 4
    seen = [t for f in tmp_path.iterdir() for t in f.read_text(encoding="utf-8").split("\n")]
    assert seen.count("红") <= 2 and {r.text: r.translation for r in entries.collect()}["坏"] == "坏"


def test_a_failing_step_does_not_end_the_loop(spark):
    from listing_engine.plans import adapters as A, catalog as C, jobs as J
    import listing_engine.schemas as SC
    raw = A.snapshot_raw(spark, "/root/testdata/sf0.001")

    def broken(texts):
        raise SystemError("no service")

    res = J.enrich(raw, spark.createDataFrame([], SC.FLAT), A.seed_dictionary(spark), broken, A.RUN_TIME, C.CURRENT_YEAR, max_iterations=1)
    assert not res.converged and len(res.rounds) == 1
