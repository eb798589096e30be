"""Change fold: FIXTURES goldens and a differential test of the closed form
against a plain sequential fold of the change rules."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from listing_engine.operators.changes import apply_changes, insert_new
from listing_engine.schemas import RAW

NOW = dt.datetime(2026, 1, 1)
T0 = dt.datetime(2025, 1, 1)


def _changes(spark, rows):
    return spark.createDataFrame(
        [(i, 0, k, t, T0 + dt.timedelta(minutes=i), d) for i, k, t, d in rows],
        "id long, pos int, inner_id string, change_type string, created_at timestamp_ntz, data string")


def _raw(spark, rows):
    return spark.createDataFrame(
        [(i, k, "added", T0, d, T0, T0, "initial_load", s, True) for i, k, d, s in rows], RAW)


def test_golden_change_page(spark):
    ch = _changes(spark, [
        (892145, "53685000", "added", json.dumps({"price": 8000, "mark": "Kia"})),
        (892146, "53692747", "changed", json.dumps({"new_price": 7500})),
        (892147, "53685231", "removed", "{}"),
    ])
    res = apply_changes(_raw(spark, []), ch, NOW)
    rows = {r.inner_id: r for r in res.table.collect()}
    assert json.loads(rows["53692747"].data) == {"new_price": 7500}   # inserted as is
    assert rows["53692747"].active_status == 0 and rows["53692747"].change_type == "changed"
    assert rows["53685231"].data == "{}" and rows["53685231"].active_status == 1
    st = res.stats.first().asDict()
    assert st == {"loaded": 3, "updated": 0, "removed": 0, "duplicates": 0, "errors": 0, "ignored": 0}


def test_merge_golden_on_existing(spark):
    raw = _raw(spark, [(1, "k", json.dumps({"price": 8000, "mark": "Kia", "year": 2020}), 0)])
    ch = _changes(spark, [(10, "k", "changed", json.dumps({"new_price": 7500}))])
    row = apply_changes(raw, ch, NOW).table.first()
    assert row.data == '{"price":7500,"mark":"Kia","year":2020}'
    assert row.is_processed is False and row.last_updated_at == NOW


# --- differential ------------------------------------------------------------------

# What an event does, by its type and whether its key has a row.
RULES = {
    ("added", False): "insert", ("changed", False): "insert", ("removed", False): "insert inactive",
    ("added", True): "duplicate", ("changed", True): "update", ("removed", True): "deactivate",
}
COUNTED = {"insert": "loaded", "insert inactive": "loaded", "duplicate": "duplicates", "deactivate": "removed"}


def _updated(base, change):
    """The base payload with the change laid over it, None if either can't be."""
    if not isinstance(change, dict) or not isinstance(base or {}, dict):
        return None
    return (base or {}) | {k.removeprefix("new_"): v for k, v in change.items()}


def _sequential(base, events):
    """The rules, one event at a time: (rows, counters)."""
    rows, stats = {k: dict(v) for k, v in base.items()}, dict.fromkeys(
        ("loaded", "updated", "removed", "duplicates", "errors", "ignored"), 0)
    for at, key, kind, text in sorted(events):
        action = RULES.get((kind, key in rows), "ignore") if key else "keyless"
        if action.startswith("insert"):
            inactive = action.endswith("inactive")
            rows[key] = dict(data={} if inactive else json.loads(text), status=int(inactive), ct=kind)
        elif action == "deactivate":
            rows[key].update(status=1, ct=kind)
        elif action == "update":
            merged = _updated(rows[key]["data"], json.loads(text))
            if merged is not None:
                rows[key].update(data=merged, ct=kind)
            action = "updated" if merged is not None else "failed"
        stats[COUNTED.get(action, {"updated": "updated", "ignore": "ignored"}.get(action, "errors"))] += 1
    return rows, stats


BASES = [{"price": 3, "mark": "m"}, {"price": 5}, {}, [], None, "", 0, [1, 2], "text", 7]
PAYLOADS = [{"price": 11}, {"new_price": 12}, {"km_age": 4}, {"new_price": 1, "price": 2}, {"price": 3, "new_price": 4},
            {"nested": {"a": 5}}, {"x": None}, [1, 2], "text"]


def test_closed_form_equals_sequential(spark):
    """300 random feeds over their own keys, folded in one run: bases of every
    JSON kind, rows without an id, keyless events, unknown types."""
    rng = random.Random(7)
    base, events = {}, []
    for case in range(300):
        keys = [f"{case}-{i}" for i in range(4)]
        for k in keys[:2]:
            base[k] = dict(data=rng.choice(BASES), status=rng.choice([0, 1]), ct="added")
        for _ in range(14):
            kind = rng.choice(["added", "changed", "changed", "removed", "other"])
            events.append((len(events), rng.choice([*keys, ""]), kind, json.dumps({} if kind == "removed" else rng.choice(PAYLOADS))))
    rows, stats = _sequential(base, events)
    raw = _raw(spark, [(None if j % 5 == 0 else 100 + j, k, json.dumps(v["data"]), v["status"]) for j, (k, v) in enumerate(base.items())])
    res = apply_changes(raw, _changes(spark, events), NOW)
    got = {r.inner_id: r for r in res.table.collect()}
    assert set(got) == set(rows)
    for k, v in rows.items():
        assert (json.loads(got[k].data), got[k].active_status, got[k].change_type) == (v["data"], v["status"], v["ct"]), k
    assert res.stats.first().asDict() == stats


def test_insert_new_first_wins(spark):
    raw = _raw(spark, [(1, "a", "{}", 0)])
    offers = _changes(spark, [(5, "b", None, '{"p":1}'), (3, "b", "added", '{"p":2}'), (4, "a", "added", "{}"),
                              (6, None, "added", "{}")])
    rows, stats = insert_new(raw, offers, NOW)
    got = rows.collect()
    assert [(r.inner_id, r.id, json.loads(r.data)) for r in got] == [("b", 3, {"p": 2})]
    assert stats.first().asDict() == {"loaded": 1, "skipped": 2, "errors": 1}
