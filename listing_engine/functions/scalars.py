"""Column functions over listing payloads.

Every function returns a native Column expression, so the projections stay
inside whole-stage codegen.  Payloads are JSON text parsed into
`MAP<STRING, VARIANT>`; one field of it is a VARIANT `v`.

Python truthiness decides much of the reference behaviour (null, "", 0, 0.0,
false, [] and {} are "falsy"); it lives in exactly one helper, `falsy`.
"""

from __future__ import annotations

import datetime as dt
import functools
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Character classes built from a rule (Unicode properties), not from a table.
# `str.isdigit` keeps characters whose numeric type is Decimal or Digit;
# only Decimal ones convert with int()/float(), so a kept Digit-only
# character (superscripts, circled digits) makes the conversion fail.
# ---------------------------------------------------------------------------


def _ranges(codepoints: list[int]) -> str:
    out, start, prev = [], None, None
    for cp in codepoints:
        if start is None:
            start = prev = cp
        elif cp == prev + 1:
            prev = cp
        else:
            out.append((start, prev))
            start = prev = cp
    if start is not None:
        out.append((start, prev))
    return "".join(
        f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in out
    )


@functools.lru_cache(maxsize=1)
def _digit_tables() -> dict[str, str]:
    decimal, digit_only = [], []
    src, dst = [], []
    for cp in range(sys.maxunicode + 1):
        ch = chr(cp)
        if ch.isdecimal():
            decimal.append(cp)
            if cp > 0x7F:
                src.append(ch)
                dst.append(str(unicodedata.decimal(ch)))
        elif ch.isdigit():
            digit_only.append(cp)
    return {
        "keep": _ranges(sorted(decimal + digit_only)),
        "keep_ascii": "0-9" + _ranges(digit_only),
        "digit_only": _ranges(digit_only),
        "from": "".join(src),
        "to": "".join(dst),
    }


def _ascii_digits(s: Column) -> Column:
    t = _digit_tables()
    return F.translate(s, t["from"], t["to"])


def _kept_digits(s: Column, also: str = "") -> Column:
    """The digit characters of a text (and `also`).  Most texts are ASCII,
    which their byte count shows; only others need the Unicode tables: decimal
    digits to ASCII first, so the filter's character class stays small."""
    t = _digit_tables()
    return F.when(F.octet_length(s) == F.length(s), F.regexp_replace(s, f"[^0-9{also}]", "")).otherwise(
        F.regexp_replace(_ascii_digits(s), f"[^{t['keep_ascii']}{also}]", ""))


# ---------------------------------------------------------------------------
# B0 payload parse and VARIANT helpers
# ---------------------------------------------------------------------------


def payload(data: Column | str) -> Column:
    """JSON text -> MAP<STRING, VARIANT>; a later duplicate key wins (needs
    mapKeyDedupPolicy=LAST_WIN).  Not an object, broken JSON, or a duplicate
    key inside a nested object -> NULL (the row is quarantined)."""
    data = F.col(data) if isinstance(data, str) else data
    parsed = F.from_json(data, "map<string,variant>")
    return F.transform_keys(parsed, lambda k, v: k)


def vkind(v: Column) -> Column:
    """missing | null | string | number | bool | array | object.

    Objects and non-empty arrays are recognised in O(1) (a cast to an empty
    struct, a probe of element 0), so `schema_of_variant` -- which walks a
    whole nested value -- only ever sees scalars and empty arrays."""
    t = F.schema_of_variant(v)
    return (
        F.when(v.isNull(), F.lit("missing"))
        .when(F.is_variant_null(v), F.lit("null"))
        .when(F.try_variant_get(v, "$", "struct<>").isNotNull(), F.lit("object"))
        .when(F.try_variant_get(v, "$[0]", "variant").isNotNull(), F.lit("array"))
        .when(t == "STRING", F.lit("string"))
        .when(t == "BOOLEAN", F.lit("bool"))
        .when(t.startswith("ARRAY"), F.lit("array"))
        .otherwise(F.lit("number"))
    )


def with_fields(df, payload_col: str, fields: list[str]):
    """Add `v_<f>` (the field's VARIANT) and `k_<f>` (its `vkind`) columns in
    one projection, so later expressions that test the kind several times
    read a column instead of re-deriving it."""
    m = F.col(payload_col)
    return df.select("*", *[m[f].alias(f"v_{f}") for f in fields], *[vkind(m[f]).alias(f"k_{f}") for f in fields])


def with_numbers(df, numbers: dict[str, str], data: str = "data", as_type: str = "int", new_keys: bool = False):
    """Add `digits_int` columns (name -> payload field) of the JSON text `data`.

    The payload is parsed in one projection and each field picked in the next;
    both are read more than once above, so the optimizer keeps them apart and
    parses a payload once.  With `new_keys` a `new_` prefix is dropped first."""
    m = payload(data)
    parsed = df.withColumn("_m", F.transform_keys(m, lambda k, v: F.regexp_replace(k, "^new_", "")) if new_keys else m)
    picked = with_fields(parsed, "_m", list(numbers.values()))
    made = {out: digits_int(F.col(f"v_{f}"), F.col(f"k_{f}")).try_cast(as_type) for out, f in numbers.items()}
    return picked.withColumns(made).drop("_m", *[f"{p}_{f}" for f in numbers.values() for p in "vk"])


def ntz(value) -> Column:
    """A wall-clock TIMESTAMP_NTZ literal (or the column as is).  Built from
    ISO text, so neither the Python process zone nor the session zone can
    shift it (a `lit(datetime)` goes through an instant first)."""
    if isinstance(value, Column):
        return value
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def vstr(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def falsy(v: Column, k: Column | None = None) -> Column:
    """Python truthiness of a JSON value: null, "", 0, false, [] and {}.
    `k` is the value's `vkind`, when the caller already has it."""
    k = vkind(v) if k is None else k
    return (
        F.when(k.isin("missing", "null"), F.lit(True))
        .when(k == "string", vstr(v) == F.lit(""))
        .when(k == "number", F.try_variant_get(v, "$", "double") == F.lit(0.0))
        .when(k == "bool", ~F.try_variant_get(v, "$", "boolean"))
        .when(k == "array", F.size(F.try_variant_get(v, "$", "array<variant>")) == 0)
        .when(k == "object", F.size(F.try_variant_get(v, "$", "map<string,variant>")) == 0)
        .otherwise(F.lit(False))
    )


# ---------------------------------------------------------------------------
# B1 / B2 text fields
# ---------------------------------------------------------------------------


def pass_text(v: Column) -> Column:
    """B1: copied untouched (as text)."""
    return vstr(v)


def guarded_text(v: Column, k: Column | None = None) -> Column:
    """B2 before the lookup: falsy -> NULL, else the value as text."""
    return F.when(falsy(v, k), F.lit(None).cast("string")).otherwise(vstr(v))


# ---------------------------------------------------------------------------
# B3 / B4 numbers
# ---------------------------------------------------------------------------

def _toward_zero(x: Column) -> Column:
    return F.when(x >= 0, F.floor(x)).otherwise(F.ceil(x)).cast("double")


def digits_int(v: Column, k: Column | None = None) -> Column:
    """Year, price, km_age, power -> DOUBLE holding an integer.

    Strings keep only digit characters (so '.', '-' and ',' vanish), numbers
    truncate toward zero, `true` is 1, anything else is NULL.  After the
    filter only digits remain, so one `try_cast` covers the rest: empty ->
    NULL, a kept digit-only character such as '²' -> NULL (as int() fails),
    and an oversized number stays huge, so range validation rejects the row
    (the reference rejects, it does not null)."""
    k = vkind(v) if k is None else k
    digits = _kept_digits(vstr(v))
    return (
        F.when(falsy(v, k), F.lit(None).cast("double"))
        .when(k == "string", digits.try_cast("double"))
        .when(k == "number", _toward_zero(F.try_variant_get(v, "$", "double")))
        .when(k == "bool", F.lit(1.0))
        .otherwise(F.lit(None).cast("double"))
    )


def digits_float(v: Column, k: Column | None = None) -> Column:
    """Displacement; digits and '.' kept; two dots or a lone dot -> NULL
    (the cast of such text fails)."""
    k = vkind(v) if k is None else k
    kept = _kept_digits(vstr(v), ".")
    return (
        F.when(falsy(v, k), F.lit(None).cast("double"))
        .when(k == "string", kept.try_cast("double"))
        .when(k == "number", F.try_variant_get(v, "$", "double"))
        .when(k == "bool", F.lit(1.0))
        .otherwise(F.lit(None).cast("double"))
    )


# ---------------------------------------------------------------------------
# B5 dates, B10 event time
# ---------------------------------------------------------------------------


def flex_date_str(s: Column) -> Column:
    """`YYYY-MM` gets day 01; then strict `%Y-%m-%d` (1-2 digit month/day)."""
    padded = F.when(
        (F.length(s) == 7) & (F.substring(s, 5, 1) == "-"), F.concat(s, F.lit("-01"))
    ).otherwise(s)
    return F.when(
        padded.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"),
        F.try_to_date(padded, "yyyy-M-d"),
    )


def flex_date(v: Column, k: Column | None = None) -> Column:
    """B5 over a VARIANT: falsy or non-string -> NULL."""
    k = vkind(v) if k is None else k
    return F.when((k == "string") & ~falsy(v, k), flex_date_str(vstr(v)))


_OFFSET = r"(Z|z|[+-][0-9]{2}(:?[0-9]{2})?)$"


def event_time(s: Column, now) -> Column:
    """ISO-8601 text -> TIMESTAMP_NTZ in UTC; offsets are converted,
    missing or unparseable -> `now` (a parameter, never the wall clock)."""
    now_col = ntz(now)
    # From the instant itself: by way of the session's wall clock, the hour that
    # a zone repeats in autumn would be read twice.
    seconds = (F.unix_micros(s.try_cast("timestamp")).cast("decimal(24,6)") / 1_000_000).cast("decimal(18,6)")
    epoch = ntz(dt.datetime(1970, 1, 1))
    with_zone = epoch + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)
    naive = s.try_cast("timestamp_ntz")
    parsed = F.when(s.rlike(_OFFSET), with_zone).otherwise(naive)
    return F.coalesce(parsed, now_col)


# ---------------------------------------------------------------------------
# B6 images, B7 options, B8 configuration
# ---------------------------------------------------------------------------

def _empty_strings() -> Column:
    return F.array().cast("array<string>")


def image_list(v: Column, k: Column | None = None) -> Column:
    """List as is; JSON text of a list parsed; anything else []."""
    k = vkind(v) if k is None else k
    return (
        F.when(falsy(v, k), _empty_strings())
        .when(k == "array", F.coalesce(F.try_variant_get(v, "$", "array<string>"), _empty_strings()))
        .when(k == "string", F.coalesce(F.from_json(vstr(v), "array<string>"), _empty_strings()))
        .otherwise(_empty_strings())
    )


def _bad_shape(v: Column) -> Column:
    """An entry the reference indexes like an object but that is a number,
    a boolean or null (it raises, and the row is quarantined)."""
    return vkind(v).isin("number", "bool", "null")


def _entry(o: Column) -> Column:
    return F.struct(_bad_shape(o).alias("bad"), F.try_variant_get(o, "$.optionname", "variant").alias("nv"))


def option_entries(extra: Column) -> tuple[Column, Column]:
    """(display entries, groups) of `extra.option`, each entry a struct
    (bad, nv): its shape flag and its `optionname` VARIANT.  Both the option
    list (B7) and the quarantine checks (C4) read these, so the option
    arrays are walked once."""
    empty = F.array().cast("array<variant>")
    display = F.coalesce(F.try_variant_get(extra, "$.option.displayopts", "array<variant>"), empty)
    groups = F.coalesce(F.try_variant_get(extra, "$.option.moreoptions", "array<variant>"), empty)
    d = F.transform(display, _entry)
    g = F.transform(groups, lambda grp: F.struct(
        _bad_shape(grp).alias("bad"),
        F.transform(F.coalesce(F.try_variant_get(grp, "$.opts", "array<variant>"), empty), _entry).alias("opts")))
    return d, g


def option_used(extra: Column, extra_kind: Column, option: Column, option_kind: Column) -> Column:
    """`extra` is an object and `extra.option` is truthy."""
    return (extra_kind == "object") & ~falsy(option, option_kind)


def _names(entries: Column) -> Column:
    """optionname of every entry, falsy ones dropped, as text."""
    return F.transform(F.filter(entries, lambda e: ~falsy(e["nv"])), lambda e: vstr(e["nv"]))


def option_names_of(display: Column, groups: Column, used: Column) -> Column:
    """B7 from `option_entries`: displayopts then moreoptions[].opts names,
    in order, duplicates kept (removed after translation)."""
    more = F.flatten(F.transform(groups, lambda g: _names(g["opts"])))
    return F.when(used, F.concat(_names(display), more)).otherwise(_empty_strings())


# Configuration parameter ids the normaliser keeps, as given
# by the reference data model.
CONFIG_PARAM_IDS = (93, 91, 90, 88, 116, 101, 108, 92, 115, 97, 95, 38, 58, 3, 13, 6, 11, 14,
                    17, 20, 24, 23, 41, 40, 42, 46, 43, 44, 47, 48, 49, 50, 53)


def _param_id(v: Column, schema: Column) -> Column:
    """int or int-like text (Python `int(str)` rules); others NULL.  `schema`
    is the value's `schema_of_variant`."""
    text = F.regexp_replace(_ascii_digits(F.trim(vstr(v))), r"(?<=[0-9])_(?=[0-9])", "")
    digits = F.regexp_replace(text, r"^([+-]?)0+(?=[0-9])", "$1")
    from_text = F.when(text.rlike(r"^[+-]?[0-9]+$"), digits.try_cast("bigint"))
    return F.when(schema == "STRING", from_text).when(schema == "BIGINT", F.try_variant_get(v, "$", "bigint")).when(
        schema == "BOOLEAN", F.try_variant_get(v, "$", "boolean").cast("bigint"))


def _param_text(v: Column) -> Column:
    """`param.get(key, '')`: missing -> '', JSON null -> NULL, else text."""
    return F.when(v.isNull(), F.lit("")).when(F.is_variant_null(v), F.lit(None).cast("string")).otherwise(vstr(v))


def config_source(top: Column, top_kind: Column, extra_kind: Column, nested: Column, nested_kind: Column) -> Column:
    """`configuration`, else `extra.configuration` when extra is an object."""
    return (
        F.when(~falsy(top, top_kind), top)
        .when((extra_kind == "object") & (~falsy(nested, nested_kind)), nested)
    )


def config_items(cfg: Column) -> Column:
    """The parameters (objects) of a configuration in document order, as
    ARRAY<STRUCT<id, name, value VARIANT>>.  Each value is picked here once;
    a variant read inside a lambda would be picked anew at each mention."""
    types = F.coalesce(F.try_variant_get(cfg, "$.paramtypeitems", "array<variant>"),
                       F.array().cast("array<variant>"))
    items = F.flatten(F.transform(types, lambda p: F.coalesce(
        F.try_variant_get(p, "$.paramitems", "array<variant>"), F.array().cast("array<variant>"))))
    objects = F.filter(items, lambda it: F.try_variant_get(it, "$", "struct<>").isNotNull())
    return F.transform(objects, lambda it: F.struct(*[
        F.try_variant_get(it, f"$.{key}", "variant").alias(key) for key in ("id", "name", "value")]))


def config_entries(items: Column, ids=CONFIG_PARAM_IDS) -> Column:
    """B8 before translation: ARRAY<STRUCT<id STRING, name, value>> in
    document order, only wanted ids, repeats kept (last one wins later)."""
    typed = F.transform(items, lambda it: F.struct(it.alias("item"), F.schema_of_variant(it["id"]).alias("schema")))
    entries = F.transform(typed, lambda e: F.struct(_param_id(e["item"]["id"], e["schema"]).alias("id"), e["item"].alias("item")))
    wanted = F.filter(entries, lambda e: e["id"].isin(list(ids)))
    return F.transform(wanted, lambda e: F.struct(
        e["id"].cast("string").alias("id"), _param_text(e["item"]["name"]).alias("name"),
        _param_text(e["item"]["value"]).alias("value")))


def config_map(entries: Column) -> Column:
    """Entries -> MAP<id, STRUCT<name, value>>; repeat id keeps its first
    position and last value (LAST_WIN); empty -> NULL."""
    m = F.map_from_entries(F.transform(entries, lambda e: F.struct(
        e["id"], F.struct(e["name"].alias("name"), e["value"].alias("value")))))
    return F.when(F.size(entries) > 0, m)


# ---------------------------------------------------------------------------
# B9 Han test, B11 / B12 merge
# ---------------------------------------------------------------------------

HAN_CLASS = "[\\u4e00-\\u9fff]"


def has_han(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.rlike(HAN_CLASS), F.lit(False))


def map_new_keys(m: Column) -> Column:
    """Drop one leading `new_` from every top-level key."""
    return F.transform_keys(m, lambda k, v: F.regexp_replace(k, "^new_", ""))


def merge_payload(old: Column, new: Column) -> Column:
    """Shallow merge; later values (and nulls) overwrite."""
    return F.map_concat(old, map_new_keys(new))


# ---------------------------------------------------------------------------
# B14 priority, B15 acceptance, B16 entry check
# ---------------------------------------------------------------------------

# Fields whose untranslated texts are ranked higher.
HOT_FIELDS = ("mark", "model", "options", "engine_type", "transmission_type", "body_type")


def priority(field: Column, n: Column) -> Column:
    hot = field.isin(*HOT_FIELDS)
    return (
        F.when(hot & (n >= 10), F.lit("high"))
        .when(hot | (n >= 10), F.lit("medium"))
        .otherwise(F.lit("low"))
    )


def accept_translation(field: Column, cn: Column, ru: Column) -> Column:
    """Keep a machine translation when it is not blank and differs from
    the source, or is an address, or has anything besides Han, blanks and
    `,，。、`."""
    not_blank = ru.isNotNull() & (F.regexp_replace(ru, r"(?U)\s", "") != "")
    other_chars = F.length(F.regexp_replace(ru, r"(?U)[\u4e00-\u9fff\s,，。、]", "")) > 0
    return F.coalesce(not_blank & ((ru != cn) | (field == "address") | other_chars), F.lit(False))


def entry_error(cn: Column, ru: Column) -> Column:
    """NULL for a valid dictionary entry, else the reason."""
    return (
        F.when(cn.isNull() | (cn == ""), F.lit("empty_cn"))
        .when(ru.isNull() | (ru == ""), F.lit("empty_ru"))
        .when(~has_han(cn), F.lit("cn_without_han"))
    )


# ---------------------------------------------------------------------------
# B17 record defaults, J8 seller flags
# ---------------------------------------------------------------------------


def default_change_type(c: Column) -> Column:
    return F.coalesce(c, F.lit("added"))


def default_payload(c: Column) -> Column:
    return F.coalesce(c, F.lit("{}"))


def truthy_flag(v: Column) -> Column:
    """`true`, `1` or `yes` (any case) -> true."""
    return F.coalesce(F.lower(vstr(v)).isin("true", "1", "yes"), F.lit(False))
