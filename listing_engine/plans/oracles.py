"""DuckDB SQL computing, straight from the driver tables, what each catalog
query must return.  The adapter rules are re-derived here in plain SQL, so a
match checks the Spark operators, not a shared code path."""

from __future__ import annotations

from .adapters import FLAG_HAN, LINE_PARAM_ID, SEED_DICTIONARY, STATUS_HAN, TYPE_HAN, WORD_HAN

MINING_DICT = dict(SEED_DICTIONARY) | {"小型": "Малый"}
SEED = dict(SEED_DICTIONARY)
HAN = "'[一-鿿]'"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _case(expr: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in mapping.items())
    return f"(CASE {expr} {whens} ELSE {default if default is not None else expr} END)"


def T(expr: str, d: dict = SEED) -> str:
    return _case(expr, d)


TYPE = _case("p_type", TYPE_HAN)
W1 = "split_part(p_name, ' ', 1)"
W2 = "split_part(p_name, ' ', 2)"
WORD1 = _case(W1, WORD_HAN)
WORD2 = _case(W2, WORD_HAN)
ADDRESS = "(CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN '上海' ELSE '北京' END)"

# Part snapshot after normalisation with the seed dictionary.
PARTS_FLAT = f"""
  SELECT CAST(p_partkey AS VARCHAR) AS inner_id, p_partkey, p_brand AS mark, {T(TYPE)} AS model,
         CAST(2000 + p_size % 25 AS INTEGER) AS year, {T(WORD1)} AS color, {ADDRESS} AS address,
         CAST(round(p_retailprice * 10) AS INTEGER) AS price, CAST(p_size * 1000 AS INTEGER) AS km_age,
         CAST(p_size * 10 AS INTEGER) AS power, p_size / 10.0 AS displacement,
         make_date(2023, p_size % 12 + 1, 1) AS first_registration,
         {T(WORD1)} AS o1, {T(WORD2)} AS o2, p_type, p_size, p_name
  FROM part"""

# Winning configuration line per (order, id): id 93 from lines 1 and 6
# (last wins), 91 from line 2, 88 from line 5 (as text "88"); line 3
# (90.0), 4 (999) and 7 ("x") are dropped.  The data repeats line numbers
# inside an order; the adapter orders items by (line number, item text), and
# the item text orders by the Han name, then the Han value.
_KEEP = {k: v.strip('"') for k, v in LINE_PARAM_ID.items() if k in (1, 2, 5, 6)}
CONFIG_ROWS = f"""
  SELECT l_orderkey, param_id, {T(_case('l_returnflag', FLAG_HAN))} AS name,
         {T(_case('l_linestatus', STATUS_HAN))} AS value
  FROM (
    SELECT *, {_case('CAST(l_linenumber AS VARCHAR)', {str(k): v for k, v in _KEEP.items()}, 'NULL')} AS param_id,
           row_number() OVER (PARTITION BY l_orderkey,
             {_case('CAST(l_linenumber AS VARCHAR)', {str(k): v for k, v in _KEEP.items()}, 'NULL')}
             ORDER BY l_linenumber DESC, {_case('l_returnflag', FLAG_HAN)} DESC,
                      {_case('l_linestatus', STATUS_HAN)} DESC) AS rn
    FROM lineitem
  ) WHERE param_id IS NOT NULL AND rn = 1"""

_CHANGES_TEMPLATE = """
  ch AS (
    SELECT event_id AS id,
           CAST(user_id * 20 + event_id % 20 AS VARCHAR) AS inner_id,
           event_type,
           CASE WHEN event_type = 'signup' THEN 'added'
                WHEN event_type IN ('purchase', 'view') THEN 'changed'
                WHEN event_type = 'error' THEN 'removed' END AS ct,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           ts
    FROM events WHERE event_type IN ('signup', 'purchase', 'view', 'error')
  ),
  base AS (
    SELECT CAST(p_partkey AS VARCHAR) AS inner_id,
           CAST(round(p_retailprice * 10) AS BIGINT) AS price,
           CAST(p_size * 1000 AS BIGINT) AS km_age
    FROM part __BASE_FILTER__
  ),
  first_ev AS (
    SELECT inner_id, min(id) AS fid, arg_min(event_type, id) AS fe, arg_min(k, id) AS fk
    FROM ch GROUP BY inner_id
  ),
  after_base AS (
    SELECT ch.* FROM ch JOIN first_ev f USING (inner_id)
    WHERE ch.inner_id IN (SELECT inner_id FROM base) OR ch.id > f.fid
  ),
  agg AS (
    SELECT inner_id,
           arg_max(k * 1000, id) FILTER (WHERE event_type = 'purchase') AS last_price,
           arg_max(k * 100, id) FILTER (WHERE event_type = 'view') AS last_km,
           arg_max(ct, id) FILTER (WHERE ct IN ('changed', 'removed')) AS last_ct,
           bool_or(ct = 'removed') AS any_removed,
           bool_or(ct IN ('changed', 'removed')) AS modified
    FROM after_base GROUP BY inner_id
  ),
  keys AS (SELECT inner_id FROM base UNION SELECT inner_id FROM ch),
  folded AS (
    SELECT keys.inner_id, b.inner_id IS NOT NULL AS existed, f.fid, f.fe,
      -- a payload value of 0 is falsy for the normaliser: NULL
      CAST(NULLIF(COALESCE(a.last_price, CASE WHEN b.inner_id IS NOT NULL THEN b.price
                                       WHEN f.fe = 'signup' THEN f.fk * 1000 END), 0) AS INTEGER) AS price,
      CAST(NULLIF(COALESCE(a.last_km, CASE WHEN b.inner_id IS NOT NULL THEN b.km_age
                                    WHEN f.fe IN ('signup', 'view') THEN f.fk * 100 END), 0) AS INTEGER) AS km_age,
      CAST(CASE WHEN COALESCE(a.any_removed, false) OR (b.inner_id IS NULL AND f.fe = 'error') THEN 1 ELSE 0 END
           AS INTEGER) AS active_status,
      COALESCE(a.last_ct, CASE WHEN b.inner_id IS NOT NULL THEN 'added'
                               WHEN f.fe = 'signup' THEN 'added'
                               WHEN f.fe = 'error' THEN 'removed' ELSE 'changed' END) AS change_type,
      b.inner_id IS NULL OR COALESCE(a.modified, false) AS modified
    FROM keys
    LEFT JOIN base b ON b.inner_id = keys.inner_id
    LEFT JOIN first_ev f ON f.inner_id = keys.inner_id
    LEFT JOIN agg a ON a.inner_id = keys.inner_id
  )"""

_CHANGES = _CHANGES_TEMPLATE.replace("__BASE_FILTER__", "")
_CHANGES_NO_BASE = _CHANGES_TEMPLATE.replace("__BASE_FILTER__", "WHERE false")

# Untranslated texts of the mining input (parts + orders), one row per
# occurrence, with the mining dictionary's known flag.
_MINED = f"""
  parts AS ({PARTS_FLAT}),
  cfg AS ({CONFIG_ROWS}),
  occ AS (
    SELECT 'mark' AS field, mark AS text FROM parts
    UNION ALL SELECT 'model', model FROM parts
    UNION ALL SELECT 'color', color FROM parts
    UNION ALL SELECT 'address', address FROM parts
    UNION ALL SELECT 'options', o1 FROM parts
    UNION ALL SELECT 'options', o2 FROM parts
    UNION ALL SELECT 'configuration.' || param_id || '.name', name FROM cfg
    UNION ALL SELECT 'configuration.' || param_id || '.value', value FROM cfg
  ),
  mined AS (
    SELECT field, text, CAST(count(*) AS BIGINT) AS count,
           text IN ({", ".join(_q(k) for k in MINING_DICT)}) AS known
    FROM occ WHERE regexp_matches(text, {HAN}) GROUP BY field, text
  ),
  new_entries AS (
    SELECT field, text, count,
           CASE WHEN field IN ('mark', 'model', 'options', 'engine_type', 'transmission_type', 'body_type')
                     AND count >= 10 THEN 'high'
                WHEN field IN ('mark', 'model', 'options', 'engine_type', 'transmission_type', 'body_type')
                     OR count >= 50 THEN 'medium'
                WHEN count >= 10 THEN 'medium' ELSE 'low' END AS priority
    FROM mined WHERE NOT known AND count >= 1
  )"""

ORACLES: dict[str, str] = {}

ORACLES["q01_change_fold"] = f"""
WITH {_CHANGES}
SELECT inner_id, price, km_age, active_status, change_type FROM folded
"""

ORACLES["q02_change_stats"] = f"""
WITH {_CHANGES}
SELECT
  CAST((SELECT count(*) FROM folded WHERE NOT existed) AS BIGINT) AS loaded,
  CAST((SELECT count(*) FROM ch JOIN folded USING (inner_id)
        WHERE ch.ct = 'changed' AND (existed OR ch.id <> fid)) AS BIGINT) AS updated,
  CAST((SELECT count(*) FROM ch JOIN folded USING (inner_id)
        WHERE ch.ct = 'removed' AND (existed OR ch.id <> fid)) AS BIGINT) AS removed,
  CAST((SELECT count(*) FROM ch JOIN folded USING (inner_id)
        WHERE ch.ct = 'added' AND (existed OR ch.id <> fid)) AS BIGINT) AS duplicates,
  CAST(0 AS BIGINT) AS errors,
  CAST((SELECT count(*) FROM events WHERE event_type NOT IN ('signup', 'purchase', 'view', 'error'))
       AS BIGINT) AS ignored
"""

ORACLES["q03_stats_by_day"] = f"""
WITH {_CHANGES},
  outcome AS (
    SELECT CAST(e.ts AS DATE) AS day,
      CASE WHEN e.event_type NOT IN ('signup', 'purchase', 'view', 'error') THEN 'ignored'
           WHEN NOT f.existed AND e.event_id = f.fid THEN 'loaded'
           WHEN e.event_type = 'signup' THEN 'duplicate'
           WHEN e.event_type = 'error' THEN 'removed'
           ELSE 'updated' END AS o
    FROM events e LEFT JOIN folded f ON f.inner_id = CAST(e.user_id * 20 + e.event_id % 20 AS VARCHAR)
  )
SELECT day,
  CAST(count(*) FILTER (WHERE o = 'loaded') AS BIGINT) AS loaded,
  CAST(count(*) FILTER (WHERE o = 'updated') AS BIGINT) AS updated,
  CAST(count(*) FILTER (WHERE o = 'removed') AS BIGINT) AS removed,
  CAST(count(*) FILTER (WHERE o = 'duplicate') AS BIGINT) AS duplicates,
  CAST(0 AS BIGINT) AS errors,
  CAST(count(*) FILTER (WHERE o = 'ignored') AS BIGINT) AS ignored
FROM outcome GROUP BY day
"""

ORACLES["q04_insert_new"] = """
SELECT 'c' || CAST(o_custkey AS VARCHAR) AS inner_id, min(o_orderkey) AS id, 'added' AS change_type
FROM orders
WHERE o_orderpriority <> '5-LOW'
  AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
GROUP BY o_custkey
"""

ORACLES["q04b_insert_stats"] = """
WITH keyed AS (SELECT * FROM orders WHERE o_orderpriority <> '5-LOW'),
  loaded AS (SELECT count(DISTINCT o_custkey) AS n FROM keyed
             WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'))
SELECT CAST((SELECT n FROM loaded) AS BIGINT) AS loaded,
       CAST((SELECT count(*) FROM keyed) - (SELECT n FROM loaded) AS BIGINT) AS skipped,
       CAST((SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW') AS BIGINT) AS errors
"""

ORACLES["q05_digits"] = """
SELECT l_orderkey, l_linenumber,
  CAST(round(l_extendedprice * 100) AS BIGINT) AS s1,
  CAST(l_quantity * 10 AS BIGINT) AS s2,
  CAST(l_linenumber AS BIGINT) AS s3,
  CASE WHEN l_extendedprice = 0 THEN NULL ELSE CAST(floor(l_extendedprice) AS BIGINT) END AS n1,
  l_discount AS d1,
  CAST(NULL AS DOUBLE) AS d2
FROM lineitem
"""

ORACLES["q06_dates"] = """
SELECT o_orderkey,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS d1,
  CAST(o_orderdate AS DATE) AS d2,
  CAST(NULL AS DATE) AS d3,
  CASE WHEN o_orderkey % 2 = 0 THEN CAST(date_trunc('month', o_orderdate) AS DATE) END AS d4,
  CASE WHEN day(o_orderdate) + 10 <= CASE WHEN (year(o_orderdate) % 4 = 0 AND year(o_orderdate) % 100 <> 0)
                                               OR year(o_orderdate) % 400 = 0 THEN 29 ELSE 28 END
       THEN make_date(year(o_orderdate), 2, day(o_orderdate) + 10) END AS d5
FROM orders
"""

ORACLES["q07_truthiness"] = """
SELECT CAST(p_partkey AS VARCHAR) AS inner_id,
  p_size % 6 IN (0, 1, 3, 4) AS is_falsy,
  CASE p_size % 6 WHEN 2 THEN '0' WHEN 5 THEN p_brand END AS as_text,
  CASE p_size % 6 WHEN 2 THEN CAST(0 AS BIGINT)
                  WHEN 5 THEN CAST(regexp_replace(p_brand, '[^0-9]', '', 'g') AS BIGINT) END AS as_int,
  CASE p_size % 6 WHEN 0 THEN 'string' WHEN 1 THEN 'number' WHEN 2 THEN 'string'
                  WHEN 3 THEN 'array' WHEN 4 THEN 'object' ELSE 'string' END AS kind
FROM part
"""

ORACLES["q08_validate"] = """
WITH v AS (
  SELECT 1880 + l_quantity * 3 AS year,
         CAST(round(l_extendedprice * 100) AS BIGINT) * 10 AS price,
         l_partkey * 5000 AS km_age, l_suppkey * 100 AS power, l_tax * 300 AS displacement
  FROM lineitem)
SELECT CASE WHEN year <> 0 AND NOT (year BETWEEN 1900 AND 2027) THEN 'year'
            WHEN price <> 0 AND NOT (price BETWEEN 0 AND 100000000) THEN 'price'
            WHEN km_age <> 0 AND NOT (km_age BETWEEN 0 AND 10000000) THEN 'km_age'
            WHEN power <> 0 AND NOT (power BETWEEN 0 AND 10000) THEN 'power'
            WHEN displacement <> 0 AND NOT (displacement BETWEEN 0 AND 20) THEN 'displacement'
            ELSE 'ok' END AS reason,
       CAST(count(*) AS BIGINT) AS n
FROM v GROUP BY 1
"""

ORACLES["q09_translate"] = f"""
SELECT inner_id, mark, model, color, address, year, price, km_age, power, displacement, first_registration
FROM ({PARTS_FLAT})
"""

ORACLES["q10_options"] = f"""
SELECT inner_id, o1 || '|' || o2 || '|' || mark AS options, 3 AS n_options FROM ({PARTS_FLAT})
"""

ORACLES["q11_config"] = f"""
WITH orders_li AS (SELECT DISTINCT l_orderkey FROM lineitem),
  cfg AS ({CONFIG_ROWS})
SELECT 'o' || CAST(o.l_orderkey AS VARCHAR) AS inner_id,
       string_agg(param_id || '=' || name || ':' || value, ';' ORDER BY param_id) AS config
FROM orders_li o LEFT JOIN cfg c ON c.l_orderkey = o.l_orderkey
GROUP BY o.l_orderkey
"""

ORACLES["q12_flat_upsert"] = f"""
WITH {_CHANGES}
SELECT inner_id,
       CASE WHEN existed THEN CAST(inner_id AS BIGINT) ELSE fid END AS id,
       price, km_age, active_status, existed AS kept_created
FROM folded
"""

ORACLES["q13_mine"] = f"""
WITH {_MINED}
SELECT field, text, count, known FROM mined
"""

ORACLES["q14_field_totals"] = f"""
WITH {_MINED}
SELECT field, CAST(sum(count) AS BIGINT) AS occurrences, CAST(count(*) AS BIGINT) AS texts
FROM new_entries GROUP BY field
"""

ORACLES["q15_priority"] = f"""
WITH {_MINED}
SELECT CAST(count(*) FILTER (WHERE priority = 'high') AS BIGINT) AS high,
       CAST(count(*) FILTER (WHERE priority = 'medium') AS BIGINT) AS medium,
       CAST(count(*) FILTER (WHERE priority = 'low') AS BIGINT) AS low
FROM new_entries
"""

ORACLES["q15b_mining_metadata"] = f"""
WITH {_MINED}
SELECT CAST((SELECT count(*) FROM part) + (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS BIGINT)
         AS total_records_analyzed,
       CAST((SELECT count(DISTINCT text) FROM mined) AS BIGINT) AS total_untranslated_unique,
       CAST((SELECT COALESCE(sum(count), 0) FROM mined WHERE known) AS BIGINT) AS already_in_dict_count,
       CAST((SELECT count(*) FROM new_entries) AS BIGINT) AS new_translations_count,
       1 AS min_count_threshold
"""

ORACLES["q16_top_texts"] = f"""
WITH {_MINED}
SELECT field, text, count, rank FROM (
  SELECT field, text, count,
         CAST(row_number() OVER (PARTITION BY field ORDER BY count DESC, text) AS INTEGER) AS rank
  FROM new_entries) WHERE rank <= 3
"""

ORACLES["q17_frequency"] = f"""
WITH {_MINED}
SELECT text, CAST(sum(count) AS BIGINT) AS total FROM mined WHERE NOT known
GROUP BY text ORDER BY total DESC, text LIMIT 5
"""

_SEED_VALUES = ", ".join(f"({_q(k)}, {_q(v)})" for k, v in SEED.items())
_INITCAP = "upper(substr(p_type, 1, 1)) || lower(substr(p_type, 2))"
_W1_RU = f"(CASE {W1} WHEN 'red' THEN 'Красный' WHEN 'old' THEN '' ELSE upper({W1}) END)"

ORACLES["q18_dictionary_extend"] = f"""
WITH seed(cn, ru) AS (VALUES {_SEED_VALUES}),
  cand0 AS (
    SELECT {TYPE} AS cn, {_INITCAP} AS ru FROM part
    UNION SELECT p_brand, 'x' FROM part
    UNION SELECT {WORD1}, {_W1_RU} FROM part),
  cand AS (SELECT cn, max(ru) AS ru FROM cand0 WHERE cn IS NOT NULL GROUP BY cn)
SELECT c.cn, c.ru,
  CASE WHEN c.cn = '' THEN 'error'
       WHEN c.ru IS NULL OR c.ru = '' THEN 'error'
       WHEN NOT regexp_matches(c.cn, {HAN}) THEN 'error'
       WHEN s.ru = c.ru THEN 'already_exists'
       WHEN s.ru IS NOT NULL THEN 'conflict'
       ELSE 'added' END AS class
FROM cand c LEFT JOIN seed s ON s.cn = c.cn
"""

ORACLES["q18b_dictionary_stats"] = f"""
WITH seed(cn, ru) AS (VALUES {_SEED_VALUES}),
  cand AS (SELECT DISTINCT {TYPE} AS cn, {_INITCAP} AS ru FROM part),
  cls AS (SELECT CASE WHEN s.ru = c.ru THEN 'already_exists' WHEN s.ru IS NOT NULL THEN 'conflict'
                      ELSE 'added' END AS class FROM cand c LEFT JOIN seed s ON s.cn = c.cn)
SELECT CAST(count(*) AS BIGINT) AS total,
       CAST(count(*) FILTER (WHERE class = 'added') AS BIGINT) AS added,
       CAST(count(*) FILTER (WHERE class IN ('already_exists', 'conflict')) AS BIGINT) AS skipped,
       CAST(0 AS BIGINT) AS errors,
       CAST(count(*) FILTER (WHERE class = 'already_exists') AS BIGINT) AS already_exists
FROM cls
"""

ORACLES["q19_status"] = f"""
WITH {_CHANGES}
SELECT CAST(count(*) FILTER (WHERE NOT modified) AS BIGINT) AS processed,
       CAST(count(*) FILTER (WHERE modified) AS BIGINT) AS unprocessed,
       CAST(count(*) AS BIGINT) AS total
FROM folded
"""

ORACLES["q20_recent_runs"] = """
SELECT o_orderpriority AS operation_type,
       strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%Y-%m-%d %H:%M:%S') AS started_at,
       CAST(o_custkey % 600 AS INTEGER) AS duration,
       CASE WHEN o_orderstatus = 'F' THEN 'ERROR' ELSE 'OK' END AS status,
       'order ' || CAST(o_orderkey AS VARCHAR) AS details
FROM orders
ORDER BY o_orderdate + to_seconds(o_orderkey % 86400) DESC, o_orderpriority
LIMIT 10
"""

ORACLES["q21_facets"] = f"""
SELECT mark, string_agg(DISTINCT model, '|' ORDER BY model) AS models FROM ({PARTS_FLAT}) GROUP BY mark
"""

ORACLES["q22_filter"] = f"""
SELECT inner_id, mark, year, price FROM ({PARTS_FLAT})
WHERE lower(mark) = 'brand#3' AND year >= 2010 AND price <= 9500
"""

ORACLES["q23_offers_page"] = f"""
WITH f AS (SELECT inner_id, price FROM ({PARTS_FLAT}) WHERE price <= 9800)
SELECT inner_id, price,
       CASE WHEN (SELECT count(*) FROM f) > 60 THEN 4 END AS next_page
FROM f ORDER BY inner_id LIMIT 20 OFFSET 40
"""

ORACLES["q24_changes_page"] = """
WITH c AS (
  SELECT event_id AS id, CAST(user_id * 20 + event_id % 20 AS VARCHAR) AS inner_id,
         CASE WHEN event_type = 'signup' THEN 'added' WHEN event_type IN ('purchase', 'view') THEN 'changed'
              WHEN event_type = 'error' THEN 'removed' ELSE 'other' END AS change_type
  FROM events WHERE event_id >= 5000 ORDER BY event_id LIMIT 21)
SELECT id, inner_id, change_type,
       CASE WHEN (SELECT count(*) FROM c) > 20 THEN (SELECT max(id) FROM c) END AS next_change_id
FROM c ORDER BY id LIMIT 20
"""

ORACLES["q25_change_id"] = """
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, min(event_id) AS change_id FROM events GROUP BY 1
"""

ORACLES["q26_offer"] = f"""
SELECT inner_id, mark, model, price FROM ({PARTS_FLAT}) WHERE inner_id = '17'
"""

ORACLES["q27_retranslate"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS inner_id, {T(TYPE, MINING_DICT)} AS model, {T(WORD1, MINING_DICT)} AS color,
       {T(WORD1, MINING_DICT)} || '|' || {T(WORD2, MINING_DICT)} || '|' || p_brand AS options
FROM part
"""

ORACLES["q28_has_han"] = f"""
WITH parts AS ({PARTS_FLAT}),
  cfg AS ({CONFIG_ROWS}),
  order_han AS (
    SELECT o.l_orderkey, bool_or(regexp_matches(c.name, {HAN}) OR regexp_matches(c.value, {HAN})) AS h
    FROM (SELECT DISTINCT l_orderkey FROM lineitem) o LEFT JOIN cfg c ON c.l_orderkey = o.l_orderkey
    GROUP BY o.l_orderkey)
SELECT true AS from_parts,
       CAST(count(*) FILTER (WHERE regexp_matches(model, {HAN}) OR regexp_matches(color, {HAN})
                             OR COALESCE(regexp_matches(address, {HAN}), false)
                             OR regexp_matches(o1, {HAN}) OR regexp_matches(o2, {HAN})) AS BIGINT) AS with_han,
       CAST(count(*) AS BIGINT) AS total
FROM parts
UNION ALL
SELECT false, CAST(count(*) FILTER (WHERE COALESCE(h, false)) AS BIGINT), CAST(count(*) AS BIGINT) FROM order_han
"""

ORACLES["q29_orphans"] = f"""
WITH {_CHANGES}
SELECT inner_id, 'raw_without_flat' AS side FROM folded WHERE NOT existed
"""

ORACLES["q31_price_stats"] = f"""
WITH {_CHANGES},
  joined AS (
    SELECT CASE WHEN f.existed THEN p.p_brand END AS mark,
           CASE WHEN f.existed THEN {T(TYPE)} END AS model,
           CASE WHEN f.existed THEN CAST(2000 + p.p_size % 25 AS INTEGER) END AS year,
           f.price
    FROM folded f LEFT JOIN part p ON CAST(p.p_partkey AS VARCHAR) = f.inner_id)
SELECT mark, model, year, round(median(price), 4) AS median_price, round(avg(price), 4) AS avg_price,
       CAST(count(*) AS BIGINT) AS listings
FROM joined WHERE price IS NOT NULL GROUP BY mark, model, year
"""

_OBS = """
  obs AS (
    SELECT event_id AS id, CAST(user_id * 20 + event_id % 20 AS VARCHAR) AS inner_id, event_type, ts,
           NULLIF(CASE WHEN event_type IN ('signup', 'purchase')
                       THEN CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 END, 0) AS price
    FROM events)"""

ORACLES["q32_exposure"] = f"""
WITH {_OBS}
SELECT inner_id,
       CAST(date_diff('day', CAST(min(ts) AS DATE), CAST(max(ts) FILTER (WHERE event_type = 'error') AS DATE))
            AS INTEGER) AS days_exposed,
       arg_max(price, id) FILTER (WHERE price IS NOT NULL) AS last_price
FROM obs GROUP BY inner_id HAVING count(*) FILTER (WHERE event_type = 'error') > 0
"""

ORACLES["q33_price_change"] = f"""
WITH {_OBS}
SELECT id, inner_id, price, prev_price, price - prev_price AS delta FROM (
  SELECT id, inner_id, price, lag(price) OVER (PARTITION BY inner_id ORDER BY id) AS prev_price
  FROM obs WHERE price IS NOT NULL)
"""

ORACLES["q34_popularity"] = f"""
SELECT mark, model, CAST(count(*) AS BIGINT) AS listings FROM ({PARTS_FLAT}) GROUP BY mark, model
"""

ORACLES["q35_price_trend"] = f"""
WITH {_OBS},
  daily AS (SELECT CAST(ts AS DATE) AS day, avg(price) AS avg_price, CAST(count(*) AS BIGINT) AS observations
            FROM obs WHERE price IS NOT NULL GROUP BY 1)
SELECT strftime(day, '%Y-%m-%d') AS day, round(avg_price, 4) AS avg_price, observations,
       round(avg(avg_price) OVER (ORDER BY day ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 4) AS moving_avg_price
FROM daily
"""

ORACLES["q36_delisted"] = """
SELECT event_id AS id, CAST(user_id * 20 + event_id % 20 AS VARCHAR) AS inner_id
FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) = DATE '2024-01-15'
"""

ORACLES["q30_page_gaps"] = """
SELECT CAST(max(event_id) // 20 * 20 AS BIGINT) AS cur, CAST(NULL AS BIGINT) AS nxt, 'terminal' AS kind
FROM events
"""

ORACLES["q30b_page_records"] = """
SELECT CASE WHEN event_type = 'signup' THEN 'added' WHEN event_type IN ('purchase', 'view') THEN 'changed'
            WHEN event_type = 'error' THEN 'removed' ELSE 'other' END AS change_type,
       CAST(count(*) AS BIGINT) AS n, min(event_id) AS min_id, max(event_id) AS max_id,
       CAST(0 AS BIGINT) AS bad_pages
FROM events WHERE event_id >= 5000 GROUP BY 1
"""

ORACLES["q37_stream_apply"] = ORACLES["q01_change_fold"]

ORACLES["q38_stateful_apply"] = f"""
WITH {_CHANGES_NO_BASE}
SELECT inner_id, price, km_age, active_status, change_type FROM folded
"""

_MINED_SEED = _MINED.replace(
    "text IN (" + ", ".join(_q(k) for k in MINING_DICT) + ")", "text IN (" + ", ".join(_q(k) for k in SEED) + ")")

ORACLES["q39_enrich"] = f"""
WITH {_MINED_SEED}
SELECT 2 AS rounds, CAST(count(DISTINCT text) AS BIGINT) AS added,
       CAST(count(DISTINCT text) + {len(SEED)} AS BIGINT) AS dictionary_size,
       CAST(0 AS BIGINT) AS records_with_han
FROM new_entries
"""

ORACLES["q40_dictionary_coverage"] = f"""
WITH {_MINED}
SELECT CAST(count(DISTINCT text) FILTER (WHERE known) AS BIGINT) AS known_texts,
       CAST(count(DISTINCT text) FILTER (WHERE NOT known) AS BIGINT) AS missing_texts
FROM mined
"""

ORACLES["q41_translate_cols"] = f"""
SELECT CAST(p_partkey AS VARCHAR) AS inner_id, {T(TYPE)} AS model, {T(WORD1)} AS color, {T(WORD2)} AS option
FROM part
"""

ORACLES["q42_seller_fields"] = """
SELECT 'c' || CAST(c_custkey AS VARCHAR) AS inner_id, c_mktsegment AS seller_type,
       CAST(c_nationkey AS VARCHAR) AS salon_id, c_custkey % 4 <> 3 AS is_dealer
FROM customer
"""

ORACLES["q43_translate_texts"] = f"""
WITH {_MINED}
SELECT field, text, text AS translation,
       field = 'address' OR regexp_matches(text, '[^一-鿿\\s,，。、]') AS accepted
FROM new_entries
"""

ORACLES["q44_mining_report"] = f"""
WITH {_MINED}
SELECT field, text, count, priority FROM new_entries
"""

ORACLES["q45_enrich_once"] = f"""
WITH {_MINED_SEED}
SELECT CAST(count(*) AS BIGINT) AS new_entries, CAST(count(*) AS BIGINT) AS translated,
       CAST(count(DISTINCT text) AS BIGINT) AS dict_added
FROM new_entries
"""


# --- readers, stores, streams and jobs (catalog_io) ---------------------------------

_GOOD_EVENT = "(event_id // 20) % 50 <> 7 AND event_id % 100 <> 77"
_CHANGES_UNDAMAGED = _CHANGES.replace("FROM events WHERE event_type", f"FROM events WHERE {_GOOD_EVENT} AND event_type")
_BAD_PAGES = "(SELECT count(DISTINCT event_id // 20) FROM events WHERE (event_id // 20) % 50 = 7)"
_BAD_RECORDS = "(SELECT count(*) FROM events WHERE (event_id // 20) % 50 <> 7 AND event_id % 100 = 77)"

ORACLES["q50_page_bad_records"] = f"""
SELECT kind, CAST(n AS BIGINT) AS n, CAST({_BAD_PAGES} AS BIGINT) AS bad_pages FROM (
  SELECT 'good' AS kind, (SELECT count(*) FROM events WHERE {_GOOD_EVENT}) AS n
  UNION ALL SELECT 'page', {_BAD_PAGES} UNION ALL SELECT 'record', {_BAD_RECORDS}) WHERE n > 0
"""

ORACLES["q51_stream_bad_page"] = f"""
WITH {_CHANGES_UNDAMAGED}
SELECT inner_id, price, km_age, active_status, change_type FROM folded
UNION ALL SELECT 'bad ' || kind, NULL, NULL, CAST(n AS INTEGER), 'aside'
FROM (SELECT 'page' AS kind, {_BAD_PAGES} AS n UNION ALL SELECT 'record', {_BAD_RECORDS}) WHERE n > 0
"""

ORACLES["q52_store_merge"] = ORACLES["q01_change_fold"]

ORACLES["q53_offer_pages"] = """
SELECT CAST(p_partkey // 20 + 1 AS BIGINT) AS page, count(*) AS n, min(p_partkey) AS first_id, count(*) AS added,
       count(*) FILTER (p_partkey % 4 = 0) AS without_payload
FROM part WHERE p_partkey // 20 + 1 <= 5 GROUP BY 1
"""

ORACLES["q54_sync_state"] = """
SELECT max(CAST(ts AS DATE)) AS last_successful_date,
       arg_max(event_id, (CAST(ts AS DATE), event_id)) + 1 AS last_change_id, false AS done_before, true AS done_after
FROM events
"""

ORACLES["q55_daily_update"] = f"""
WITH {_CHANGES}
SELECT inner_id, price, km_age, active_status, true AS is_processed FROM folded
"""

ORACLES["q56_run_journal"] = """
SELECT 'daily_update' AS operation_type, status, CAST(1 AS BIGINT) AS runs
FROM (SELECT 'OK' AS status UNION ALL SELECT 'ERROR') WHERE (SELECT count(*) FROM events) > 0
"""

ORACLES["q57_report_text"] = f"""
WITH {_MINED},
  per_text AS (SELECT text, CAST(sum(count) AS BIGINT) AS total FROM mined WHERE NOT known GROUP BY text)
SELECT printf('total occurrences %d, distinct entries %d', CAST(sum(count) AS BIGINT), count(*)) AS line FROM new_entries
UNION ALL SELECT printf('%s' || chr(9) || '%6d' || chr(9) || '%s', field, count, text) FROM new_entries
UNION ALL SELECT printf('TOP' || chr(9) || '%6d' || chr(9) || '%s', total, text)
FROM (SELECT * FROM per_text ORDER BY total DESC, text LIMIT 5)
"""

ORACLES["q58_dictionary_files"] = f"""
WITH {_MINED} SELECT DISTINCT text AS cn, 'T:' || text AS ru FROM new_entries
"""

ORACLES["q59_preview"] = f"""
SELECT p_partkey AS id, mark, year, 3 AS n_options, o1 || '|' || o2 || '|' || mark AS options
FROM ({PARTS_FLAT}) ORDER BY p_partkey LIMIT 3
"""

ORACLES["q60_passthrough_images"] = """
SELECT CAST(p_partkey AS VARCHAR) AS inner_id, 'https://example.invalid/offer/' || p_partkey AS url,
       CAST(NULL AS VARCHAR) AS vin, CAST(NULL AS VARCHAR) AS description, 'img/' || p_partkey || '.jpg' AS images
FROM part
"""

ORACLES["q61_rejected"] = """
SELECT CASE p_size % 6 WHEN 3 THEN 'validation' WHEN 4 THEN 'validation' WHEN 5 THEN 'accepted' ELSE 'quarantine' END AS stage,
       CASE p_size % 6 WHEN 0 THEN 'payload_not_object' WHEN 1 THEN 'extra_type' WHEN 2 THEN 'option_type'
                       WHEN 3 THEN 'year' WHEN 4 THEN 'price' ELSE '' END AS reason, count(*) AS n
FROM part GROUP BY 1, 2
"""

ORACLES["q62_event_time"] = """
SELECT o_orderkey, strftime(CASE o_orderkey % 4 WHEN 0 THEN o_orderdate - INTERVAL 3 HOUR
       WHEN 3 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS at
FROM orders
"""

ORACLES["q63_pending_batch"] = """
SELECT p_partkey AS id, CAST(p_partkey AS VARCHAR) AS inner_id FROM part WHERE p_partkey % 2 <> 0 ORDER BY p_partkey LIMIT 50
"""

ORACLES["q64_min_count"] = f"""
WITH {_MINED} SELECT field, text, count FROM new_entries WHERE count >= 10
"""

ORACLES["q65_stream_day_stats"] = """
SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'signup') AS added,
       count(*) FILTER (event_type IN ('purchase', 'view')) AS changed,
       count(*) FILTER (event_type = 'error') AS removed, count(*) AS events
FROM events GROUP BY 1
"""

ORACLES["q66_daily_export"] = """
SELECT CAST(p_partkey AS VARCHAR) AS inner_id, p_brand AS mark, p_type AS model,
       CAST(CAST(round(p_retailprice) AS INTEGER) AS VARCHAR) AS price
FROM part
"""

ORACLES["q67_enrich_once_applied"] = f"""
SELECT count(*) AS listings, CAST(0 AS BIGINT) AS with_han,
       count(*) FILTER (regexp_matches(model, {HAN})) AS retranslated_models
FROM ({PARTS_FLAT})
"""

ORACLES["q68_unvalidated_retranslate"] = f"""
SELECT inner_id, {T("model", MINING_DICT)} AS model,
       CASE WHEN regexp_matches(concat_ws('', mark, model, color, address, o1, o2), {HAN}) THEN 999999999 ELSE price END AS price
FROM ({PARTS_FLAT})
"""

ORACLES["q69_range_check"] = f"""
SELECT CASE WHEN year > 2019 THEN 'year' ELSE 'ok' END AS reason, count(*) AS n FROM ({PARTS_FLAT}) GROUP BY 1
"""

# --- feed features (catalog_feed) ---------------------------------------------------

_NESTED = f"SELECT CAST(p_partkey AS VARCHAR) AS inner_id, {TYPE} AS kind, {WORD1} AS word FROM part"

ORACLES["q70_nested_paths"] = f"""
WITH n AS ({_NESTED})
SELECT inner_id, path, text FROM (
  SELECT inner_id, 'a.b[0].c.d[0].e' AS path, kind AS text FROM n UNION ALL SELECT inner_id, 'a.b[0].c.d[1]', word FROM n
  UNION ALL SELECT inner_id, 'a.b[1]', kind FROM n UNION ALL SELECT inner_id, 't', word FROM n)
WHERE regexp_matches(text, {HAN})
"""

ORACLES["q71_nested_rewrite"] = f"""
SELECT inner_id, '{{"z":{{"none":[],"empty":{{}}}},"a":{{"b":[{{"c":{{"d":[{{"e":"' || {T("kind")} || '"}},"' || {T("word")} || '"]}}}},"'
       || {T("kind")} || '",7,null]}},"t":"' || {T("word")} || '"}}' AS data
FROM ({_NESTED})
"""

ORACLES["q72_all_offer_pages"] = """
SELECT p_partkey AS id, CAST(p_partkey // 20 + 1 AS INTEGER) AS page,
       CAST(row_number() OVER (PARTITION BY p_partkey // 20 ORDER BY p_partkey) - 1 AS INTEGER) AS pos,
       CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_partkey AS VARCHAR) END AS inner_id, 'added' AS change_type, p_brand AS mark
FROM part
"""

ORACLES["q73_keyless"] = """
SELECT 'added' AS change_type, count(*) FILTER (p_partkey % 13 <> 0) AS n, count(*) FILTER (p_partkey % 13 = 0) AS keyless,
       count(DISTINCT p_partkey // 20) AS pages, count(*) AS records, count(*) FILTER (p_partkey % 13 = 0) AS keyless_at_load
FROM part
"""

ORACLES["q74_page_order"] = """
WITH RECURSIVE p AS (SELECT DISTINCT event_id // 20 AS cur FROM events
), linked AS (
  SELECT cur, CASE WHEN cur < (SELECT max(cur) FROM p) THEN CASE cur % 100 WHEN 59 THEN cur + 11 WHEN 69 THEN cur - 9
         WHEN 79 THEN cur + 2 WHEN 97 THEN cur + 1000000 ELSE cur + 1 END END AS nxt FROM p
), heads AS (SELECT cur FROM linked WHERE cur NOT IN (SELECT nxt FROM linked WHERE nxt IS NOT NULL)
), chain AS (
  SELECT min(cur) AS cur, 0 AS place FROM heads
  UNION ALL
  SELECT l.nxt, c.place + 1 FROM chain c JOIN linked l USING (cur) JOIN p ON p.cur = l.nxt
)
SELECT l.cur, CAST(place AS BIGINT) AS place,
       CASE WHEN l.cur % 100 BETWEEN 60 AND 69 AND (l.cur // 100) * 100 + 69 < (SELECT max(cur) FROM p) THEN 'cycle'
            WHEN place IS NULL AND l.cur IN (SELECT cur FROM heads) THEN 'head' WHEN place IS NULL THEN 'unreached'
            WHEN l.nxt IS NULL THEN 'end' WHEN l.nxt NOT IN (SELECT cur FROM p) THEN 'gap' ELSE 'chain' END AS kind
FROM linked l LEFT JOIN chain USING (cur)
"""

ORACLES["q75_final_days"] = """
WITH b AS (SELECT min(ts) AS low, max(ts) AS high FROM events)
SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'signup') AS added,
       count(*) FILTER (event_type IN ('purchase', 'view')) AS changed, count(*) FILTER (event_type = 'error') AS removed, count(*) AS events,
       (SELECT count(*) FROM events, b WHERE ts < low + (high - low) / 3 AND event_id % 50 = 0) AS late
FROM events, b GROUP BY 1, high HAVING CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= high - INTERVAL 2 DAY
"""

ORACLES["q76_all_pages"] = f"""
SELECT inner_id, CAST((r // 20) + 1 AS BIGINT) AS page, CAST(r % 20 AS BIGINT) AS position
FROM (SELECT inner_id, row_number() OVER (ORDER BY inner_id) - 1 AS r FROM ({PARTS_FLAT}) WHERE price <= 9800)
"""

ORACLES["q77_page_by_cursor"] = f"""
SELECT inner_id, price FROM ({PARTS_FLAT}) WHERE price <= 9800 AND inner_id > '17' ORDER BY inner_id LIMIT 20
"""

ORACLES["q78_stored_filter"] = ORACLES["q22_filter"]
ORACLES["q79_stored_offer"] = ORACLES["q26_offer"]

ORACLES["q80_price_sketches"] = f"""
SELECT model, count(price) AS n, true AS within_bound FROM ({PARTS_FLAT}) GROUP BY model
"""

ORACLES["q81_daily_exports"] = """
SELECT CAST(p_partkey AS VARCHAR) AS inner_id, p_brand AS mark, CAST(CAST(round(p_retailprice) AS INTEGER) AS VARCHAR) AS price,
       make_date(2024, 3, CAST(p_partkey % 10 + 1 AS INTEGER)) AS day
FROM part WHERE p_partkey % 10 BETWEEN 1 AND 7
"""

ORACLES["q82_enrich_incremental"] = f"""
WITH {_MINED_SEED},
  left_parts AS ({PARTS_FLAT}), left_cfg AS ({CONFIG_ROWS})
SELECT 2 AS rounds, CAST((SELECT count(DISTINCT text) FROM new_entries) + {len(SEED)} AS BIGINT) AS dictionary_size,
       CAST((SELECT count(*) FROM part) + (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS BIGINT) AS first_round,
       CAST((SELECT count(*) FROM left_parts WHERE regexp_matches(concat_ws(' ', mark, model, color, address, o1, o2), {HAN}))
          + (SELECT count(DISTINCT l_orderkey) FROM left_cfg WHERE regexp_matches(concat_ws(' ', name, value), {HAN})) AS BIGINT) AS last_round,
       CAST(0 AS BIGINT) AS records_with_han
"""
