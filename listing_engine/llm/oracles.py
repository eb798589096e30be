"""DuckDB SQL for the training-data queries that SQL can express on whole tables."""

ORACLES: dict[str, str] = {}

# One exact pass in the order of the keys instead of buckets.
ORACLES["op3_source_mix"] = r"""
WITH w AS (
  SELECT doc_id, source, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), sized AS (
  SELECT doc_id, source, len(words)::BIGINT AS size,
         greatest(0.05, coalesce(ln(1 + len(list_distinct(words))::DOUBLE) / nullif(ln(1 + len(words)::DOUBLE), 0), 0.05)) AS weight
  FROM w
), keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || md5(concat_ws('/', 'mix', coalesce(doc_id::VARCHAR, ''), size::VARCHAR))[1:12])::BIGINT::DOUBLE + 0.5)
             / 281474976710656.0::DOUBLE) / weight AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM keyed GROUP BY source
), filled AS (
  SELECT *, 3 * source_size AS cap,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS remaining,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
  FROM sources
  WINDOW before AS (ORDER BY 3 * source_size / weight, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), share AS (
  SELECT coalesce(min(remaining::DOUBLE / weight_left::DOUBLE) FILTER (cap * weight_left > remaining * weight), 0) AS least,
         arg_max(remaining::DOUBLE / weight_left::DOUBLE, weight_left) FILTER (cap * weight_left > remaining * weight) AS share
  FROM filled
), targets AS (
  SELECT source, source_size,
         CASE WHEN cap * weight_left <= remaining * weight THEN cap::DOUBLE ELSE weight::DOUBLE * share END AS target
  FROM filled, share
), split AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END::BIGINT AS epochs FROM targets
), placed AS (
  SELECT k.doc_id, k.size, s.source_size, s.target, s.epochs, s.target - s.epochs * s.source_size AS rest,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM keyed k JOIN split s ON k.source IS NOT DISTINCT FROM s.source
)
SELECT doc_id, size, source_size, target,
       ((epochs + CASE WHEN start + size / 2.0::DOUBLE < rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM placed
"""

ORACLES["op5_perspective_rotation"] = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS said
  FROM conversations
), people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said
), rows AS (
  SELECT s.*, p.perspective,
         CASE WHEN speaker = perspective THEN '<|assistant|>' || chr(10)
              ELSE '<|user name=' || replace(speaker, '|', '/') || '|>' || chr(10) END AS head
  FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id
), whole AS (SELECT *, head || said || '<|end|>' || chr(10) AS segment FROM rows
), placed AS (
  SELECT *, coalesce(sum(length(segment)) OVER (PARTITION BY conv_id, perspective ORDER BY turn ASC NULLS FIRST, speaker, said
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM whole
)
SELECT conv_id, perspective, turn, speaker, segment, start,
       CASE WHEN speaker = perspective THEN start + length(head) END AS train_start,
       CASE WHEN speaker = perspective THEN start + length(head) + length(said) + 7 END AS train_end
FROM placed
"""

ORACLES["op10_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, unnest(range(1, len(words) - 48)) AS i,
         unnest(list_transform(range(1, len(words) - 48), lambda i: md5(array_to_string(words[i:i + 49], ' ')))) AS h
  FROM w WHERE len(words) >= 50
), least AS (SELECT h, min(doc_id) AS first_doc FROM win GROUP BY h
), gone AS (
  SELECT doc_id, list(DISTINCT place) AS places
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS place FROM win JOIN least USING (h) WHERE first_doc < doc_id)
  GROUP BY doc_id
), kept AS (
  SELECT w.doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
         CASE WHEN places IS NULL THEN words
              ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END AS kept
  FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept
"""

# Every pair that shares a five-word run, then the components of the links.
ORACLES["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), grams AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
         ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS gram
  FROM w
), sets AS (
  SELECT doc_id, count(*) AS n, md5(string_agg(gram, chr(10) ORDER BY gram)) AS set_id FROM grams GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
  FROM grams a JOIN grams b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM common JOIN sets s ON s.doc_id = x JOIN sets t ON t.doc_id = y
  WHERE common.n * 5 >= 4 * (s.n + t.n - common.n)
), reach AS (
  SELECT doc_id, doc_id AS label FROM documents
  UNION
  SELECT links.y, reach.label FROM reach JOIN links ON links.x = reach.doc_id
), classes AS (SELECT doc_id, min(label) AS class_id FROM reach GROUP BY doc_id
), degree AS (SELECT x AS doc_id, count(*) AS n_links FROM links GROUP BY x)
SELECT doc_id, class_id, min(doc_id) OVER (PARTITION BY set_id) AS copy_id, coalesce(n_links, 0)::BIGINT AS n_links
FROM sets JOIN classes USING (doc_id) LEFT JOIN degree USING (doc_id)
"""

# All phrases of 1 to 3 words counted, cut at every place.
ORACLES["op12_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), grams AS (
  SELECT lang, 1 AS len, unnest(words) AS gram FROM w
  UNION ALL SELECT lang, 2, unnest(list_transform(list_zip(words, words[2:]), lambda z: z[1] || ' ' || z[2])) FROM w
  UNION ALL SELECT lang, 3, unnest(list_transform(list_zip(words, words[2:], words[3:]), lambda z: z[1] || ' ' || z[2] || ' ' || z[3])) FROM w
), f AS (SELECT lang, len, gram, count(*) AS n FROM grams WHERE gram IS NOT NULL GROUP BY ALL
), sizes AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE len = 1 GROUP BY lang
), c AS (SELECT lang, len, gram, string_split(gram, ' ') AS words, n AS a FROM f WHERE len > 1 AND n >= 10
), cuts AS (
  SELECT *, unnest(range(1, len)) AS k FROM c
), parts AS (
  SELECT cuts.lang, cuts.gram, cuts.len, a, k, x.n AS l, y.n AS r,
         ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.gram = array_to_string(words[1:k], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.gram = array_to_string(words[k + 1:], ' ')
), low AS (
  SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1
), longer AS (
  SELECT lang, array_to_string(words[1:2], ' ') AS gram, a FROM c WHERE len = 3
  UNION ALL SELECT lang, array_to_string(words[2:3], ' '), a FROM c WHERE len = 3
), most AS (SELECT lang, gram, max(a) AS longest FROM longer GROUP BY ALL
), kept AS (
  SELECT low.* FROM low LEFT JOIN most ON most.lang = low.lang AND most.gram = low.gram WHERE 100 * coalesce(longest, 0) < 50 * a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(gram)) AS rank FROM kept
)
SELECT lang, rank::BIGINT AS rank, gram AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, sizes.n AS n, score
FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
