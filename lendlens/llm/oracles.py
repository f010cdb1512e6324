"""DuckDB texts of the contract queries that SQL can express on whole tables."""

ORACLES = {}

ORACLES["op7_exact_dedup"] = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
w AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w"""


ORACLES["op12_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
f AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > min(doc_id) OVER same, doc_id IS NULL AND min(doc_id) OVER same IS NOT NULL) AS e
  FROM d WINDOW same AS (PARTITION BY t)),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id),
g AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask, count(*) AS n,
         count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
  FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
letters(name, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.name || q.name || r.name || s.name || t.name AS filter_order, [p.bit, q.bit, r.bit, s.bit, t.bit] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE p.bit | q.bit | r.bit | s.bit | t.bit = 31),
steps AS (
  SELECT filter_order, k AS step, bits[k] AS bit, list_sum(bits[1:k]) AS after, list_sum(bits[1:k]) - bits[k] AS before
  FROM orders, range(1, 6) x(k)),
counted AS (
  SELECT part, filter_order, step, bit,
         sum(n) FILTER (WHERE mask & after = 0) AS kept, sum(n) FILTER (WHERE mask & before = 0 AND mask & bit > 0) AS removed,
         sum(n) FILTER (WHERE mask & before > 0 AND mask & bit > 0) AS redundant, sum(n) FILTER (WHERE mask = bit) AS unique_fails,
         sum(good) FILTER (WHERE mask & before = 0 AND mask & bit > 0) AS good_lost,
         sum(bad) FILTER (WHERE mask & before = 0 AND mask & bit > 0) AS toxic_lost
  FROM g, steps GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM counted"""

ORACLES["op11_collocations"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS s FROM pieces WHERE len(w) > 0),
f AS (
  SELECT lang, array_to_string(w[s:s + k - 1], ' ') AS phrase, k, count(*) AS a
  FROM places, range(1, 6) x(k) WHERE s + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT p.lang, p.phrase, p.a, totals.n, x.cut, l.a AS l, r.a AS r, 1000 * p.a::HUGEINT * totals.n // (l.a::HUGEINT * r.a) AS score
  FROM f p JOIN totals USING (lang), range(1, 5) x(cut), f l, f r
  WHERE x.cut < p.k AND l.lang = p.lang AND r.lang = p.lang
    AND l.phrase = array_to_string(string_split(p.phrase, ' ')[1:x.cut], ' ')
    AND r.phrase = array_to_string(string_split(p.phrase, ' ')[x.cut + 1:], ' ')),
worst AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
kept AS (
  SELECT * FROM worst p WHERE NOT EXISTS (
    SELECT 1 FROM f q WHERE q.lang = p.lang AND q.a >= p.a AND len(q.phrase) > len(p.phrase) AND contains(' ' || q.phrase || ' ', ' ' || p.phrase || ' ')))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000"""

ORACLES["op5_decontamination"] = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents, fold),
items AS (
  SELECT item_id, w, least(10, len(w)) AS n
  FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark, fold)
  WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS body
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM items)),
places AS (
  SELECT row, n, s, array_to_string(w[s:s + n - 1], ' ') AS body
  FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM docs, (SELECT DISTINCT n FROM windows))),
found AS MATERIALIZED (SELECT row, s, n, item_id FROM places JOIN windows USING (n, body)),
hit AS (SELECT row, count(DISTINCT place) AS n_hit FROM (SELECT row, unnest(range(s, s + n)) AS place FROM found) GROUP BY row),
told AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT row, item_id FROM found) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (row) LEFT JOIN told USING (row)"""

ORACLES["op6_jaccard_join"] = r"""
WITH RECURSIVE docs AS MATERIALIZED (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS MATERIALIZED (
  SELECT DISTINCT row, array_to_string(w[s:s + 4], ' ') AS x
  FROM (SELECT row, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS s FROM docs WHERE len(w) > 0)),
sizes AS (SELECT row, count(*) AS n FROM shingles GROUP BY row),
shared AS (SELECT a.row AS a, b.row AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.x = b.x AND a.row <> b.row GROUP BY ALL),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes m ON m.row = a JOIN sizes n ON n.row = b WHERE 100 * common >= 80 * (m.n + n.n - common)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
least_id AS (SELECT a AS row, min(doc_id) AS other FROM reach JOIN docs ON docs.row = reach.b GROUP BY a),
degree AS (SELECT a AS row, count(*) AS k FROM links GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, other) AS component_id, coalesce(k, 0)::BIGINT AS n_links
FROM docs LEFT JOIN sizes USING (row) LEFT JOIN least_id USING (row) LEFT JOIN degree USING (row)"""

ORACLES["op10_chat_formatting"] = r"""
WITH turns AS (
  SELECT conv_id, turn::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
marked AS (
  SELECT *, length('<|turn|><|text|><|end|>') + length(replace(replace(role, '\', '\\'), '<|', '<\|'))
            + length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS chars
  FROM turns),
told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS everything,
         coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '') AS learnt, sum(chars) AS formatted_chars
  FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(everything) AS turns_sha256, length(learnt)::BIGINT AS loss_chars, sha256(learnt) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars
FROM told"""
