"""DuckDB SQL for the registered queries that SQL can express.

No SQL is given for op1 (mined rules), op2 (merged diagonals), op4 (checksum
and slot hash), op5 (markup), op10 (strings at every byte), op11 (XXH64): tests
compare those with plain Python.
"""

from __future__ import annotations

_BLANK = r"[^\x20\x09-\x0D]+"
_PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = ("translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def _words(text: str, pattern: str) -> str:
    return f"regexp_extract_all(coalesce({text}, ''), '{pattern}')"


PREFERENCES = """
WITH numbered AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, t) - 1 AS place,
         r, t
  FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations)),
talks AS (
  SELECT conv_id, min(r) FILTER (place = 0) AS r0, min(t) FILTER (place = 0) AS t0,
         coalesce(sum(length(t)) FILTER (r = 'assistant'), 0) AS learned
  FROM numbered WHERE conv_id IS NOT NULL GROUP BY conv_id),
openings AS (
  SELECT *, row_number() OVER alike AS k, count(*) OVER (PARTITION BY r0, t0) AS of_opening,
         row_number() OVER (ORDER BY r0, t0, conv_id) AS place
  FROM talks WINDOW alike AS (PARTITION BY r0, t0 ORDER BY conv_id)),
alone AS (      -- the last conversation of an opening that an odd number share
  SELECT *, row_number() OVER (ORDER BY place) AS n FROM openings
  WHERE k = of_opening AND of_opening % 2 = 1),
met AS (
  SELECT x.conv_id AS one, x.learned AS has, y.conv_id AS two, y.learned AS had
  FROM openings x JOIN openings y ON x.r0 = y.r0 AND x.t0 = y.t0 AND y.k = x.k + 1 WHERE x.k % 2 = 1
  UNION ALL
  SELECT x.conv_id, x.learned, y.conv_id, y.learned
  FROM alone x JOIN alone y ON y.n = x.n + 1 WHERE x.n % 2 = 1),
pairs AS (
  SELECT one AS pair_id, CASE WHEN has >= had THEN one ELSE two END AS chosen_id,
         CASE WHEN has >= had THEN two ELSE one END AS rejected_id
  FROM met),
sized AS (
  SELECT p.*, (SELECT count(*) FROM numbered WHERE conv_id = p.chosen_id) AS n_chosen,
         (SELECT count(*) FROM numbered WHERE conv_id = p.rejected_id) AS n_rejected FROM pairs p),
prefix AS (
  SELECT s.pair_id, s.chosen_id, s.rejected_id,
         least(coalesce(min(a.place) FILTER (a.r <> b.r OR a.t <> b.t), 1000000000),
               any_value(least(s.n_chosen, s.n_rejected))) AS n_prompt
  FROM sized s LEFT JOIN numbered a ON a.conv_id = s.chosen_id
  LEFT JOIN numbered b ON b.conv_id = s.rejected_id AND b.place = a.place
  GROUP BY ALL),
laid AS (
  SELECT p.pair_id, p.n_prompt, side, place, r, t, '<|' || r || '|>' || chr(10) || t || chr(10) AS shown,
         place >= p.n_prompt AS own
  FROM (SELECT pair_id, n_prompt, 'c' AS side, chosen_id AS id FROM prefix
        UNION ALL SELECT pair_id, n_prompt, 'r', rejected_id FROM prefix) p
  JOIN numbered n ON n.conv_id = p.id),
placed AS (
  SELECT *, coalesce(sum(length(shown)) OVER (PARTITION BY pair_id, side, own ORDER BY place
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(r) + 5 AS begins FROM laid)
SELECT p.pair_id, p.chosen_id, p.rejected_id, CAST(p.n_prompt AS BIGINT) AS n_prompt,
  coalesce(string_agg(shown, '' ORDER BY place) FILTER (side = 'c' AND NOT own), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY place) FILTER (side = 'c' AND own), '') AS chosen,
  coalesce(string_agg(begins || '-' || (begins + length(t)), ',' ORDER BY place)
           FILTER (side = 'c' AND own AND r = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(shown, '' ORDER BY place) FILTER (side = 'r' AND own), '') AS rejected,
  coalesce(string_agg(begins || '-' || (begins + length(t)), ',' ORDER BY place)
           FILTER (side = 'r' AND own AND r = 'assistant'), '') AS rejected_mask
FROM prefix p LEFT JOIN placed l ON l.pair_id = p.pair_id
GROUP BY p.pair_id, p.chosen_id, p.rejected_id, p.n_prompt
"""

DECONTAMINATION = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_words(_LOWER.format('text'), _PLAIN)} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT item, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM (SELECT item, w, least(len(w), 13) AS size FROM items WHERE len(w) > 0))),
docs AS (
  SELECT doc_id, {_words(_LOWER.format('text'), _PLAIN)} AS w FROM documents),
runs AS (
  SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
hits AS (
  SELECT doc_id, i, r.size, item FROM runs r JOIN windows v ON v.win = r.win AND v.size = r.size),
hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS j FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

QUALITY = f"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS t, {_words('text', _BLANK)} AS w FROM documents),
runs AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM docs WHERE len(w) > 8)),
twins AS (SELECT doc_id, i FROM runs QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
repeats AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM twins) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS dup
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '{_BLANK}') GROUP BY doc_id),
facts AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         coalesce(dup, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
         coalesce(n_lines, 0) AS n_lines, len(regexp_extract_all(t, '!')) AS bangs,
         len(regexp_extract_all(t, '[A-Z]')) AS caps
  FROM docs d LEFT JOIN repeats r USING (doc_id) LEFT JOIN lines USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (10 * n_symbols > 3 * n_words OR 10 * bangs > 3 * n_words
         OR 10 * caps > 4 * word_chars OR 10 * n_dup_lines > 4 * n_lines
         OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words) AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM facts)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, {_words(_LOWER.format('text'), _BLANK)} AS w FROM documents),
sets AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM docs),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 75 * ((SELECT n FROM sizes WHERE doc_id = a.doc_id)
                                 + (SELECT n FROM sizes WHERE doc_id = b.doc_id) - count(*))),
reach AS (
  SELECT a AS node, b AS other FROM links
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(low, d.doc_id)) AS component_id
FROM docs d LEFT JOIN sizes USING (doc_id)
LEFT JOIN (SELECT node AS doc_id, min(other) AS low FROM reach GROUP BY node) USING (doc_id)
"""


def _mixing(seed: int, max_epochs: int) -> str:
    def level(i: int, parent: str, keys: str, weight: str) -> str:
        name = keys.split(", ")[-1]
        return f"""
n{i} AS (
  SELECT {keys}, CAST(sum(available) * {max_epochs} AS BIGINT) AS cap, CAST({weight} AS BIGINT) AS w
  FROM leaves GROUP BY {keys}),
m{i} AS (
  SELECT *, cap * sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
     <= w * (given - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS filled
  FROM ({parent})
  WINDOW o AS (PARTITION BY {keys.rpartition(', ')[0] or '1'}
               ORDER BY CASE WHEN w > 0 THEN cap / w ELSE 0.0 END, {name})),
b{i} AS (
  SELECT {keys}, CAST(CASE WHEN filled THEN cap ELSE
     (w * (given - coalesce(sum(cap) FILTER (filled) OVER p, 0))) // (sum(w) FILTER (NOT filled) OVER p)
     END AS BIGINT) AS budget
  FROM m{i} WINDOW p AS (PARTITION BY {keys.rpartition(', ')[0] or '1'}))"""

    return f"""
WITH docs AS (
  SELECT doc_id, CAST(len({_words('text', _BLANK)}) AS BIGINT) AS tokens,
         coalesce(CASE WHEN source = 'src0' THEN 'hub' WHEN regexp_matches(source, '^src[1-9]$')
                  THEN 'wide' WHEN source IS NOT NULL THEN 'tail' END, 'unknown') AS domain,
         coalesce(lang, 'unknown') AS language, coalesce(source, 'unknown') AS origin
  FROM documents),
leaves AS (
  SELECT domain, language, origin, CAST(sum(tokens) AS BIGINT) AS available FROM docs GROUP BY ALL),
{level(0, "SELECT *, (SELECT CAST(sum(available) AS BIGINT) FROM leaves) AS given FROM n0", "domain",
       "CASE domain WHEN 'hub' THEN 30 WHEN 'wide' THEN 40 WHEN 'tail' THEN 30 ELSE 5 END")},
{level(1, "SELECT n1.*, b0.budget AS given FROM n1 JOIN b0 USING (domain)", "domain, language",
       "CASE language WHEN 'en' THEN 50 WHEN 'de' THEN 20 WHEN 'fr' THEN 15 WHEN 'es' THEN 15 ELSE 5 END")},
{level(2, "SELECT n2.*, b1.budget AS given FROM n2 JOIN b1 USING (domain, language)",
       "domain, language, origin", "1")},
plan AS (
  SELECT b2.*, CASE WHEN available > 0 THEN budget // available ELSE 0 END AS whole, available
  FROM b2 JOIN leaves USING (domain, language, origin)),
part AS (
  SELECT doc_id, domain, language, origin, tokens, budget, whole,
         sum(tokens) OVER (PARTITION BY domain, language, origin
           ORDER BY md5('{seed}:' || whole || ':' || doc_id)) <= budget - whole * available AS fits
  FROM docs JOIN plan USING (domain, language, origin))
SELECT doc_id, domain, language, origin, tokens, budget AS leaf_budget,
       unnest(range(0, whole + fits::INT)) AS epoch
FROM part
"""

SOURCES = """
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all({lowered}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
found AS (SELECT id, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM found GROUP BY ALL
         HAVING count(DISTINCT id) >= 30),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT g.lang, g.source, k.term, (count(f.id))::HUGEINT AS n, any_value(k.n) AS lang_n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN found f USING (lang, source, term)
  GROUP BY g.lang, g.source, k.term),
shares AS (
  SELECT lang, source, term, n,
    1 + (1000000000 * (n + 5)) // (sum(n) OVER g + 5 * count(*) OVER g) AS p,
    1 + (1000000000 * (lang_n + 5)) // (sum(lang_n) OVER g + 5 * count(*) OVER g) AS q
  FROM counts WINDOW g AS (PARTITION BY lang, source)),
apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
  GROUP BY ALL),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source),
rows AS (
  SELECT * FROM pairs UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 50
""".replace("{lowered}", _LOWER.format("coalesce(text, '')"))

AUDIT = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {_words('text', _BLANK)} AS w
  FROM documents),
judged AS (
  SELECT part, concat(
      CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN min(doc_id) OVER (PARTITION BY t) < doc_id THEN 'E' ELSE '' END) AS fails,
    doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good,
    doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic
  FROM docs),
kinds AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM judged GROUP BY ALL),
orders(o) AS (
  SELECT '' UNION ALL
  SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE instr(o, x) = 0),
stops AS (
  SELECT k.*, o AS filter_order,
         coalesce(list_min(list_transform(string_split(nullif(fails, ''), ''), lambda x: instr(o, x))), 9)
           AS stop
  FROM kinds k, orders WHERE length(o) = 5),
steps AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS letter,
    sum(n) FILTER (stop > step) AS kept, sum(n) FILTER (stop = step) AS removed,
    sum(n) FILTER (stop < step AND contains(fails, substr(filter_order, step, 1))) AS redundant,
    sum(n) FILTER (fails = substr(filter_order, step, 1)) AS unique_fails,
    sum(good) FILTER (stop = step) AS good_lost, sum(toxic) FILTER (stop = step) AS toxic_lost
  FROM stops, (SELECT unnest(range(1, 6))::INT AS step) GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept,
  coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
  coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
  coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, letter), 0)::BIGINT AS shapley
FROM steps
"""


ORACLES: dict[str, str] = {
    "op3_preferences": PREFERENCES,
    "op6_decontamination": DECONTAMINATION,
    "op7_quality_rules": QUALITY,
    "op8_ngram_join": NEAR_DUPLICATES,
    "op9_mixing": _mixing(17, 3),
    "op12_source_audit": SOURCES,
    "op13_filter_audit": AUDIT,
}
