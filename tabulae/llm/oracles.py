"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

from tabulae.llm import collocations as C, line_dedup as L, quality_rules as R, search as S
from tabulae.llm.decontaminate import WINDOW


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _count(expr: str, chars: str, size: str = "length") -> str:
    """How many of these characters a text has (``strlen`` counts bytes)."""
    return f"({size}({expr}) - {size}(translate({expr}, {_q(chars)}, '')))"


_BARE = f"translate(x, {_q(R.SPACE)}, '')"
_LINE_FAILS = f"""((regexp_matches(x, {_q(R.SUSPECT)}) AND (
      {_count('x', R.SYMBOLS, 'strlen')} > {R.MAX_SYMBOLS}::DOUBLE * strlen({_BARE})
      OR {_count('x', '!?', 'strlen')} > {R.MAX_MARKS}::DOUBLE * strlen({_BARE})
      OR {_count('x', '|»›')} >= {R.MIN_SEPARATORS}))
    OR (strlen(x) <= {R.BOILERPLATE_CHARS} AND regexp_matches(lower(x), {_q(R.BOILERPLATE)})))"""

QUALITY_RULES = f"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (
  SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    string_split(t, chr(10)) AS lines FROM d),
word_at AS (SELECT rid, unnest(words) AS x, generate_subscripts(words, 1) AS p FROM w),
grams AS (
  SELECT rid, p, list(x) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS g FROM word_at),
twice AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM grams WHERE len(g) = 5) s WHERE c > 1),
gaps AS (SELECT rid, least(5, coalesce(lead(p) OVER (PARTITION BY rid ORDER BY p) - p, 5)) AS n FROM twice),
repeats AS (SELECT rid, CAST(sum(n) AS BIGINT) AS n_repeat_words FROM gaps GROUP BY rid),
stats AS (
  SELECT w.rid, doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST({_count('t', R.SYMBOLS)} AS BIGINT) AS n_symbols,
    list_filter(lines, lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS worded,
    CAST(length(translate(array_to_string(list_filter(lines, lambda x: {_LINE_FAILS}), ''), {_q(R.SPACE)}, '')) AS BIGINT) AS chars_lost,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN repeats USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM stats)
SELECT doc_id, n_words, word_chars, n_symbols, CAST(len(worded) - len(list_distinct(worded)) AS BIGINT) AS n_dup_lines,
  n_repeat_words, base_failed, NOT base_failed AND chars_lost <= {R.MAX_LOSS}::DOUBLE * word_chars AS kept, chars_lost
FROM judged"""

_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

DECONTAMINATE = f"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS words FROM documents),
b AS MATERIALIZED (
  SELECT row_number() OVER () AS bid, coalesce(CAST(item_id AS VARCHAR), 'None') AS item, {_WORDS} AS words FROM benchmark),
items AS (SELECT bid, item, unnest(words) AS x, generate_subscripts(words, 1) AS p, least(len(words), {WINDOW}) AS size FROM b),
item_grams AS (
  SELECT item, size, list(x) OVER (PARTITION BY bid ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS g FROM items),
windows AS MATERIALIZED (
  SELECT DISTINCT item, size, array_to_string(g, ' ') AS g FROM item_grams WHERE len(g) = size),
word_at AS (SELECT rid, unnest(words) AS x, generate_subscripts(words, 1) AS p FROM d),
grams AS (
  SELECT rid, p, list(x) OVER (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS g FROM word_at),
found AS MATERIALIZED (
  SELECT c.rid, c.p, c.size, v.item
  FROM (SELECT rid, p, s.size, array_to_string(g[1:s.size], ' ') AS g
        FROM grams, (SELECT DISTINCT size FROM windows) s WHERE len(g) >= s.size) c
  JOIN windows v ON v.size = c.size AND v.g = c.g),
hits AS (
  SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS pos FROM found) u GROUP BY rid),
owners AS (
  SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT rid, item FROM found) u GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN hits USING (rid) LEFT JOIN owners USING (rid)"""


_LOWER = f"'{L.UPPER}', '{L.LOWER}'"

COLLOCATIONS = f"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, coalesce(lang, '{C.UND}') AS lang, translate(coalesce(text, ''), {_LOWER}) AS t FROM documents),
pieces AS (
  SELECT rid, lang, unnest(ps) AS piece, generate_subscripts(ps, 1) AS pno
  FROM (SELECT rid, lang, regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]') AS ps FROM d) s),
w AS (
  SELECT rid, lang, pno, unnest(ws) AS x, generate_subscripts(ws, 1) AS pos
  FROM (SELECT rid, lang, pno, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS ws FROM pieces) s),
g AS MATERIALIZED (
  SELECT lang, x AS x1, lead(x, 1) OVER p AS x2, lead(x, 2) OVER p AS x3 FROM w WINDOW p AS (PARTITION BY rid, pno ORDER BY pos)),
f1 AS MATERIALIZED (SELECT lang, x1, count(*) AS f FROM g GROUP BY lang, x1),
f2 AS MATERIALIZED (SELECT lang, x1, x2, count(*) AS f FROM g WHERE x2 IS NOT NULL GROUP BY lang, x1, x2),
f3 AS MATERIALIZED (SELECT lang, x1, x2, x3, count(*) AS f FROM g WHERE x3 IS NOT NULL GROUP BY lang, x1, x2, x3 HAVING count(*) >= {C.MIN_COUNT}),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
longer AS (
  SELECT lang, x1, x2, max(f) AS f
  FROM (SELECT lang, x1, x2, f FROM f3 UNION ALL SELECT lang, x2 AS x1, x3 AS x2, f FROM f3) u GROUP BY lang, x1, x2),
cuts AS (
  SELECT c.lang, c.x1 || ' ' || c.x2 AS phrase, c.f AS a, 1 AS k, p.f AS l, q.f AS r
  FROM f2 c JOIN f1 p ON p.lang = c.lang AND p.x1 = c.x1 JOIN f1 q ON q.lang = c.lang AND q.x1 = c.x2
  LEFT JOIN longer m ON m.lang = c.lang AND m.x1 = c.x1 AND m.x2 = c.x2
  WHERE c.f >= {C.MIN_COUNT} AND (m.f IS NULL OR 100 * m.f < {C.ABSORB} * c.f)
  UNION ALL
  SELECT c.lang, c.x1 || ' ' || c.x2 || ' ' || c.x3, c.f, 1, p.f, q.f
  FROM f3 c JOIN f1 p ON p.lang = c.lang AND p.x1 = c.x1 JOIN f2 q ON q.lang = c.lang AND q.x1 = c.x2 AND q.x2 = c.x3
  UNION ALL
  SELECT c.lang, c.x1 || ' ' || c.x2 || ' ' || c.x3, c.f, 2, p.f, q.f
  FROM f3 c JOIN f2 p ON p.lang = c.lang AND p.x1 = c.x1 AND p.x2 = c.x2 JOIN f1 q ON q.lang = c.lang AND q.x1 = c.x3),
scored AS (SELECT *, CAST((1000000::HUGEINT * a * a) // (l::HUGEINT * r) AS BIGINT) AS score FROM cuts),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM lowest WHERE place = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {C.TOP}"""

_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS MATERIALIZED (
  SELECT rid, doc_id, line, pos, translate(trim(line, {_SPACES}), {_LOWER}) AS key
  FROM (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d) s),
often AS (
  SELECT key, max(doc_id) AS keeper FROM l WHERE length(key) >= {L.MIN_CHARS} GROUP BY key HAVING count(DISTINCT doc_id) >= {L.MIN_DOCS}),
judged AS (SELECT rid, doc_id, line, pos, o.key IS NOT NULL AND doc_id <> keeper AS lost FROM l LEFT JOIN often o USING (key))
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY rid"""

_TERMS = f"translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')), {_LOWER})"

SEARCH = f"""WITH t AS MATERIALIZED (
  SELECT rid, doc_id, term, count(*) AS tf
  FROM (SELECT rid, doc_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents) d) u
  GROUP BY rid, doc_id, term),
lengths AS (SELECT rid, sum(tf) AS n FROM t GROUP BY rid),
total AS (SELECT count(*) AS docs, sum(n) AS words FROM lengths),
dfs AS (SELECT term, count(*) AS df FROM t GROUP BY term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w FROM dfs, total),
m AS (SELECT rid, CAST(100 - 50 + (50 * n * docs) // words AS BIGINT) AS m FROM lengths, total),
items AS (SELECT DISTINCT bid, item_id, term FROM (
  SELECT bid, item_id, {_TERMS} AS term FROM (SELECT row_number() OVER () AS bid, item_id, text FROM benchmark) b) u),
scores AS (
  SELECT bid, item_id, rid, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
  FROM items JOIN t USING (term) JOIN weights USING (term) JOIN m USING (rid) GROUP BY bid, item_id, rid, doc_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bid ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {S.TOP}"""
