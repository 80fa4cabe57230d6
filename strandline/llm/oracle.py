"""DuckDB SQL of the corpus operators that SQL can express."""

from __future__ import annotations

from strandline.llm import quality as Q

EXACT = r"""SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = min(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents) WINDOW g AS (PARTITION BY t)"""

SUBSTRING = r"""WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w)),
firsts AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(13)) AS p FROM win JOIN firsts USING (s) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS bigint) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)"""

_LINE = rf"""regexp_matches(x, '[^\x20\x09-\x0D]') AND (
 (len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) < {Q.SHORT_LINE} AND NOT regexp_matches(x, '[.!?…:;][''"”’»)\]]*[\x20\x09-\x0D]*$'))
 OR len(regexp_extract_all(x, '[#*$%&|<>]')) > {Q.MAX_SYMBOL_SHARE} * length(regexp_replace(x, '[\x20\x09-\x0D]+', '', 'g'))
 OR (len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 2 AND len(regexp_extract_all(x, '!!+')) * 2 > len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))
 OR (len(regexp_extract_all(x, '[|»›•]')) >= 3 AND len(regexp_extract_all(x, '[|»›•]')) * 4 >= len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')))
 OR regexp_matches(lower(x), '{"|".join(Q.PHRASES)}')
 OR (len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) >= 8 AND list_unique(regexp_extract_all(x, '[^\x20\x09-\x0D]+')[2:]) = 1))"""

QUALITY = rf"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
win AS (SELECT doc_id, i, ws[i] AS a, ws[i + 1] AS b, ws[i + 2] AS c FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, i + unnest(range(3)) AS p FROM twice) GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS bigint) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars, CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS bigint) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS bigint) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
 length(regexp_replace(array_to_string(list_filter(lines, lambda x: NOT ({_LINE})), ' '), '[\x20\x09-\x0D]+', '', 'g')) AS left_chars FROM w LEFT JOIN rep USING (doc_id)),
b AS (SELECT *, n_words < {Q.MIN_WORDS} OR 100 * n_repeat_words > {Q.MAX_REPEATED_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND left_chars >= (1 - {Q.MAX_LOST}) * word_chars AS kept FROM b"""

DIVERGENCE = r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
t AS (SELECT lang, source, doc_id, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc_id) >= 3),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(any_value(v), 0) AS v FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) GROUP BY ALL),
c AS (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (gn.n + g.v) AS p, 1 + (1000000000::HUGEINT * (kept.n + 1)) // (v.n + v.v) AS q
  FROM g JOIN gn USING (lang, source) JOIN kept ON kept.lang = g.lang JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) f
  ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM (
 SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (SELECT *, 'pair' AS part FROM pairs UNION ALL SELECT *, 'term' AS part FROM terms)) WHERE part = 'pair' OR rank <= 200"""

AUDIT = r"""WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, len(ws) < 100 AS A, 100 * len(list_distinct(ws)) < 80 * len(ws) AS B, 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) AS C, regexp_matches(t, '[#$%&*|]') AS D,
  doc_id > min(doc_id) OVER (PARTITION BY t) AS E, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM t LEFT JOIN l USING (doc_id)),
m AS (SELECT part, A::INT + 2 * B::INT + 4 * C::INT + 8 * D::INT + 16 * E::INT AS mask, count(*) AS n, count_if(good) AS good, count_if(toxic) AS toxic FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || c.c || d.c || e.c AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
bits AS (SELECT c, 1 << (ascii(c) - 65) AS bit FROM x),
s AS (SELECT o, k AS step, (SELECT bit FROM bits WHERE c = o[k]) AS own, (SELECT coalesce(sum(bit), 0)::INT FROM bits WHERE contains(o[1:k - 1], c)) AS before FROM o, (SELECT unnest(range(1, 6)) AS k)),
r AS (SELECT part, o, step, own, coalesce(sum(n) FILTER (mask & (own | before) = 0), 0) AS kept, coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS removed,
  coalesce(sum(n) FILTER (mask & own <> 0 AND mask & before <> 0), 0) AS redundant, coalesce(sum(n) FILTER (mask = own), 0) AS unique_fails,
  coalesce(sum(good) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS good_lost, coalesce(sum(toxic) FILTER (mask & own <> 0 AND mask & before = 0), 0) AS toxic_lost FROM m, s GROUP BY ALL)
SELECT part, o AS filter_order, CAST(step AS INTEGER) AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
 CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""

LINES = r"""WITH l AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM l),
s AS (SELECT k, min(doc_id) AS first FROM k WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
g AS (SELECT doc_id, pos, line, s.first IS NOT NULL AND s.first <> doc_id AS gone FROM k LEFT JOIN s USING (k))
SELECT doc_id, count(*) AS n_lines, count_if(gone)::BIGINT AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256 FROM g GROUP BY doc_id"""
