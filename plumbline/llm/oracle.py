"""The queries SQL can express, for DuckDB, written from their definitions."""

TEXT = "coalesce(text, '')"

EOL = "chr(13) || chr(10)"
OP1 = f"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
r AS (SELECT page_id, url, 'WARC/1.0' || {EOL} || 'WARC-Type: resource' || {EOL} || 'WARC-Record-ID: <urn:page:' ||
             coalesce(page_id::VARCHAR, '') || '>' || {EOL} || 'WARC-Target-URI: ' || coalesce(url, '') || {EOL} ||
             'Content-Type: text/html' || {EOL} || 'Content-Length: ' || strlen(h)::VARCHAR || {EOL} || {EOL} || h || {EOL} || {EOL} AS s
      FROM p),
k AS (SELECT page_id, url, strlen(s) AS n, sha256(s) AS sha256 FROM r),
o AS (SELECT *, row_number() OVER (ORDER BY page_id, url, sha256) - 1 AS i FROM k)
SELECT page_id, url, i // 1024 AS file_id,
       coalesce(sum(n) OVER (PARTITION BY i // 1024 ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS record_offset,
       n::BIGINT AS record_length, sha256,
       CASE WHEN sha256[1:2] IN ('00', '01') THEN 'corrupt' WHEN sha256[1:2] = '02' THEN 'missing' ELSE 'intact' END AS status
FROM o
"""

OP3 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate({TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, len(w) AS n, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS g2,
             CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS g3
      FROM (SELECT *, unnest(range(1, len(w) + 1)) AS i FROM d)),
c AS (SELECT doc_id, i, greatest(count(*) OVER () - n, 1) AS rest,
             count(*) OVER (PARTITION BY g1) - count(*) OVER (PARTITION BY g1, doc_id) AS c1,
             count(*) OVER (PARTITION BY g2) - count(*) OVER (PARTITION BY g2, doc_id) AS c2,
             count(*) OVER (PARTITION BY g3) - count(*) OVER (PARTITION BY g3, doc_id) AS c3 FROM t),
x AS (SELECT *, lag(c1) OVER (PARTITION BY doc_id ORDER BY i) AS b1, lag(c2) OVER (PARTITION BY doc_id ORDER BY i) AS b2 FROM c),
s1 AS (SELECT *, (CASE WHEN c1 > 0 THEN c1 ELSE 0.4::DOUBLE END) / rest AS p1 FROM x),
s2 AS (SELECT *, CASE WHEN i < 2 THEN p1 WHEN c2 > 0 THEN c2 / b1 ELSE 0.4::DOUBLE * p1 END AS p2 FROM s1),
s3 AS (SELECT *, CASE WHEN i < 3 THEN p2 WHEN c3 > 0 THEN c3 / b2 ELSE 0.4::DOUBLE * p2 END AS p3 FROM s2),
l AS (SELECT doc_id, sum(ln(p3)) AS z FROM s3 GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, round(coalesce(z, 0), 6) AS log_score,
       CASE WHEN len(w) > 0 THEN round(z / len(w), 6) END AS mean_log_score
FROM d LEFT JOIN l USING (doc_id)
"""

OP4 = f"""
WITH t AS (SELECT doc_id, regexp_replace({TEXT}, '[\\x20\\x09-\\x0D]+', ' ', 'g') AS s FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, sha256(s) AS text_sha256
FROM t
"""

#: The measures of op7 as the table m, the verdicts on hosts as v.
QUALITY = f"""
d AS (SELECT doc_id, source, {TEXT} AS s, regexp_extract_all({TEXT}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, x) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM rep, (VALUES (0), (1), (2)) AS k(o) GROUP BY doc_id),
m0 AS (SELECT d.doc_id, source, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
              len(regexp_extract_all(s, '[#*$%&|<>]')) AS n_symbols,
              list_filter(string_split(s, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines,
              coalesce(cov.n, 0) AS n_repeat_words
       FROM d LEFT JOIN cov USING (doc_id)),
m1 AS (SELECT doc_id, source, n_words, word_chars, n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
             n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m0),
m AS (SELECT *, base_failed OR 10 * n_symbols > n_words OR word_chars < 3 * n_words OR word_chars > 10 * n_words
             OR 10 * n_dup_lines > 3 * n_lines AS failed FROM m1),
h AS (SELECT source, count(*)::DOUBLE AS n, count(*) FILTER (failed)::DOUBLE AS f FROM m GROUP BY source),
g AS (SELECT sum(n) AS nn, sum(f) / sum(n) AS mu, sum(n * n) AS sq, count(*) - 1 AS k, sum(f * f / n) AS sp FROM h),
c AS (SELECT *, least(0.5, greatest(1e-6, coalesce(
        ((sp - nn * mu * mu) - mu * (1 - mu) * k) / nullif(mu * (1 - mu) * (nn - sq / nn - k), 0), 1e-6))) AS share FROM g),
v AS (SELECT source, (f + mu * (1 / share - 1)) / (n + (1 / share - 1)) > 0.5 AS rejected FROM h, c)
"""

OP7 = f"""
WITH {QUALITY}
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT failed AND NOT rejected AS kept
FROM m JOIN v ON m.source IS NOT DISTINCT FROM v.source
"""

OP11 = f"""
WITH p AS (SELECT '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+' AS term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS upper, 'abcdefghijklmnopqrstuvwxyz' AS lower),
d AS (SELECT doc_id, regexp_extract_all(translate({TEXT}, upper, lower), term) AS w FROM documents, p),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d),
q AS (SELECT item_id, t, count(*) AS qtf
      FROM (SELECT item_id, unnest(regexp_extract_all(translate({TEXT}, upper, lower), term)) AS t FROM benchmark, p) GROUP BY ALL),
v AS (SELECT doc_id, len(w) AS n, t, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS t FROM d)
      WHERE t IN (SELECT t FROM q) GROUP BY ALL),
k AS (SELECT t, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM v, s GROUP BY t, n_docs),
x AS (SELECT item_id, doc_id, sum(qtf * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN k USING (t) JOIN v USING (t), s GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INT AS rank, doc_id, score
FROM x WHERE score > 0 QUALIFY rank <= 10
"""

OP12 = f"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, {TEXT} AS s, regexp_extract_all({TEXT}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
             (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END) || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END) ||
             (CASE WHEN 100 * len(regexp_extract_all(s, '[A-Z]')) > 3 * length(s) THEN 'C' ELSE '' END) ||
             (CASE WHEN regexp_matches(s, '[#$%&*|]') THEN 'D' ELSE '' END) ||
             (CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY s) THEN 'E' ELSE '' END) AS fails
      FROM t LEFT JOIN l USING (doc_id)),
g AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
o AS (SELECT a.c || b.c || d.c || e.c || h.c AS filter_order FROM c a, c b, c d, c e, c h
      WHERE len(list_distinct([a.c, b.c, d.c, e.c, h.c])) = 5),
st AS (SELECT filter_order, step, filter_order[step] AS x, filter_order[1:step] AS upto, filter_order[1:step - 1] AS before
       FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, x,
             sum(CASE WHEN translate(fails, upto, '') = fails THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN fails = x THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
             sum(CASE WHEN contains(fails, x) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
      FROM g, st GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM r
"""

ORACLE = {"op1_warc_fixity": OP1, "op3_lm_scoring": OP3, "op4_exact_dedup": OP4, "op7_quality_rules": OP7, "op11_lexical_search": OP11, "op12_filter_audit": OP12}
