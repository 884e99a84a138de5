"""DuckDB SQL that the queries of this subpackage are held against."""

QUALITY = r"""
WITH base AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 2)) AS i FROM base)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM rep CROSS JOIN (VALUES (0), (1), (2)) v(k) GROUP BY doc_id),
m AS (
  SELECT b.doc_id, lang, source, t, coalesce(list_sum(list_transform(w, lambda x: length(x) * length(x))), 0) AS squares, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines
  FROM base b LEFT JOIN cov USING (doc_id)),
r AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS r1, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS r2,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS r3, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS r4,
         CASE WHEN n_lines > 0 THEN n_words / n_lines ELSE 0 END AS r6,
         CASE WHEN n_words > 0 THEN sqrt(greatest(0.0, squares / n_words - (word_chars / n_words) * (word_chars / n_words))) ELSE 0 END AS r7
  FROM m),
votes AS (SELECT DISTINCT lang, source, t, n_words, r1, r2, r3, r4, r6, r7 FROM r WHERE NOT base_failed),
long AS (SELECT lang, source, unnest([1, 2, 3, 4, 5, 6, 7]) AS k, unnest([r1, r2, r3, r4, n_words, r6, r7]) AS x FROM votes),
g AS (SELECT lang, source, k, list_sort(list(x)) AS s FROM long GROUP BY ALL),
gl AS (SELECT lang, k, list_sort(list(x)) AS s FROM long GROUP BY ALL),
ga AS (SELECT k, list_sort(list(x)) AS s FROM long GROUP BY ALL),
pick AS (
  SELECT p.lang, p.source, ga.k,
         CASE WHEN len(g.s) >= 50 THEN g.s WHEN len(gl.s) >= 50 THEN gl.s WHEN len(ga.s) >= 50 THEN ga.s END AS s
  FROM (SELECT DISTINCT lang, source FROM r) p CROSS JOIN ga
  LEFT JOIN gl ON gl.lang IS NOT DISTINCT FROM p.lang AND gl.k = ga.k
  LEFT JOIN g ON g.lang IS NOT DISTINCT FROM p.lang AND g.source IS NOT DISTINCT FROM p.source AND g.k = ga.k),
q AS (
  SELECT lang, source, k, s[CAST(ceil(0.25 * len(s)) AS BIGINT)] AS low, s[CAST(ceil(0.5 * len(s)) AS BIGINT)] AS mid, s[CAST(ceil(0.75 * len(s)) AS BIGINT)] AS high FROM pick),
f AS (SELECT lang, source, k, low, high FROM q WHERE k <= 4),
n AS (SELECT lang, source, max(CASE WHEN k = 5 THEN mid END) AS words, max(CASE WHEN k = 6 THEN mid END) AS line, max(CASE WHEN k = 7 THEN mid END) AS spread FROM q GROUP BY ALL),
bad AS (
  SELECT DISTINCT r.doc_id FROM r
  JOIN f ON f.lang IS NOT DISTINCT FROM r.lang AND f.source IS NOT DISTINCT FROM r.source
  JOIN n ON n.lang IS NOT DISTINCT FROM r.lang AND n.source IS NOT DISTINCT FROM r.source,
  LATERAL (SELECT CASE k WHEN 1 THEN r1 WHEN 2 THEN r2 WHEN 3 THEN r3 ELSE r4 END AS x,
                  3.0 * greatest((high - low) * sqrt(greatest(1.0, words / n_words)), CASE k WHEN 1 THEN 1.0 / n_words WHEN 2 THEN 1.0 / n_lines WHEN 3 THEN 2.0 * line / n_words ELSE spread / sqrt(n_words) END) AS reach) v
  WHERE NOT base_failed AND (x > high + reach OR k = 4 AND x < low - reach))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM r
"""

URL_RULES = r"""
WITH u AS (
  SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), '') AS h,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
p AS (SELECT row_number() OVER () AS k, page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, path FROM u),
rules(rhost, rpath, verdict) AS (VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')),
fit AS (
  SELECT k, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fit USING (k)
"""

WARC = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t, sha1(coalesce(html, '')) AS h FROM pages),
d AS (
  SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(((CAST('0x' || substr(h, 1 + (i // 8) * 10, 10) AS BIGINT) >> (35 - 5 * (i % 8))) & 31) + 1 AS BIGINT), 1)), '') AS payload_digest
  FROM p),
k AS (SELECT payload_digest, min(page_id) AS keeper FROM d GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM d JOIN k USING (payload_digest)
"""

DECONTAMINATION = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
b AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS g
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM bw WHERE len(w) > 0)),
d AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM dw CROSS JOIN (SELECT DISTINCT n FROM b) WHERE len(w) >= n)),
hit AS (SELECT doc_id, d.n, i, item_id FROM d JOIN b ON d.g = b.g AND d.n = b.n),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY 1),
it AS (SELECT doc_id, list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))) AS items FROM hit GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""

FILL_IN_MIDDLE = r"""
WITH h AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
d AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2, CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4
  FROM h),
c AS (
  SELECT doc_id, t, w, CAST(len(w) AS BIGINT) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a, greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
p AS (SELECT doc_id, t, n, form, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CAST(CASE WHEN form <> 'plain' THEN length(pre) END AS BIGINT) AS prefix_chars, CAST(CASE WHEN form <> 'plain' THEN length(mid) END AS BIGINT) AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""

COLLOCATIONS = r"""
WITH t AS (
  SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda v: v <> '') AS w FROM (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
f AS (
  SELECT lang, w[i:i + k - 1] AS g, count(*) AS c
  FROM (SELECT lang, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM p, (VALUES (1), (2), (3), (4), (5)) v(k) WHERE len(w) >= k) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM f WHERE len(g) = 1 GROUP BY lang),
c AS (SELECT lang, g, c AS a FROM f WHERE len(g) BETWEEN 2 AND 5 AND c >= 100),
held AS (SELECT lang, s, max(a) AS most FROM (SELECT lang, a, unnest([g[2:], g[:len(g) - 1]]) AS s FROM c) GROUP BY ALL),
kept AS (SELECT c.lang, g, a, n FROM c JOIN n USING (lang) LEFT JOIN held ON held.lang = c.lang AND s = g WHERE coalesce(most, 0) < a),
cut AS (SELECT lang, g, a, n, k, g[1:k] AS x, g[k + 1:] AS y FROM (SELECT *, unnest(generate_series(1, len(g) - 1)) AS k FROM kept)),
s AS (
  SELECT cut.lang, cut.g, a, n, k, fl.c AS l, fr.c AS r, (CAST(1000 AS HUGEINT) * a * n) // (CAST(fl.c AS HUGEINT) * fr.c) AS score
  FROM cut JOIN f fl ON fl.lang = cut.lang AND fl.g = x JOIN f fr ON fr.lang = cut.lang AND fr.g = y),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
r AS (SELECT *, array_to_string(g, ' ') AS phrase, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank FROM best)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score FROM r WHERE rank <= 2000
"""
