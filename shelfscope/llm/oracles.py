"""DuckDB SQL for the conversation trie, the repeats across documents and the
periodic runs: the results as their contracts state them, by plain search."""

from __future__ import annotations

#: Unsigned crc32 of a number's decimal text, bit by bit.
CRC = """xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(string_split({x}::VARCHAR, ''),
    lambda ch: list_transform(range(8), lambda b: ((ord(ch)::BIGINT >> b) & 1)::BIGINT)))),
    lambda c, b: xor(c >> 1, CASE WHEN xor(c & 1, b) = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

#: Every prefix as a node, subtree sums by joining each node to its prefixes.
OP11 = f"""
WITH t AS (
    SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS n
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, list(struct_pack(r := r, x := x) ORDER BY n) AS turns, {CRC.format(x='conv_id')} % 6 AS h FROM t GROUP BY conv_id
), seqs AS (
    SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS seq
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 100
), prefixes AS (
    SELECT conv_id, d, seq[1:d] AS node, len(seq) = d AS ends FROM (SELECT *, unnest(range(len(seq) + 1)) AS d FROM seqs)
), nodes AS (
    SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(array_to_string(list_sort(list(conv_id) FILTER (WHERE ends)), ','), '')) AS ends_sha256,
           (count(*) - 1) * coalesce(length(any_value(node[d].x)), 0) AS value
    FROM prefixes GROUP BY node, d
), kids AS (
    SELECT p.node, p.d, p.conv_id, p.n_convs, p.ends_sha256, p.value, count(c.d) AS n_children
    FROM nodes p LEFT JOIN nodes c ON c.d = p.d + 1 AND c.node[1:p.d] = p.node GROUP BY ALL
), sums AS (
    SELECT above, k, sum((n_children = 0)::BIGINT) AS n_leaves, sum(value) AS saved_tokens
    FROM (SELECT *, node[1:k] AS above FROM (SELECT *, unnest(range(d + 1)) AS k FROM kids)) GROUP BY above, k
)
SELECT n.conv_id, n.d::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves::BIGINT AS n_leaves,
       s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM kids n JOIN sums s ON s.above = n.node AND s.k = n.d LEFT JOIN nodes u ON u.d = n.d - 1 AND n.d > 0 AND u.node = n.node[1:n.d - 1]
"""

#: Every 50-byte string with the smallest document that it starts in.
OP12 = """
WITH b AS (
    SELECT row_number() OVER () AS k, doc_id, encode(coalesce(text, '')) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), win AS (
    SELECT k, doc_id, i, x[i + 1:i + 50] AS s FROM (SELECT *, unnest(range(n - 49)) AS i FROM b WHERE doc_id IS NOT NULL)
), firsts AS (SELECT s, min(doc_id) AS f FROM win GROUP BY s
), hits AS (
    SELECT k, i, lag(i) OVER (PARTITION BY k ORDER BY i) AS before FROM win JOIN firsts USING (s) WHERE f < doc_id
), parts AS (
    SELECT k, i, sum((before IS NULL OR i > before + 50)::INTEGER) OVER (PARTITION BY k ORDER BY i) AS part FROM hits
), spans AS (
    SELECT k, min(i) AS a, max(i) + 50 AS e FROM parts GROUP BY k, part
), pieces AS (
    SELECT k, a, e, coalesce(lag(e) OVER (PARTITION BY k ORDER BY a), 0) AS since FROM spans
), kept AS (
    SELECT k, sum(e - a) AS n_removed, count(*) AS n_spans, max(e) AS last, string_agg(hex(x[since + 1:a]), '' ORDER BY a) AS body
    FROM pieces JOIN b USING (k) GROUP BY k
)
SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(body || hex(x[last + 1:n]), hex(x)))) AS kept_sha256
FROM b LEFT JOIN kept USING (k)
"""

#: Every lag of every text; a stretch inside one of smaller period is none.
OP13 = f"""
WITH w0 AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w, {CRC.format(x='doc_id')} AS h FROM documents
), w1 AS (SELECT *, len(w) AS n, h // 10 AS g FROM w0
), w2 AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a FROM w1
), w3 AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM w2
), docs AS (
    SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % p + 1] END) END AS w
    FROM w3
), lags AS (
    SELECT doc_id, n, w, unnest(range(1, n // 3 + 1)) AS p FROM docs WHERE n >= 24
), same AS (
    SELECT doc_id, p, unnest(list_filter(range(n - p), lambda i: w[i + 1] = w[i + p + 1])) AS i FROM lags
), islands AS (
    SELECT doc_id, p, i, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM same
), stretches AS (
    SELECT doc_id, p, min(i) AS start, count(*) + p AS length FROM islands GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(24, 3 * p)
), runs AS (
    SELECT * FROM stretches s WHERE NOT EXISTS (
        SELECT 1 FROM stretches q WHERE q.doc_id = s.doc_id AND q.p < s.p AND q.start <= s.start AND q.start + q.length >= s.start + s.length)
), best AS (
    SELECT * FROM runs r WHERE NOT EXISTS (
        SELECT 1 FROM runs q WHERE q.doc_id = r.doc_id AND (q.length * r.p > r.length * q.p
            OR (q.length * r.p = r.length * q.p AND (q.start < r.start OR (q.start = r.start AND q.p < r.p)))))
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || p || chr(10), '' ORDER BY start, p) AS txt,
           list(struct_pack(s := start + p, e := start + length)) AS gone FROM runs GROUP BY doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0)::BIGINT AS n_runs, b.start::BIGINT AS start, b.length::BIGINT AS length, b.p::BIGINT AS period,
       (1000 * b.length // b.p)::BIGINT AS exponent_milli, sha256(coalesce(l.txt, '')) AS runs_sha256,
       sha256(CASE WHEN l.gone IS NULL THEN array_to_string(d.w, ' ') ELSE array_to_string(list_transform(
           list_filter(range(d.n), lambda i: len(list_filter(l.gone, lambda x: i >= x.s AND i < x.e)) = 0), lambda i: d.w[i + 1]), ' ') END) AS collapsed_sha256
FROM docs d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id
"""
