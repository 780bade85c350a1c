"""DuckDB twins of the queries that SQL can express on whole tables."""

EXACT_DEDUP = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
WINDOW w AS (PARTITION BY t)
"""

# a prefix is the string of its turns' MD5 digests, 32 digits each, so a subtree is a string prefix
PREFIX_TRIE = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(text, '') AS text, md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS d
    FROM conversations WHERE conv_id IS NOT NULL
), own AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, d) AS place, d, length(text) AS size FROM turns
), convs AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base,
           xor(list_reduce(list_concat([4294967295], list_transform(range(1, length(c) + 1), lambda i: ascii(substr(c, i, 1))::BIGINT)),
                           lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 6 AS h
    FROM (SELECT DISTINCT conv_id, conv_id::VARCHAR AS c FROM own)
), rebuilt AS (
    SELECT c.conv_id, 0 AS half, o.place, o.d, o.size FROM convs c JOIN own o ON o.conv_id = c.base AND o.place <= c.h
    UNION ALL
    SELECT c.conv_id, 1, o.place, o.d, o.size FROM convs c JOIN own o ON o.conv_id = c.conv_id AND o.place > c.h
), prefixes AS (
    SELECT conv_id, row_number() OVER w AS depth, string_agg(d, '') OVER w AS key, size FROM rebuilt
    WINDOW w AS (PARTITION BY conv_id ORDER BY half, place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL
    SELECT conv_id, 0, '', 0 FROM convs
), lens AS (
    SELECT conv_id, max(depth) AS len FROM prefixes GROUP BY conv_id
), nodes AS (
    SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE depth = len), '')) AS ends_sha256
    FROM prefixes JOIN lens USING (conv_id) GROUP BY key, depth
), linked AS (
    SELECT n.*, p.conv_id AS parent_conv_id, p.key AS parent FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.key = left(n.key, (32 * (n.depth - 1))::BIGINT)
), children AS (
    SELECT parent AS key, count(*) AS n_children FROM linked WHERE parent IS NOT NULL GROUP BY parent
), full_nodes AS (
    SELECT l.*, coalesce(c.n_children, 0) AS n_children FROM linked l LEFT JOIN children c USING (key)
)
SELECT v.conv_id, v.depth::BIGINT AS depth, v.parent_conv_id, v.n_convs, v.n_children,
       sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END)::BIGINT AS n_leaves,
       sum((u.n_convs - 1) * u.size)::BIGINT AS saved_tokens, v.ends_sha256
FROM full_nodes v JOIN full_nodes u ON starts_with(u.key, v.key)
GROUP BY v.conv_id, v.depth, v.parent_conv_id, v.n_convs, v.n_children, v.ends_sha256
"""

DIVERGENCE = r"""
WITH docs AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), tokens AS (
    SELECT doc, lang, source, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*)::HUGEINT AS n FROM tokens GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), groups AS (
    SELECT DISTINCT lang, source FROM docs
), counts AS (
    SELECT g.lang, g.source, k.term, count(t.term)::HUGEINT AS n
    FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN tokens t ON t.lang = g.lang AND t.source = g.source AND t.term = k.term
    GROUP BY g.lang, g.source, k.term
), shares AS (
    SELECT lang, source, term, n, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang, source) + count(*) OVER (PARTITION BY lang, source)) AS p FROM counts
), langs AS (
    SELECT lang, term, 1 + (1000000000 * (n + 1)) // (sum(n) OVER (PARTITION BY lang) + count(*) OVER (PARTITION BY lang)) AS q FROM kept
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, 0::HUGEINT AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    UNION ALL
    SELECT a.lang, a.source, b.source, ((a.p - b.p) * (a.p - b.p)) // b.p FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
), found AS (
    SELECT lang, source, 'pair' AS part, item, sum(value)::BIGINT AS value FROM pairs GROUP BY lang, source, item
    UNION ALL
    SELECT s.lang, s.source, 'term', s.term, (((s.p - l.q) * (s.p - l.q)) // l.q)::BIGINT FROM shares s JOIN langs l ON s.lang = l.lang AND s.term = l.term WHERE s.n > 0 AND s.p > l.q
)
SELECT * FROM (SELECT lang, source, part, item, value, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM found)
WHERE part = 'pair' OR rank <= 200
"""
