"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE_SQL = {
    "op5_exact_dedup": r"""
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                   AS text_sha256
            FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, text_sha256
        FROM d WINDOW g AS (PARTITION BY text_sha256)""",
    "op6_line_dedup": r"""
        WITH d AS (
            SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        l AS (
            SELECT doc_id, generate_subscripts(lines, 1) AS pos, unnest(lines) AS line FROM d),
        k AS (
            SELECT doc_id, pos, line, translate(
                regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM l),
        m AS (
            SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS gone
            FROM k)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
               AS kept_sha256
        FROM m GROUP BY doc_id""",
    "op7_source_mixing": r"""
        WITH d AS (
            SELECT doc_id, source,
                   len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
            FROM documents),
        s AS (
            SELECT source, sum(size) AS source_size,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM d GROUP BY source),
        r AS (SELECT *, source_size * 3 AS cap, (source_size * 3) / weight AS ratio FROM s),
        t AS (
            SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))
                      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS try
            FROM r WINDOW before AS (ORDER BY ratio, source NULLS LAST
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        l AS (SELECT arg_min(try, ratio) AS level FROM t WHERE try <= ratio),
        g AS (
            SELECT source, source_size,
                   least(cap::DOUBLE, coalesce(level * weight, cap::DOUBLE)) AS target
            FROM t, l),
        b AS (
            SELECT *, floor(target + 0.5) AS budget,
                   floor(floor(target + 0.5) / greatest(source_size, 1)) AS epochs FROM g),
        o AS (
            SELECT doc_id, size, source, sum(size) OVER (
                       PARTITION BY source ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS start
            FROM d)
        SELECT doc_id, size, source_size::BIGINT AS source_size, target,
               (size * epochs + greatest(0, least(size, budget - epochs * source_size - start)))::BIGINT
               AS taken, o.source
        FROM o JOIN b ON o.source IS NOT DISTINCT FROM b.source""",
    "op10_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        i AS (
            SELECT item_id, regexp_extract_all(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        iw AS (
            SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[p:p + 9], ' ') AS gram
            FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p
                  FROM i WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT n FROM iw),
        dw AS (
            SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram
            FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p
                  FROM d, sizes WHERE len(w) >= n)),
        hits AS (SELECT doc_id, item_id, p, dw.n FROM dw JOIN iw USING (n, gram)),
        covered AS (
            SELECT doc_id, count(DISTINCT q) AS n_hit
            FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
            FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits
                  WHERE item_id IS NOT NULL) GROUP BY doc_id)
        SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op11_prefix_trie": r"""
        WITH ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
        h AS (   -- crc32 of the decimal id, bit by bit
            SELECT conv_id, xor(4294967295, list_reduce(
                       list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
                       lambda s, b: list_reduce(range(8)::UBIGINT[], lambda x, i:
                           xor(x >> 1, 3988292384 * (x & 1)), xor(s, b)),
                       4294967295::UBIGINT)) % 4 AS h
            FROM ids),
        o AS (
            SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
                                 ORDER BY turn NULLS FIRST, role, text) AS turns
            FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
        b AS (
            SELECT o.conv_id, list_concat(coalesce(p.turns[1:h], []), o.turns[h + 1:]) AS s
            FROM o JOIN h USING (conv_id) LEFT JOIN o p ON p.conv_id = o.conv_id - o.conv_id % 20),
        k AS (
            SELECT conv_id, depth, len(s) = depth AS ends, sha256(to_json(s[1:depth])::VARCHAR) AS node,
                   sha256(to_json(s[1:depth - 1])::VARCHAR) AS above,
                   len(regexp_extract_all(s[depth].text, '[^\x20\x09-\x0D]+')) AS words
            FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS depth FROM b)),
        n AS (
            SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
                   (count(*) - 1) * coalesce(any_value(words), 0) AS saved,
                   CASE WHEN depth > 0 THEN any_value(above) END AS above,
                   sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), ''))
                   AS ends_sha256
            FROM k GROUP BY depth, node),
        c AS (SELECT above AS node, depth - 1 AS depth, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL),
        u AS (   -- what each node gives to the nodes above it and to itself
            SELECT k.depth, k.node, sum(n.saved) AS saved, count(*) FILTER (c.n IS NULL) AS leaves
            FROM n LEFT JOIN c USING (depth, node)
            JOIN k ON k.conv_id = n.conv_id AND k.depth <= n.depth
            GROUP BY ALL)
        SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0) AS n_children,
               u.leaves AS n_leaves, u.saved::BIGINT AS saved_tokens, n.ends_sha256
        FROM n JOIN u USING (depth, node) LEFT JOIN c USING (depth, node)
        LEFT JOIN n p ON p.node = n.above AND p.depth = n.depth - 1""",
}
