"""SQL (DuckDB) that states what corpus queries return, from the tables alone and by plain definitions instead of their methods."""

from __future__ import annotations

#: Base 32 of a hex digest of 40 digits: 32 groups of five bits, each from two neighbouring digits.
BASE32 = """array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((
    (strpos('0123456789abcdef', substr({hex}, 1 + (i * 5) // 4, 1)) - 1) * 16 + strpos('0123456789abcdef', substr({hex}, 2 + (i * 5) // 4, 1)) - 1)
    >> (3 - (i * 5) % 4)) & 31)::int, 1)), '')"""

#: The checksum of a number's digits, bit by bit.
CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295], flatten(list_transform(string_split({text}, ''), lambda c:
    list_concat([ascii(c)::bigint], list_transform(range(0, 8), lambda x: -1::bigint))))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x) ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END))"""

WORDS = r"len(regexp_extract_all({text}, '[^\x20\x09-\x0D]+'))"

ORACLE: dict[str, str] = {}

ORACLE["op11_warc_records"] = f"""
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
firsts AS (SELECT payload, min(page_id) AS first FROM payloads GROUP BY payload)
SELECT page_id, strlen(payload)::bigint AS payload_bytes, {BASE32.format(hex="sha1(payload)")} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN firsts USING (payload)"""

ORACLE["op12_filter_audit"] = r"""
WITH given AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
firsts AS (SELECT text, min(doc_id) AS first FROM given GROUP BY text),
split AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM given JOIN firsts USING (text)),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
docs AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         concat(CASE WHEN len(words) < 100 THEN 'A' END, CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' END,
                CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) THEN 'C' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' END, CASE WHEN first < split.doc_id THEN 'E' END) AS fails
  FROM split LEFT JOIN marks ON split.doc_id = marks.doc_id),
counts AS (SELECT part, fails, good, toxic, count(*) AS n FROM docs GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
orders AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
           WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT filter_order, step, filter_order[step] AS own, filter_order[1:step - 1] AS before FROM orders, (SELECT unnest(range(1, 6)) AS step)),
rows AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (NOT regexp_matches(fails, '[' || before || own || ']')) AS kept,
         sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') = fails) AS removed,
         sum(n) FILTER (contains(fails, own) AND translate(fails, before, '') <> fails) AS redundant,
         sum(n) FILTER (fails = own) AS unique_fails,
         sum(n) FILTER (good AND contains(fails, own) AND translate(fails, before, '') = fails) AS good_lost,
         sum(n) FILTER (toxic AND contains(fails, own) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step::int AS step, coalesce(kept, 0)::bigint AS kept, coalesce(removed, 0)::bigint AS removed, coalesce(redundant, 0)::bigint AS redundant,
       coalesce(unique_fails, 0)::bigint AS unique_fails, coalesce(good_lost, 0)::bigint AS good_lost, coalesce(toxic_lost, 0)::bigint AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, own)::bigint AS shapley
FROM rows"""
ORACLE["op13_prefix_trie"] = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, text) AS turns,
               ({CRC32.format(text="conv_id::varchar")} % 4)::int AS h FROM turns GROUP BY conv_id),
rebuilt AS (SELECT own.conv_id, list_concat(coalesce(base.turns, [])[1:own.h], own.turns[own.h + 1:]) AS turns
            FROM own LEFT JOIN own AS base ON base.conv_id = own.conv_id - own.conv_id % 20),
prefixes AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt),
paths AS (SELECT conv_id, n, depth, md5(turns[1:depth]::json::varchar) AS node, md5(turns[1:depth - 1]::json::varchar) AS above,
                 CASE WHEN depth = 0 THEN '' ELSE turns[depth].text END AS last FROM prefixes),
nodes AS (SELECT depth, node, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value({WORDS.format(text="last")}) AS words,
                 coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (n = depth), '') AS ends FROM paths GROUP BY depth, node),
families AS (SELECT nodes.*, parent.conv_id AS parent_conv_id, (SELECT count(*) FROM nodes AS child WHERE child.depth = nodes.depth + 1 AND child.above = nodes.node) AS n_children
             FROM nodes LEFT JOIN nodes AS parent ON parent.depth = nodes.depth - 1 AND parent.node = nodes.above),
subtrees AS (SELECT paths.depth, paths.node, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
             FROM families JOIN paths ON paths.conv_id = families.conv_id AND paths.depth <= families.depth GROUP BY paths.depth, paths.node)
SELECT conv_id, depth::bigint AS depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::bigint AS saved_tokens, sha256(ends) AS ends_sha256
FROM families JOIN subtrees USING (depth, node)"""
