"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from pulse.llm.licenses import PHRASES, TEMPLATES, THRESHOLD

UPPER_TO_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

URL_FILTER = f"""
WITH rules(rule_verdict, rule_host, rule_path) AS (VALUES
    ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
    ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
parts AS (
    SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), {UPPER_TO_LOWER}), '') AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
fits AS (
    SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
           arg_max(rule_verdict, length(rule_host || rule_path)) AS verdict
    FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
      ON (host = rule_host OR host LIKE '%.' || rule_host) AND starts_with(path, rule_path)
    GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (host, path)
"""

BREAKS = r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def words_of(text: str) -> str:
    lowered = f"translate(coalesce({text}, ''), {UPPER_TO_LOWER})"
    return f"list_filter(regexp_split_to_array({lowered}, {BREAKS}), lambda w: w <> '')"


DECONTAMINATION = f"""
WITH items AS (
    SELECT coalesce(item_id::VARCHAR, '') AS item, {words_of("text")} AS words FROM benchmark),
windows AS (
    SELECT DISTINCT item, least(13, len(words)) AS n,
           array_to_string(list_slice(words, start + 1, start + least(13, len(words))), ' ') AS win
    FROM items, unnest(range(0, greatest(len(words) - 12, 1))) AS t(start)
    WHERE len(words) > 0),
docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, {words_of("text")} AS words FROM documents),
doc_windows AS (
    SELECT row_no, start, n, array_to_string(list_slice(words, start + 1, start + n), ' ') AS win
    FROM docs, (SELECT DISTINCT n FROM windows), unnest(range(0, greatest(len(words) - n + 1, 0))) AS t(start)),
hits AS (SELECT row_no, start, n, item FROM doc_windows JOIN windows USING (n, win)),
words_hit AS (
    SELECT row_no, count(DISTINCT pos) AS n_hit FROM hits, unnest(range(start, start + n)) AS t(pos) GROUP BY row_no),
items_hit AS (
    SELECT row_no, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
    FROM hits GROUP BY row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM docs LEFT JOIN words_hit USING (row_no) LEFT JOIN items_hit USING (row_no)
"""


def license_scan(phrases: tuple, templates: tuple, threshold: float) -> str:
    """Every block of every template is intersected in full, without candidate search."""
    listed = ", ".join(f"('{text}', '{label}', false)" for text, label in phrases)
    listed += ", " + ", ".join(f"('{text}', '{label}', true)" for text, label in templates)
    return f"""
WITH entries(entry, label, is_template) AS (VALUES {listed}),
entry_words AS (
    SELECT label, is_template, string_split(entry, ' ') AS tokens, len(string_split(entry, ' ')) AS span FROM entries),
docs AS (
    SELECT row_number() OVER () AS row_no, doc_id, {words_of("text")} AS words FROM documents),
places AS (
    SELECT row_no, label, start FROM docs, entry_words, unnest(range(0, greatest(len(words) - span + 1, 0))) AS t(start)
    WHERE NOT is_template AND words[start + 1] = tokens[1] AND list_slice(words, start + 1, start + span) = tokens),
blocks AS (
    SELECT row_no, label,
           len(list_intersect(list_distinct(tokens), list_slice(words, start + 1, start + 2 * span)))
           / len(list_distinct(tokens)) AS score
    FROM docs, entry_words, unnest(range(0, len(words), span)) AS t(start) WHERE is_template),
found AS (SELECT row_no, label, score FROM blocks WHERE score >= {threshold} - 1e-9),
by_place AS (
    SELECT row_no, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM places GROUP BY row_no),
by_label AS (
    SELECT row_no, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM (SELECT row_no, label FROM places UNION ALL SELECT row_no, label FROM found) GROUP BY row_no),
best AS (SELECT row_no, max(score) AS score FROM found GROUP BY row_no)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       round(CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(score, 0.0) END::DOUBLE, 6) AS score
FROM docs LEFT JOIN by_place USING (row_no) LEFT JOIN by_label USING (row_no) LEFT JOIN best USING (row_no)
"""


LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, line - 1 AS line, string_split(text, chr(10))[line] AS content
    FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(line)),
worded AS (SELECT doc_id, line, {words_of("content")} AS words FROM lines),
sets AS (
    SELECT doc_id, line, list_sort(list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
           lambda i: array_to_string(list_slice(words, i, i + 4), ' ')))) AS tokens
    FROM worded WHERE len(words) > 0),
first AS (SELECT tokens, min(struct_pack(d := doc_id, l := line)) AS place FROM sets GROUP BY tokens),
numbered AS (SELECT row_number() OVER () AS id, tokens, place FROM first),
spread AS (SELECT id, unnest(tokens) AS token FROM numbered),
pairs AS (SELECT a.id AS a, b.id AS b, count(*) AS shared FROM spread a JOIN spread b ON a.token = b.token AND a.id <> b.id
          GROUP BY a.id, b.id),
alike AS (
    SELECT DISTINCT x.id FROM pairs JOIN numbered x ON x.id = a JOIN numbered y ON y.id = b
    WHERE y.place < x.place AND shared >= 0.8 * (len(x.tokens) + len(y.tokens) - shared) - 1e-9),
gone AS (
    SELECT doc_id, line FROM sets JOIN numbered USING (tokens) LEFT JOIN alike USING (id)
    WHERE alike.id IS NOT NULL OR struct_pack(d := doc_id, l := line) <> place),
by_doc AS (
    SELECT l.doc_id, count(g.line) AS n_removed, string_agg(g.line::VARCHAR, ',' ORDER BY l.line) AS removed_lines,
           string_agg(CASE WHEN g.line IS NULL THEN content END, chr(10) ORDER BY l.line) AS kept
    FROM lines l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.line = l.line GROUP BY l.doc_id)
SELECT doc_id, coalesce(len(string_split(text, chr(10))), 0)::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(removed_lines, '') AS removed_lines, CASE WHEN text IS NOT NULL THEN coalesce(kept, '') END AS text
FROM documents LEFT JOIN by_doc USING (doc_id)
"""


FILTER_AUDIT = """
WITH texts AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS txt,
           list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
    FROM documents),
flags AS (
    SELECT doc_id, part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
           100 * length(regexp_replace(txt, '[^A-Z]', '', 'g')) > 5 * length(txt) AS c,
           regexp_matches(txt, '[#$%&*|]') AS d,
           coalesce(doc_id > min(doc_id) OVER (PARTITION BY txt), false) AS e
    FROM texts),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
masks AS (
    SELECT part, a, b, c, d, e, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
    FROM flags LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT o1.x || o2.x || o3.x || o4.x || o5.x AS filter_order
    FROM letters o1, letters o2, letters o3, letters o4, letters o5
    WHERE len(list_distinct([o1.x, o2.x, o3.x, o4.x, o5.x])) = 5),
ranked AS (
    SELECT *, least(CASE WHEN a THEN strpos(filter_order, 'A') ELSE 9 END, CASE WHEN b THEN strpos(filter_order, 'B') ELSE 9 END,
                    CASE WHEN c THEN strpos(filter_order, 'C') ELSE 9 END, CASE WHEN d THEN strpos(filter_order, 'D') ELSE 9 END,
                    CASE WHEN e THEN strpos(filter_order, 'E') ELSE 9 END) AS removed_at,
           a::INT + b::INT + c::INT + d::INT + e::INT AS n_failed
    FROM masks, orders),
steps AS (
    SELECT *, substr(filter_order, step, 1) AS letter,
           CASE substr(filter_order, step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails
    FROM ranked, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
counted AS (
    SELECT part, filter_order, step, letter, sum(CASE WHEN removed_at > step THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN removed_at = step THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN fails AND removed_at < step THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails AND n_failed = 1 THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN removed_at = step THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN removed_at = step THEN toxic ELSE 0 END) AS toxic_lost
    FROM steps GROUP BY ALL)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
       redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
       toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

CRC32 = """list_reduce(
        list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
        lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], range(8)),
            lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""

PREFIX_TRIE = f"""
WITH talks AS (
    SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
                         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, turns, xor({CRC32}, 4294967295) % 6 AS h FROM talks),
rebuilt AS (
    SELECT a.conv_id, list_concat(coalesce(list_slice(b.turns, 1, a.h), []), list_slice(a.turns, a.h + 1, len(a.turns))) AS turns
    FROM heads a LEFT JOIN talks b ON b.conv_id = a.conv_id - a.conv_id % 100),
keyed AS (
    SELECT conv_id, turns, array_to_string(list_transform(turns, lambda x: md5(length(x.r) || ':' || x.r || x.t)), ',') AS keys
    FROM rebuilt),
members AS (
    SELECT conv_id, depth, substr(keys, 1, greatest(33 * depth - 1, 0)) AS node, coalesce(length(turns[depth].t), 0) AS chars,
           len(turns) = depth AS ends
    FROM keyed, unnest(range(0, len(turns) + 1)) AS d(depth)),
nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) * (count(*) - 1) AS own_saved,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
    FROM members GROUP BY node, depth),
parents AS (SELECT *, substr(node, 1, greatest(33 * (depth - 1) - 1, 0)) AS parent FROM nodes),
children AS (SELECT parent AS node, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY parent),
above AS (
    SELECT substr(node, 1, greatest(33 * up - 1, 0)) AS node, sum(own_saved) AS saved_tokens,
           count(*) FILTER (n_children IS NULL) AS n_leaves
    FROM (SELECT node, depth, own_saved, n_children FROM nodes LEFT JOIN children USING (node)), unnest(range(0, depth + 1)) AS u(up)
    GROUP BY ALL)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM parents n JOIN above USING (node) LEFT JOIN children USING (node) LEFT JOIN nodes p ON n.depth > 0 AND p.node = n.parent
"""

ORACLES: dict[str, str] = {
    "op1_license_scan": license_scan(PHRASES, TEMPLATES, THRESHOLD),
    "op2_line_dedup": LINE_DEDUP,
    "op4_decontamination": DECONTAMINATION,
    "op9_url_filter": URL_FILTER,
    "op12_filter_audit": FILTER_AUDIT,
    "op13_prefix_trie": PREFIX_TRIE,
}
