"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

from .url_filters import JUNK

OP1 = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS least FROM win) WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM later)),
r AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id),
kept AS (
  SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.p) AS t
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM w WHERE len(w) > 0) k
  LEFT JOIN gone ON k.doc_id = gone.doc_id AND k.p = gone.p WHERE gone.p IS NULL GROUP BY k.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(r.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN r ON w.doc_id = r.doc_id LEFT JOIN kept ON w.doc_id = kept.doc_id
"""

OP2 = r"""
WITH t AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
win AS (SELECT doc_id, i, h[2 * i + 1 : 2 * i + 200] AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 99)) AS i FROM t WHERE length(h) >= 200)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
isl AS (
  SELECT doc_id, i, sum(CASE WHEN p IS NULL OR i > p + 100 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS g
  FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM later)),
span AS (SELECT doc_id, g, min(i) AS a, max(i) + 100 AS b FROM isl GROUP BY doc_id, g),
gap AS (
  SELECT s.doc_id, a, b, h[2 * coalesce(lag(b) OVER (PARTITION BY s.doc_id ORDER BY a), 0) + 1 : 2 * a] AS piece
  FROM span s JOIN t ON s.doc_id = t.doc_id),
cut AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(piece, '' ORDER BY a) AS kept FROM gap GROUP BY doc_id)
SELECT t.doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || h[2 * coalesce(last, 0) + 1 :])) AS kept_sha256
FROM t LEFT JOIN cut ON t.doc_id = cut.doc_id
"""

OP5 = r"""
WITH bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark),
bwin AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents),
lens AS (SELECT DISTINCT n FROM bwin),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
hit AS (SELECT d.doc_id, d.n, d.i, b.item_id FROM dwin d JOIN bwin b ON d.n = b.n AND d.win = b.win),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

OP6 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM (VALUES (0), (1)) v(t)),
safe AS (
  SELECT *, regexp_matches(role || ' ' || text, '<s>|<e>|</s>|\[INST\]|\[/INST\]') OR contains(role, chr(10)) AS esc,
         length(role) + length(text) AS raw,
         length(replace(replace(replace(replace(role, '%', '%25'), '<', '%3C'), '[', '%5B'), chr(10), '%0A'))
         + length(replace(replace(replace(text, '%', '%25'), '<', '%3C'), '[', '%5B')) AS wide
  FROM rows),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS every,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(8 + CASE WHEN esc THEN wide ELSE raw END) AS formatted_chars
  FROM safe GROUP BY conv_id)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(every) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g
"""

LEDGER = r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, lang FROM documents),
w AS (
  SELECT doc_id, text, lang, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM t),
win AS (
  SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM dup) GROUP BY doc_id),
m AS (
  SELECT w.doc_id, lang, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words, len(l) AS n_lines,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) AS n_letter_words,
         len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN (
           'the', 'be', 'to', 'of', 'and', 'that', 'have', 'with', 'der', 'die', 'das', 'und', 'ist', 'nicht',
           'le', 'la', 'les', 'de', 'et', 'est', 'que', 'el', 'los', 'en', 'y', 'es'))) AS n_stop_words,
         len(list_filter(l, lambda x: regexp_matches(x, '^[ \t]*[-*\x{2022}]'))) AS n_bullet_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
         len(list_filter(l, lambda x: regexp_matches(x, '[.!?\x22\x{201D}\x{00BB}][\x20\x09-\x0D]*$'))) AS n_sentence_lines
  FROM w LEFT JOIN rep USING (doc_id)),
b AS (
  SELECT *, CAST(CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
         + CASE WHEN 5 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 10 * n_dup_lines > 5 * n_lines AND n_dup_lines >= 3 THEN 8 ELSE 0 END
         + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
         + CASE WHEN 10 * n_letter_words < 7 * n_words THEN 64 ELSE 0 END + CASE WHEN n_stop_words < 2 AND lang IN ('en', 'de', 'fr', 'es') THEN 128 ELSE 0 END
         + CASE WHEN 10 * n_bullet_lines > 9 * n_lines THEN 256 ELSE 0 END
         + CASE WHEN 10 * n_ellipsis_lines > 3 * n_lines AND n_ellipsis_lines >= 3 THEN 512 ELSE 0 END
         + CASE WHEN 10 * n_sentence_lines < n_lines AND n_lines >= 5 THEN 1024 ELSE 0 END AS BIGINT) AS failed_bits
  FROM m)
"""

OP7 = LEDGER + r"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed_bits & 3 <> 0 AS base_failed, failed_bits = 0 AS kept, failed_bits FROM b
"""

ABLATIONS = LEDGER + r""",
rules(i, name) AS (VALUES (0, 'few_words'), (1, 'repeated_words'), (2, 'many_symbols'), (3, 'duplicate_lines'), (4, 'short_words'), (5, 'long_words'),
  (6, 'few_letters'), (7, 'few_stop_words'), (8, 'bullet_lines'), (9, 'ellipsis_lines'), (10, 'open_lines')),
policies(policy, size) AS (VALUES ('v1', 2), ('v2', 6), ('v3', 11)),
masks AS (
  SELECT policy, name AS without, CAST(2 ** size - 1 - 2 ** i AS BIGINT) AS mask FROM policies JOIN rules ON i < size
  UNION ALL SELECT policy, NULL, CAST(2 ** size - 1 AS BIGINT) FROM policies)
SELECT policy, without, CAST((SELECT count(*) FROM b WHERE failed_bits & mask = 0) AS BIGINT) AS n_kept FROM masks
"""

OP9 = r"""
WITH u AS (
  SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN '' ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u),
r(host, path, verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
best AS (
  SELECT h.page_id, h.host, h.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY h.page_id, h.host, h.path ORDER BY length(r.host || r.path) DESC) AS k
  FROM h LEFT JOIN r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path))
SELECT page_id, host, path, rule,
       coalesce(verdict, CASE WHEN regexp_matches(host || path, '(?i)(?:^|[^a-z0-9])(JUNK)(?:[^a-z0-9]|$)') THEN 'block' ELSE 'allow' END) AS verdict
FROM best WHERE k = 1
""".replace("JUNK", "|".join(f"({a})[^a-z0-9]+({b})" for x, y in JUNK for a, b in ((x.replace(" ", "|"), y.replace(" ", "|")), (y.replace(" ", "|"), x.replace(" ", "|")))))

OP10 = r"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l, text FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(l[i : i + 2], chr(10)) AS s
  FROM (SELECT doc_id, l, unnest(range(1, len(l) - 1)) AS i FROM t WHERE len(l) >= 3)),
later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM win WHERE regexp_matches(s, '[^\x20\x09-\x0D]'))
  WHERE k > 1),
cov AS (SELECT doc_id, list_sort(list_distinct(list(p))) AS r FROM (SELECT doc_id, unnest(range(i - 1, i + 2)) AS p FROM later) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(len(r), 0) AS BIGINT) AS n_removed, coalesce(array_to_string(r, ','), '') AS removed_lines,
       sha256(CASE WHEN r IS NULL THEN coalesce(text, '') ELSE array_to_string(list_filter(l, lambda x, i: NOT list_contains(r, i - 1)), chr(10)) END) AS kept_sha256
FROM t LEFT JOIN cov USING (doc_id)
"""

OP12 = r"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
  FROM (SELECT * FROM e WHERE vec_id % 50 = 0) a JOIN e c ON c.vec_id <> a.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
"""

OP13 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM g a JOIN g b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link),
reach AS (SELECT doc_id AS x, doc_id AS y FROM n UNION SELECT r.x, e.y FROM reach r JOIN edge e ON r.y = e.x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(r.least, w.doc_id) AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN (SELECT x, min(y) AS least FROM reach GROUP BY x) r ON w.doc_id = r.x
"""

ORACLES = {
    "op1_substring_dedup": OP1,
    "op2_suffix_dedup": OP2,
    "op5_decontamination": OP5,
    "op6_chat_formatting": OP6,
    "op7_quality_rules": OP7,
    "quality_ablations": ABLATIONS,
    "op9_url_filters": OP9,
    "op10_line_dedup": OP10,
    "op12_hard_negatives": OP12,
    "op13_jaccard_join": OP13,
}
