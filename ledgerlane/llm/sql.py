"""SQL twins of the queries that SQL can express, written on their own from the contracts."""

from __future__ import annotations

from .quality import STOP_WORDS

_STOPS = ", ".join(f"'{form}'" for w in sorted(set(STOP_WORDS)) for form in sorted({w, w.capitalize(), w.upper()}))

_OP7 = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (
  SELECT rid, unnest(range(1, len(w) - 6)) AS i, w FROM d WHERE len(w) >= 8),
txt AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS v FROM win),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, v) AS n FROM txt) WHERE n >= 2),
cov AS (SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(0, 8) AS r(k) GROUP BY rid),
m AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
         len(l) AS n_lines, len(list_filter(w, lambda x: x IN ({_STOPS}))) AS n_stop_words
  FROM d LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, n_stop_words,
       NOT base_failed AND word_chars / n_words >= 1.5 AND word_chars / n_words <= 25.0 AND n_symbols / n_words <= 0.1
       AND n_stop_words / n_words >= 0.01 AND n_dup_lines / n_lines <= 0.6 AS kept
FROM b
"""

_ESCAPED = r"""regexp_replace({0}, '([<\[])(\\*)(/?(s>|INST\]))', '\1\\\2\3', 'g')"""

_OP1 = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
f AS (SELECT *, '<s>[INST] ' || {_ESCAPED.format('role')} || ' [/INST]' || {_ESCAPED.format('text')} || '</s>' AS formatted FROM c),
a AS (
  SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss, sum(length(formatted))::BIGINT AS formatted_chars
  FROM f GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM a
"""

_OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
e AS (SELECT a, b FROM p JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id WHERE 100 * c >= 85 * (na.n + nb.n - c)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.doc_id, b FROM reach JOIN both_ways ON other = a)
SELECT r.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(other) AS component_id FROM reach r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id
"""

_OP11 = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, role, text) AS s FROM t GROUP BY conv_id),
crc(conv_id, k, v) AS (
  SELECT conv_id, 0, 4294967295::BIGINT FROM c
  UNION ALL
  SELECT conv_id, k + 1, xor(w >> 1, CASE WHEN w & 1 = 1 THEN 3988292384 ELSE 0 END::BIGINT)
  FROM (SELECT conv_id, k, CASE WHEN k % 8 = 0 THEN xor(v, ascii(substr(conv_id::VARCHAR, k // 8 + 1, 1))::BIGINT) ELSE v END AS w FROM crc WHERE k < 8 * length(conv_id::VARCHAR))),
h AS (SELECT conv_id, xor(v, 4294967295) % 4 AS h FROM crc WHERE k = 8 * length(conv_id::VARCHAR)),
b AS (
  SELECT c.conv_id, list_concat(coalesce(x.s, [])[1:h], c.s[h + 1:]) AS s
  FROM c JOIN h USING (conv_id) LEFT JOIN c x ON x.conv_id = c.conv_id - c.conv_id % 20),
p AS (
  SELECT conv_id, d, md5(to_json(s[1:d])::VARCHAR) AS k, CASE WHEN d > 0 THEN md5(to_json(s[1:d - 1])::VARCHAR) END AS up, len(s) = d AS ends,
         CASE WHEN d > 0 THEN len(regexp_extract_all(s[d].t, '[^\x20\x09-\x0D]+')) ELSE 0 END AS w
  FROM (SELECT conv_id, s, unnest(range(0, len(s) + 1)) AS d FROM b)),
n AS (
  SELECT k, d, any_value(up) AS up, any_value(w) AS w, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY k, d),
kids AS (SELECT up, count(*) AS m FROM n WHERE up IS NOT NULL GROUP BY up),
below AS (SELECT DISTINCT a.k AS top, z.k AS k FROM p a JOIN p z ON a.conv_id = z.conv_id AND z.d >= a.d),
sums AS (
  SELECT top, sum(CASE WHEN kids.m IS NULL THEN 1 ELSE 0 END)::BIGINT AS n_leaves, sum((n_convs - 1) * w)::BIGINT AS saved_tokens
  FROM below JOIN n ON n.k = below.k LEFT JOIN kids ON kids.up = n.k GROUP BY top)
SELECT n.conv_id, n.d AS depth, o.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.m, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM n LEFT JOIN n o ON o.k = n.up LEFT JOIN kids ON kids.up = n.k JOIN sums ON sums.top = n.k
"""

_OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT rid, unnest(range(1, len(w) - 33)) AS i, w FROM d WHERE len(w) >= 35),
txt AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS v FROM win),
rep AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY v) AS n FROM txt) WHERE n >= 2),
cov AS (SELECT rid, list(DISTINCT i + k) AS gone FROM rep, range(0, 35) AS r(k) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(CASE WHEN gone IS NULL THEN array_to_string(w, ' ')
                   ELSE coalesce(array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])), lambda x: x[1]), ' '), '') END) AS kept_sha256
FROM d LEFT JOIN cov USING (rid)
"""

SQL = {"op1_chat_format": _OP1, "op7_quality_rules": _OP7, "op8_jaccard_join": _OP8, "op11_prefix_trie": _OP11, "op13_substring_dedup": _OP13}
