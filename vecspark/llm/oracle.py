"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations


TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 20
"""


QUALITY = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
         string_split(t, chr(10)) AS lines FROM d),
f AS (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS full_lines FROM w),
n AS (
  SELECT doc_id, i, words[i:i+4] AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM f)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS c FROM n) WHERE c > 1),
p AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM r, (SELECT unnest(range(0, 5)) AS o) GROUP BY doc_id),
l AS (
  SELECT doc_id, unnest(lines) AS line FROM f),
g AS (
  SELECT len(lines) AS n_lines, unnest(list_distinct(list_transform(lines, lambda x: translate(
    regexp_replace(x, '[\x01-\x40\x5B-\x60\x7B-\x7F]+', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')))) AS key FROM f),
h AS (
  SELECT key FROM g WHERE key <> '' GROUP BY key
  HAVING count(*) >= greatest(10, (SELECT (count(*) + 99) // 100 FROM d)) AND count(DISTINCT n_lines) >= 10),
m AS (
  SELECT doc_id, length(line) AS size, line,
         len(string_split_regex(trim(line, ' '), ' +')) AS words,
         len(regexp_extract_all(line, '[|>»•·]')) AS seps, len(regexp_extract_all(line, '[#*$%&|<>]')) AS syms,
         len(regexp_extract_all(line, '[!?*#$%&]{2,}')) AS marks,
         translate(regexp_replace(line, '[\x01-\x40\x5B-\x60\x7B-\x7F]+', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN (SELECT key FROM h) AS common
  FROM l),
k AS (
  SELECT doc_id, sum(size) AS size, sum(CASE WHEN regexp_matches(line, '[^\x20\x09-\x0D]') AND (
           (words <= 12 AND regexp_matches(lower(line), '\b(all rights reserved|licensed under|terms of use|terms of service|privacy policy|cookie policy|accept cookies|enable javascript|lorem ipsum|click here|sign up|log in|subscribe now|share this|read more)\b'))
           OR common OR (seps >= 3 AND seps * 4 >= words) OR syms * 10 >= size OR marks * 5 >= words * 2) THEN 0 ELSE size END) AS left_size
  FROM m GROUP BY doc_id),
c AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(left_size AS DOUBLE) / greatest(size, 1) >= 0.5 AS clean
  FROM f LEFT JOIN p USING (doc_id) LEFT JOIN k USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND clean AS kept
FROM c
"""


NEAR_DEDUP = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3 THEN list_transform(range(1, len(words) - 1), lambda i: words[i:i+2])
                                      WHEN len(words) > 0 THEN [words] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared_n FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared_n >= 85 * (x.n + y.n - shared_n)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
c AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(component_id, w.doc_id) AS component_id,
       w.doc_id = coalesce(component_id, w.doc_id) AS kept
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN c ON c.doc_id = w.doc_id
"""


MIXING = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, text, coalesce('=' || source, 'null') AS task, CAST(coalesce(length(text), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
u AS (SELECT task, greatest(CAST(floor(sqrt(sum(size))) AS BIGINT), 1) AS unit FROM d GROUP BY task),
p AS (SELECT task, 1000 * unit // (SELECT CAST(sum(unit) AS BIGINT) FROM u) AS whole,
             1000 * unit % (SELECT CAST(sum(unit) AS BIGINT) FROM u) AS remainder FROM u),
s AS (
  SELECT task, greatest(whole + CASE WHEN row_number() OVER (ORDER BY remainder DESC, task)
                                      <= 1000 - (SELECT CAST(sum(whole) AS BIGINT) FROM p) THEN 1 ELSE 0 END, 1) AS share,
         row_number() OVER (ORDER BY task) AS number
  FROM p),
l AS (SELECT list(share ORDER BY number) AS shares, CAST(sum(share) AS BIGINT) AS slots, CAST(count(*) AS BIGINT) AS n FROM s),
edf AS (
  SELECT CAST(-1 AS BIGINT) AS slot, CAST(0 AS BIGINT) AS number, list_transform(shares, lambda x: CAST(0 AS BIGINT)) AS taken FROM l
  UNION ALL
  SELECT slot, number, list_transform(taken, lambda c, i: c + CASE WHEN i = number THEN 1 ELSE 0 END)
  FROM (
    SELECT slot + 1 AS slot, taken, list_min(list_transform(range(1, n + 1), lambda i: CASE
             WHEN taken[i] < shares[i] AND taken[i] * slots // shares[i] <= slot + 1
             THEN ((taken[i] + 1) * slots + shares[i] - 1) // shares[i] * 1048576 + i END)) % 1048576 AS number
    FROM edf, l WHERE slot + 1 < slots)),
t AS (SELECT s.task, share, slot, row_number() OVER (PARTITION BY s.number ORDER BY slot) - 1 AS turn
      FROM edf JOIN s ON s.number = edf.number WHERE slot >= 0),
o AS (SELECT doc_id, source, task, CAST(coalesce(sum(size) OVER (PARTITION BY task ORDER BY key, doc_id NULLS LAST, size
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM d),
b AS (SELECT *, start // 65536 AS block FROM o)
SELECT doc_id, source, block, block * slots // t.share AS release, ((block + 1) * slots + t.share - 1) // t.share AS deadline,
       block // t.share * slots + slot AS slot, start
FROM b, l JOIN t ON true WHERE t.task = b.task AND t.turn = b.block % t.share
"""


FIM = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
         CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS a, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(list_slice(units, 1, a), '') AS pre, array_to_string(list_slice(units, a + 1, b), '') AS mid,
         array_to_string(list_slice(units, b + 1, n), '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form = 'plain' THEN NULL ELSE CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""


CHAT = r"""
WITH r AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
p AS (SELECT *, '[\[<]\\*(?:/?(?:SYS|INST|ROLE)\]|TEXT\]|/?s>)' AS control FROM r),
f AS (
  SELECT *, length(text) + len(regexp_extract_all(text, control)) +
         CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 7
                   ELSE 23 + length(role) + len(regexp_extract_all(role, control)) END AS size FROM p)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id
"""


def statements() -> dict[str, str]:
    return {
        "op1_near_dedup": NEAR_DEDUP, "op2_mixing": MIXING, "op5_topk": TOP_K, "op8_quality": QUALITY, "op11_fim": FIM, "op12_chat": CHAT,
    }
