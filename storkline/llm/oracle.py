"""SQL counterparts of the registered queries, where SQL can express them."""

from __future__ import annotations

BLANKS = r"[\x20\x09-\x0D]+"

LINE_DEDUP = """
WITH line AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 7))::BIGINT AS h, max(pos) OVER (PARTITION BY doc_id) AS last FROM line
), rolled AS (
  SELECT *, coalesce(lag(h) OVER w, 0) * 31 + h AS r FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), ended AS (
  SELECT *, pos = last OR pos >= 1 AND last - pos >= 2 AND r < lag(r) OVER w AND r <= lead(r) OVER w AS ends
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY pos)
), numbered AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM ended
), chunk AS (
  SELECT doc_id, k, string_agg(line, chr(10) ORDER BY pos) AS bytes, min(pos) AS start, count(*) AS n
  FROM numbered GROUP BY doc_id, k
), whole AS (
  SELECT doc_id, list(line ORDER BY pos) AS every, count(*) AS total FROM line GROUP BY doc_id
), near AS (
  SELECT *, list_reverse(every[greatest(coalesce(lag(start) OVER w, 0) - 2, 0) + 1:start]) AS before,
    every[start + n + 1:least(coalesce(lead(start + n) OVER w + 2, total), total)] AS after
  FROM chunk JOIN whole USING (doc_id) WINDOW w AS (PARTITION BY doc_id ORDER BY k)
), judged AS (
  SELECT *, row_number() OVER w AS nth, first_value(before) OVER w AS b, first_value(after) OVER w AS a
  FROM near WHERE n >= 2 WINDOW w AS (PARTITION BY bytes ORDER BY doc_id, k)
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(
    start - len(list_filter(range(1, 1 + least(len(before), len(b))), lambda i : before[1:i] = b[1:i])),
    start + n + len(list_filter(range(1, 1 + least(len(after), len(a))), lambda i : after[1:i] = a[1:i])))) AS pos
  FROM judged WHERE nth > 1
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS text FROM line ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
), sizes AS (
  SELECT doc_id, sum(n)::INT AS n_lines, count(*)::INT AS n_chunks FROM chunk GROUP BY doc_id
)
SELECT doc_id, n_lines, n_chunks, n_lines - coalesce(n, 0)::INT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM sizes LEFT JOIN kept USING (doc_id)
"""

EXACT_DEDUP = rf"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '{BLANKS}', ' ', 'g') AS text FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
  sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)
"""

SUBSTRING_DEDUP = rf"""
WITH t AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{BLANKS}'), lambda w : w <> '') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(len(words) - 19)) AS i FROM t WHERE len(words) >= 20
), judged AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(words[i + 1:i + 20], ' ') ORDER BY doc_id, i) > 1 AS later
  FROM starts
), gone AS (
  SELECT DISTINCT doc_id, i + j AS pos FROM judged, range(20) r(j) WHERE later
), word AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM t
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM word ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""

SHARDING = """
WITH t AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS bytes,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) || substr(md5(coalesce(text, '')), 1, 7))::BIGINT AS h
  FROM documents
), level AS (
  SELECT *, d, sum(bytes) OVER (PARTITION BY d, h >> (60 - d)) AS total FROM t, range(32) r(d)
)
SELECT doc_id, bytes, min(d)::INT AS depth, substr(lpad(bin(h), 60, '0'), 1, min(d)::INT) AS shard
FROM level WHERE total <= 1048576 GROUP BY doc_id, bytes, h
"""

# base32 takes the digest five bits at a time, four digits of it from five hexadecimal ones
WARC = """
WITH t AS (SELECT page_id, coalesce(html, '') AS payload FROM pages), d AS (
  SELECT *, sha1(payload) AS hex, min(page_id) OVER (PARTITION BY payload) AS first FROM t
)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i : substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(hex, (1 + 5 * (i // 4))::INT, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
  CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM d
"""


HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x : floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INT AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN scored USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

FILL_IN_MIDDLE = """
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS token,
    sha256('1:' || doc_id::VARCHAR) AS hex FROM documents
), h AS (
  SELECT *, len(token) AS n, ('0x' || substr(hex, 1, 8))::BIGINT AS h1, ('0x' || substr(hex, 9, 8))::BIGINT AS h2,
    ('0x' || substr(hex, 17, 8))::BIGINT AS h3, ('0x' || substr(hex, 25, 8))::BIGINT AS h4 FROM t
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS z,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h
), part AS (
  SELECT *, coalesce(array_to_string(token[1:a], ''), '') AS p, coalesce(array_to_string(token[a + 1:z], ''), '') AS m,
    coalesce(array_to_string(token[z + 1:n], ''), '') AS s FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM part
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_line_dedup": LINE_DEDUP, "op3_warc": WARC, "op4_substring_dedup": SUBSTRING_DEDUP, "op5_exact_dedup": EXACT_DEDUP,
        "op7_sharding": SHARDING, "op12_hard_negatives": HARD_NEGATIVES, "op13_fill_in_middle": FILL_IN_MIDDLE,
    }
