"""SQL (DuckDB dialect) for the corpus queries that SQL can express, written from the contracts.

There is none for op1 (edit distances of all pairs of lines), op2 (profiles), op4
(markup), op5 and op12 (tokenizers), op8 (places of matches) and op13 (checksums of words); their
tests compare them with brute force.
"""

from __future__ import annotations

import re
import unicodedata

WORDS = r"regexp_extract_all({t}, '[^\x20\x09-\x0D]+')"

OP3 = r"""
WITH low AS (
  SELECT 'd' AS side, row_number() OVER () AS r, CAST(doc_id AS VARCHAR) AS id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), CAST(item_id AS VARCHAR), text FROM benchmark),
split AS (
  SELECT side, r, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
sizes AS (SELECT DISTINCT least(13, len(w)) AS n FROM split WHERE side = 'b' AND len(w) > 0),
windows AS (
  SELECT side, r, id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM split, sizes, unnest(range(1, len(w) - n + 2)) AS t(i)
  WHERE len(w) >= n AND (side = 'd' OR n = least(13, len(w)))),
found AS (
  SELECT d.r, d.i, d.n, b.id AS item FROM windows d JOIN windows b ON d.g = b.g AND d.n = b.n
  WHERE d.side = 'd' AND b.side = 'b'),
hits AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, n)) AS t(k) GROUP BY r),
items AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY r)
SELECT CAST(s.id AS BIGINT) AS doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM split s LEFT JOIN hits USING (r) LEFT JOIN items USING (r) WHERE side = 'd'
"""

OP6 = r"""
WITH rows_ AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
marked AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\]|/?SYS>>)', '\1\\\2\3', 'g') AS r,
         regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|/?SYS>>)', '\1\\\2\3', 'g') AS t FROM rows_),
g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS learned,
         sum(length('<|im_start|><|im_sep|><|im_end|>') + length(r) + length(t)) AS n
  FROM marked GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(learned) AS BIGINT) AS loss_chars,
       sha256(learned) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM g
"""

# From unicodedata's names: full stops, question and exclamation marks, dandas and section ends of any script, but
# those that stand inside sentences, and the letters of Thai and Lao, which have no such marks.
_ENDS = [
    chr(c) for c in range(0x10000)
    if re.search(r"FULL STOP|QUESTION MARK|EXCLAMATION|\bDANDA\b|ELLIPSIS|SIGN (SECTION|KHAN|BARIYOOSAN)", unicodedata.name(chr(c), ""))
    and unicodedata.category(chr(c)) == "Po" and not unicodedata.name(chr(c)).startswith("INVERTED")
]
_MARK = "[" + re.escape("".join(_ENDS)) + "ก-ฺเ-๎ກ-ໟ]"

OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {WORDS.format(t="t")} AS w FROM d),
windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS g FROM w, unnest(range(1, len(w) - 6)) AS x(i) WHERE len(w) > 8),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) AS x(k) GROUP BY r),
lines AS (
  SELECT r, line, {WORDS.format(t="line")} AS w,
         length(regexp_replace(line, '[^!-/:-@\[-`{{-~]', '', 'g')) AS marks
  FROM d, unnest(string_split(t, chr(10))) AS x(line)),
judged AS (
  SELECT r, line, w,
         NOT regexp_matches(line, '{_MARK}') OR marks > len(w)
         OR len(list_filter(w, lambda x: x IN ('|', '»', '›', '>', '•', '·'))) >= 2
            AND 5 * len(list_filter(w, lambda x: x IN ('|', '»', '›', '>', '•', '·'))) >= len(w)
         OR regexp_matches(line, '(?i)(lorem ipsum|enable javascript|uses? cookies|cookie policy|privacy policy|terms of (use|service)'
            || '|all rights reserved|sign up for our|subscribe to our|click here|skip to (main )?content|back to top'
            || '|powered by wordpress)') AS fails
  FROM lines WHERE len(w) > 0),
per AS (
  SELECT r, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN fails THEN length(array_to_string(w, '')) ELSE 0 END) AS lost
  FROM judged GROUP BY r),
base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM w LEFT JOIN repeated USING (r) LEFT JOIN per USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * lost <= 50 * word_chars AS kept
FROM base
"""

OP9 = rf"""
WITH RECURSIVE split AS (
  SELECT row_number() OVER () AS r, doc_id,
         {WORDS.format(t="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
grams AS (
  SELECT DISTINCT r, doc_id, array_to_string(w[i:i + 2], ' ') AS g
  FROM split, unnest(range(1, greatest(2, len(w) - 1))) AS x(i) WHERE len(w) > 0),
sizes AS (SELECT r, doc_id, count(*) AS n FROM grams GROUP BY ALL),
shared AS (SELECT a.r AS ra, b.r AS rb, count(*) AS both_ FROM grams a JOIN grams b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
links AS (
  SELECT ra, rb FROM shared JOIN sizes a ON ra = a.r JOIN sizes b ON rb = b.r WHERE 100 * both_ >= 90 * (a.n + b.n - both_)),
reach(r, other) AS (SELECT r, r FROM split UNION SELECT reach.r, links.rb FROM reach JOIN links ON links.ra = reach.other),
first_ AS (SELECT reach.r, min(doc_id) AS component_id FROM reach JOIN split ON split.r = reach.other GROUP BY reach.r)
SELECT s.doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM split s JOIN first_ USING (r) LEFT JOIN sizes USING (r)
"""


def _strength(level: str, nodes: str) -> str:
    """Moments of one level: (strength)."""
    return f"""
m_{level} AS (SELECT sum(n) AS total, sum(k) / sum(n) AS mu FROM {nodes} WHERE n > 0),
v_{level} AS (
  SELECT max(mu) * (1 - max(mu)) AS pq, sum(n / total * (k / n - mu) ** 2) AS s, sum(n / total * (1 - n / total)) AS u,
         sum(n / total * (1 - n / total) / n) AS v
  FROM {nodes}, m_{level} WHERE n > 0),
s_{level} AS (
  SELECT round(CASE WHEN pq * (u - v) = 0 OR pq IS NULL OR (s - pq * v) / (pq * (u - v)) <= 0.001 THEN 1000.0
                    WHEN (s - pq * v) / (pq * (u - v)) >= 0.5 THEN 1.0
                    ELSE 1 / ((s - pq * v) / (pq * (u - v))) - 1 END, 6) AS w
  FROM v_{level})"""


OP10 = rf"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
o AS (SELECT host, quality = 1 AND toxic = 0 AS good FROM p JOIN labels ON page_id = doc_id),
names AS (SELECT DISTINCT host, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') AS bare FROM p),
hosts AS (
  SELECT host, string_split(bare, '.') AS parts, len(string_split(bare, '.')) AS n_parts,
         CASE WHEN regexp_matches(bare, '^[0-9.]+$|^\[') THEN 0
              WHEN regexp_matches(bare, '(^|\.)(ac|co|com|edu|gov|net|org)\.[a-z]{{2}}$') THEN 2 ELSE 1 END AS n_suffix
  FROM names),
placed AS (
  SELECT host, CASE WHEN n_suffix = 0 THEN '' ELSE array_to_string(parts[-n_suffix:], '.') END AS suffix,
         CASE WHEN n_suffix = 0 THEN array_to_string(parts, '.')
              ELSE array_to_string(parts[-least(n_parts, n_suffix + 1):], '.') END AS domain
  FROM hosts),
h AS (SELECT host, domain, suffix, count(good) AS n, count(*) FILTER (WHERE good) AS k
      FROM placed LEFT JOIN o USING (host) GROUP BY ALL),
dm AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
sf AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM dm GROUP BY ALL),
{_strength("h", "h")},{_strength("d", "dm")},{_strength("s", "sf")},
top AS (SELECT suffix, ((SELECT (sum(k) + 1) / (sum(n) + 2) FROM sf) * w + k) / (w + n) AS m FROM sf, s_s),
mid AS (SELECT domain, suffix, (m * w + k) / (w + n) AS m FROM dm JOIN top USING (suffix), s_d),
low AS (SELECT host, (m * w + k) / (w + n) AS mean, w + n AS weight FROM h JOIN mid USING (domain, suffix), s_h),
rules(text, action, rhost, rpath) AS (VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
  ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
fits AS (
  SELECT page_id, arg_max(text, length(text)) AS rule, arg_max(action, length(text)) AS action
  FROM p JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY page_id)
SELECT page_id, host, path, rule,
       coalesce(action, CASE WHEN mean + 1.645 * sqrt(mean * (1 - mean) / (weight + 1)) < 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM p LEFT JOIN fits USING (page_id) LEFT JOIN low USING (host)
"""

#: Assignment i (the nearest of centroids i for each vector) and centroids i + 1.
_ROUND = """
a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, c) AS c, any_value(dist) AS dist
  FROM (SELECT r, c, dist, min(dist) OVER (PARTITION BY r) AS least
        FROM (SELECT r, c, sum((v.x - m.x) * (v.x - m.x)) AS dist FROM v JOIN c{i} m USING (d) GROUP BY r, c))
  WHERE dist = least GROUP BY r),
s{i} AS (SELECT c, d, sum(x) AS s, count(*) AS n FROM v JOIN a{i} USING (r) GROUP BY c, d),
c{j} AS MATERIALIZED (
  SELECT c, d, coalesce((s - ((s % n) + n) % n) // n, x) AS x FROM c{i} LEFT JOIN s{i} USING (c, d)),"""

OP11 = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: abs(CAST(e AS DOUBLE)) < 131072)) = 64),
v AS MATERIALIZED (
  SELECT r, d, CAST(floor(1024 * CAST(embedding[d + 1] AS DOUBLE)) AS BIGINT) AS x FROM kept, unnest(range(64)) AS t(d)),
seeds AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), r) - 1 AS c FROM kept QUALIFY c < 8),
c0 AS MATERIALIZED (SELECT c, d, x FROM seeds JOIN v USING (r)),{"".join(_ROUND.format(i=i, j=i + 1) for i in range(11))}
names AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY d)) AS centroid_sha256 FROM c10 GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(dist AS BIGINT) AS distance,
       CAST(sum(dist) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(dist) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM kept JOIN a10 USING (r) JOIN names USING (c)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_decontamination": OP3,
        "op6_chat_format": OP6,
        "op7_quality_rules": OP7,
        "op9_ngram_jaccard": OP9,
        "op10_url_filter": OP10,
        "op11_centroid_clustering": OP11,
    }
