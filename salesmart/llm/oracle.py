"""SQL that checks the queries which SQL can express, run by DuckDB on the same tables."""

from __future__ import annotations

import functools

OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t, length(coalesce(text, '')) AS n FROM documents
), k AS (
  SELECT doc_id, t,
    first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM k
"""

OP8 = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
    length(regexp_replace(regexp_replace(html, '<[^>]*>', '', 'g'), '[ \t\n\r]+', '', 'g')) AS chars, length(html) AS page_chars
  FROM pages
), o AS (
  SELECT page_id, host, path, CASE WHEN chars >= 400 AND chars >= 0.25 * page_chars THEN 1 WHEN chars IS NOT NULL THEN 0 END AS good FROM p
), h0 AS (
  SELECT host, count(good) AS n, coalesce(sum(good), 0) AS good, string_split(regexp_replace(host, ':[0-9]*$', ''), '.') AS l FROM o GROUP BY host
), h1 AS (
  SELECT *, CASE WHEN len(l) > 1 AND l[-2] || '.' || l[-1] IN ('co.uk', 'com.au', 'co.jp', 'com.br') THEN l[-2] || '.' || l[-1] ELSE l[-1] END AS suffix FROM h0
), h AS (
  SELECT host, n, good, suffix, array_to_string(l[greatest(1, len(l) - len(string_split(suffix, '.'))):], '.') AS domain FROM h1
), d AS (
  SELECT suffix, domain, sum(n) AS n, sum(good) AS good FROM h GROUP BY suffix, domain
), s AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good FROM d GROUP BY suffix
), t AS (
  SELECT (coalesce(sum(good), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM s
), s1 AS (
  SELECT s.*, t.m FROM s, t
), sw AS (
  SELECT CASE WHEN coalesce(sum(n * (n - 1) * m * (1 - m)), 0) = 0 THEN 1.0 ELSE
    1 / least(greatest((sum((good - n * m) ** 2) - sum(n * m * (1 - m))) / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.999) - 1 END AS w FROM s1
), d1 AS (
  SELECT d.*, (s1.good + w * s1.m) / (s1.n + w) AS m FROM d JOIN s1 USING (suffix), sw
), dw AS (
  SELECT CASE WHEN coalesce(sum(n * (n - 1) * m * (1 - m)), 0) = 0 THEN 1.0 ELSE
    1 / least(greatest((sum((good - n * m) ** 2) - sum(n * m * (1 - m))) / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.999) - 1 END AS w FROM d1
), h2 AS (
  SELECT h.*, (d1.good + w * d1.m) / (d1.n + w) AS m FROM h JOIN d1 USING (suffix, domain), dw
), hw AS (
  SELECT CASE WHEN coalesce(sum(n * (n - 1) * m * (1 - m)), 0) = 0 THEN 1.0 ELSE
    1 / least(greatest((sum((good - n * m) ** 2) - sum(n * m * (1 - m))) / sum(n * (n - 1) * m * (1 - m)), 1e-4), 0.999) - 1 END AS w FROM h2
), r AS (
  SELECT host, n, (good + w * m) / (n + w) AS mean, n + w + 1 AS size FROM h2, hw
), j AS (
  SELECT page_id, host, path, n, mean + 2.0 * sqrt(mean * (1 - mean) / size) AS bound,
    CASE WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
      WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM o JOIN r USING (host)
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' WHEN bound < 0.5 THEN 'block' ELSE 'allow' END AS verdict,
  CAST(n AS BIGINT) AS n_labelled
FROM j
"""

OP10 = r"""
WITH c AS (
  SELECT conv_id, row_number() OVER w AS i, role, text, count(*) OVER (PARTITION BY conv_id) AS n,
    max(CASE WHEN role = 'assistant' THEN 1 END) OVER (PARTITION BY conv_id) AS replied
  FROM (SELECT conv_id, coalesce(turn, -1) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), b AS (
  SELECT conv_id, min(CASE WHEN role = 'assistant' THEN i END) AS f, max(CASE WHEN role = 'assistant' THEN i END) AS l, max(i) AS n FROM c GROUP BY conv_id
), r AS (
  SELECT c.conv_id, c.i, c.role, CASE WHEN c.i = b.l THEN x.text ELSE c.text END AS text
  FROM c JOIN b USING (conv_id) LEFT JOIN c x ON x.conv_id = c.conv_id AND x.i = b.f
  WHERE b.l IS NULL OR c.i < b.l OR (c.i = b.l AND b.f < b.l)
), k AS (
  SELECT b.conv_id, coalesce(min(CASE WHEN r.i IS NULL OR r.role <> c.role OR r.text <> c.text THEN c.i END) - 1, max(b.n)) AS common
  FROM b JOIN c USING (conv_id) LEFT JOIN r ON r.conv_id = c.conv_id AND r.i = c.i GROUP BY b.conv_id
), turns AS (
  SELECT 'chosen' AS side, conv_id, i, role, text FROM c UNION ALL SELECT 'rejected', conv_id, i, role, text FROM r
), prompts AS (
  SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i) AS prompt
  FROM c JOIN k USING (conv_id) WHERE i <= common GROUP BY conv_id
), rest AS (
  SELECT side, conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY i) AS completion,
    string_agg((length(role) + 13) || 'm,' || (length(text) + 11) || CASE WHEN role = 'assistant' THEN 't' ELSE 'm' END, ',' ORDER BY i) AS mask
  FROM turns JOIN k USING (conv_id) WHERE i > common GROUP BY side, conv_id
)
SELECT k.conv_id, s.side, CAST(k.common AS BIGINT) AS n_common_turns, coalesce(p.prompt, '') AS prompt,
  coalesce(rest.completion, '') AS completion, coalesce(rest.mask, '') AS mask
FROM k CROSS JOIN (VALUES ('chosen'), ('rejected')) AS s(side)
LEFT JOIN prompts p ON p.conv_id = k.conv_id LEFT JOIN rest ON rest.conv_id = k.conv_id AND rest.side = s.side
"""

#: The CRC-32 sums of the bytes 1, 2, 4 ... 128 without the usual complements; those of other bytes are combinations.
BIT_SUMS = (1996959894, 3993919788, 124634137, 249268274, 498536548, 997073096, 1994146192, 3988292384)


def crc32(text: str) -> str:
    """SQL for the CRC-32 of the UTF-8 bytes of a text column: a fold over its bytes."""
    step = functools.reduce(lambda a, b: f"xor({a}, {b})", [f"((xor(c, b) >> {k}) & 1) * {v}" for k, v in enumerate(BIT_SUMS)])
    listed = f"list_transform(range(0, octet_length(encode({text}))), lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {listed}), lambda c, b: xor(c >> 8, {step})), 4294967295)"


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12 = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS l FROM documents
), w AS (
  SELECT true AS raw, r, l FROM d UNION ALL SELECT false, 0, {_WORDS} FROM benchmark
), g AS (
  SELECT raw, r, unnest(list_concat(list_concat(l, list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])),
    list_transform(range(1, len(l) - 1), lambda i: l[i] || ' ' || l[i + 1] || ' ' || l[i + 2]))) AS g FROM w
), n AS (
  SELECT raw, r, g, count(*) AS n FROM g GROUP BY raw, r, g
), b AS (
  SELECT g, {crc32('g')} % 10000 AS bucket FROM (SELECT DISTINCT g FROM n)
), f AS (
  SELECT raw, r, bucket, sum(n) AS n FROM n JOIN b USING (g) GROUP BY raw, r, bucket
), c AS (
  SELECT bucket, CAST(coalesce(sum(n) FILTER (raw), 0) AS DOUBLE) AS s, CAST(coalesce(sum(n) FILTER (NOT raw), 0) AS DOUBLE) AS t FROM f GROUP BY bucket
), a AS (
  SELECT sum(s) AS s_all, sum(t) AS t_all FROM c
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + 10000) / ((s + 1) * (t_all + 10000)))) AS BIGINT) AS gain FROM c, a
), weighed AS (
  SELECT r, sum(n) AS n_features, sum(n * gain) AS weight FROM f JOIN gains USING (bucket) WHERE raw GROUP BY r
), scored AS (
  SELECT doc_id, len(l) AS n_words, CAST(coalesce(n_features, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN weighed USING (r)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST) AS place, count(*) FILTER (n_words >= 20) OVER () AS able FROM scored
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * able // 100 THEN place END AS rank FROM ranked
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": OP5, "op8_url_filter": OP8, "op10_preferences": OP10, "op12_resampling": OP12}
