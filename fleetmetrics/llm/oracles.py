"""The operators' results in DuckDB SQL, where SQL can express them on whole tables."""

import re

from fleetmetrics.llm import secret_index

OP7 = r"""
WITH rows AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM rows WINDOW w AS (PARTITION BY text_sha256)
"""

#: Windows of item words against windows of document words of the same length.
OP1 = r"""
WITH w AS (
  SELECT item_id::VARCHAR AS item, ws, least(13, len(ws)) AS k FROM (
    SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark) WHERE len(ws) > 0
), windows AS (
  SELECT DISTINCT item, k, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM (SELECT item, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM w)
), lengths AS (SELECT DISTINCT k FROM windows),
d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), placed AS (
  SELECT doc_id, k, i, array_to_string(ws[i : i + k - 1], ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, lengths)
), hits AS (SELECT doc_id, i, k, item FROM placed JOIN windows USING (k, win)),
counted AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM hits) GROUP BY doc_id
), listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


#: Base 32 of a SHA-1: five hexadecimal digits are four of its digits.
OP4 = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS h,
    max(page_id) OVER (PARTITION BY payload) AS newest
  FROM p
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + ((('0x' || substr(h, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
  CASE WHEN page_id = newest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = newest THEN NULL ELSE newest END AS refers_to
FROM d
"""


def _either_case(pattern: str) -> str:
    """(?i:...) spelled out: here it would also fold letters beyond ASCII."""
    whole, inner = re.search(r"\(\?i:([^()]*)\)", pattern).group(0, 1)
    return pattern.replace(whole, f"(?:{re.sub('[a-z]', lambda m: f'[{m[0].upper()}{m[0]}]', inner)})")


def _op5() -> str:
    found = []
    for rank, rule in enumerate(secret_index.RULES):
        pattern = _either_case(rule.pattern) if "(?i:" in rule.pattern else rule.pattern
        quoted = pattern.replace("'", "''")
        found.append(
            f"SELECT r, {rank} AS rank, '{rule.kind}' AS kind, regexp_extract_all(t, '{quoted}') AS ms, "
            f"list_transform(regexp_extract_all(t, '{quoted}', {rule.group}), lambda x: length(x) >= {rule.least}) AS fits, "
            f"string_split_regex(t, '{quoted}') AS gaps FROM d WHERE regexp_matches(t, '{quoted}')"
        )
    base = ", ".join(f"'{r.kind}'" for r in secret_index.BASE)
    counts = ", ".join(f"coalesce(count(*) FILTER (kind = '{r.kind}'), 0) AS n_{r.kind}" for r in secret_index.BASE)
    kept = ", ".join(f"coalesce(n_{r.kind}, 0) AS n_{r.kind}" for r in secret_index.BASE)
    one = "kind || ':' || a || ':' || b, ',' ORDER BY a, rank"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({" UNION ALL ".join(found)}),
placed AS (
  SELECT r, rank, kind, fits[i] AS fits, length(ms[i]) AS n,
    list_sum(list_transform(gaps[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS a
  FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM matches)
), spans AS (SELECT r, rank, kind, a::BIGINT AS a, (a + n)::BIGINT AS b FROM placed WHERE fits),
listed AS (
  SELECT r, {counts}, string_agg({one}) FILTER (kind IN ({base})) AS base, string_agg({one}) AS spans
  FROM spans GROUP BY r
)
SELECT doc_id, {kept}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN listed USING (r)
"""


OP12 = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
    list_transform(range(0, 4), lambda i: ('0x' || substr(sha256('1:' || coalesce(doc_id::VARCHAR, '')), 1 + 8 * i::INT, 8))::BIGINT) AS h
  FROM documents
), c AS (
  SELECT doc_id, t, n, least(h[1] % (n + 1), h[2] % (n + 1)) AS low, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS high,
    CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
      WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN low END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN high - low END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t
    WHEN 'psm' THEN '<P>' || substr(t, 1, low) || '<S>' || substr(t, high + 1) || '<M>' || substr(t, low + 1, high - low)
    ELSE '<S>' || substr(t, high + 1) || '<P>' || substr(t, 1, low) || '<M>' || substr(t, low + 1, high - low) END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM c
"""

#: The CRC-32 of every distinct word, a byte at a time: eight shifts for each.
OP13 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
), b AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark
), dw AS (SELECT doc_id, unnest(ws) AS w FROM d),
bytes AS (
  SELECT w, list_transform(range(0, (length(hex(encode(w))) // 2)::BIGINT),
    lambda i: ('0x' || substr(hex(encode(w)), 1 + 2 * i::INT, 2))::BIGINT) AS own
  FROM (SELECT w FROM dw UNION SELECT w FROM b)
), buckets AS (
  SELECT w, xor(list_reduce(own, lambda crc, byte:
    list_reduce(range(0, 8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(crc, byte)),
    4294967295), 4294967295) % 10000 AS bucket
  FROM bytes
), s AS (SELECT bucket, count(*) AS s FROM dw JOIN buckets USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN buckets USING (w) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT sum(s) FROM s) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * (coalesce((SELECT sum(t) FROM t), 0) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)
), weights AS (
  SELECT doc_id, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM dw JOIN buckets USING (w) JOIN gains USING (bucket) GROUP BY doc_id
), scores AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (doc_id)
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM scores WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score,
  CASE WHEN rank <= (SELECT count(*) FROM ranked) * 10 // 100 THEN rank END AS rank
FROM scores LEFT JOIN ranked USING (doc_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_decontamination": OP1,
        "op4_warc": OP4,
        "op5_secret_index": _op5(),
        "op7_content_sort": OP7,
        "op12_fill_middle": OP12,
        "op13_resample": OP13,
    }
