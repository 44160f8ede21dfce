"""DuckDB SQL of the operators that SQL can express, each stated on its own."""

from __future__ import annotations

# CRC-32 of each single bit of a byte (fixed values of the polynomial EDB88320).
_CRC_BITS = (1996959894, 3993919788, 124634137, 249268274, 498536548, 997073096, 1994146192, 3988292384)


def crc32(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of SQL expression ``text``, folded byte by byte."""
    byte = "xor(a & 255, b)"
    entry = f"(({byte}) & 1) * {_CRC_BITS[0]}"
    for i, bit in enumerate(_CRC_BITS[1:], 1):
        entry = f"xor({entry}, ((({byte}) >> {i}) & 1) * {bit})"
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda y: CAST('0x' || y AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda a, b: xor(a >> 8, {entry}), CAST(4294967295 AS BIGINT)), 4294967295)"


# Base32 of a SHA-1: 32 characters of 5 bits, eight from each 10 hexadecimal digits.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS x, min(page_id) OVER (PARTITION BY h) AS f FROM p)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(((CAST('0x' || substr(x, (i // 8) * 10 + 1, 10) AS BIGINT) >> CAST(35 - 5 * (i % 8) AS INT)) & 31) AS INT) + 1, 1)), '') AS payload_digest,
  CASE WHEN f IS NOT NULL AND f IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN f IS NOT NULL AND f IS DISTINCT FROM page_id THEN f END AS refers_to
FROM d
"""

# One recursion step a row: up to two insertions, then delete, keep or re-role;
# each state keeps its cheapest (cost, audit) and the lines written so far.
CONVERSATIONS = rf"""
WITH RECURSIVE c AS (
  SELECT coalesce(CAST(conv_id AS VARCHAR), '-') AS k, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS how
  FROM conversations),
d AS (
  SELECT k, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
    CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, UNNEST(range(CASE WHEN how = 3 THEN 2 ELSE 1 END)) AS copies(n) WHERE how <> 0),
o AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(length(role) || ':' || role || text)) AS i FROM d),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    substr(role, 1, 1) AS ini, lag(substr(role, 1, 1)) OVER (PARTITION BY k ORDER BY i) AS before
  FROM o),
ins(q, n, q2, adds) AS (VALUES
  ('', 0, '', CAST([] AS VARCHAR[])), ('', 1, 'u', ['user:']), ('', 2, 'a', ['user:', 'assistant:']),
  ('s', 0, 's', []), ('s', 1, 'u', ['user:']), ('s', 2, 'a', ['user:', 'assistant:']),
  ('u', 0, 'u', []), ('u', 1, 'a', ['assistant:']), ('u', 2, 'u', ['assistant:', 'user:']),
  ('a', 0, 'a', []), ('a', 1, 'u', ['user:']), ('a', 2, 'a', ['user:', 'assistant:'])),
dp(k, i, q, w) AS (
  SELECT DISTINCT k, CAST(0 AS BIGINT), '', {{'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])}} FROM f
  UNION ALL
  SELECT k, i, q3, min({{'cost': CAST(cost AS BIGINT), 'audit': audit, 'lines': lines}}) FROM (
    SELECT f.k, f.i, 2 + 5 * n + w.cost AS cost, w.audit || repeat('I', n) || 'D' AS audit, w.lines || adds AS lines, q2 AS q3
    FROM dp JOIN f ON f.k = dp.k AND f.i = dp.i + 1 JOIN ins ON ins.q = dp.q
    UNION ALL
    SELECT f.k, f.i, (fault = 'truncated')::INT * 5 + 5 * n + w.cost, w.audit || repeat('I', n) || 'K', w.lines || adds || [role || ':' || text], ini
    FROM dp JOIN f ON f.k = dp.k AND f.i = dp.i + 1 JOIN ins ON ins.q = dp.q
    WHERE fault NOT IN ('blank', 'duplicate') AND ((ini = 's' AND q2 = '') OR ini = CASE q2 WHEN 'u' THEN 'a' ELSE 'u' END)
    UNION ALL
    SELECT f.k, f.i, 1 + (fault = 'truncated')::INT * 5 + 5 * n + w.cost, w.audit || repeat('I', n) || 'R',
      w.lines || adds || [CASE q2 WHEN 'u' THEN 'assistant:' ELSE 'user:' END || text], CASE q2 WHEN 'u' THEN 'a' ELSE 'u' END
    FROM dp JOIN f ON f.k = dp.k AND f.i = dp.i + 1 JOIN ins ON ins.q = dp.q
    WHERE fault NOT IN ('blank', 'duplicate'))
  GROUP BY k, i, q3),
s AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY k),
e AS (
  SELECT k, min({{'cost': dp.w.cost + 5 * ins.n, 'audit': dp.w.audit || repeat('I', ins.n), 'lines': dp.w.lines || adds}}) AS w
  FROM dp JOIN s USING (k) JOIN ins ON ins.q = dp.q WHERE dp.i = s.n AND q2 IN ('', 'a') GROUP BY k)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.w.cost, 0) AS BIGINT) AS cost, coalesce(e.w.audit, '') AS audit,
  sha256(coalesce(array_to_string(e.w.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT k, conv_id FROM c) LEFT JOIN s USING (k) LEFT JOIN e USING (k)
"""

SHARDS = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, CAST(coalesce(strlen(text), 0) + 8 AS BIGINT) AS size, CAST({crc32("coalesce(text, '')")} AS BIGINT) AS text_crc32,
    coalesce(doc_id, 42) AS id FROM documents),
j(n, id, seed, here, nxt) AS (
  SELECT n, id, (CAST(id AS HUGEINT) + 18446744073709551616) % 18446744073709551616, CAST(-1 AS BIGINT), CAST(0 AS BIGINT)
  FROM (SELECT DISTINCT id FROM d), (VALUES (24), (25)) AS v(n)
  UNION ALL
  SELECT n, id, s, nxt, CAST(floor((nxt + 1) * (2147483648.0::DOUBLE / CAST(s // 8589934592 + 1 AS DOUBLE))) AS BIGINT)
  FROM (SELECT *, CAST((CAST(seed AS UHUGEINT) * 2862933555777941757 + 1) % 18446744073709551616 AS HUGEINT) AS s FROM j WHERE nxt < n)),
h AS (SELECT n, id, CAST(max(here) AS INT) AS shard FROM j WHERE nxt >= n GROUP BY n, id)
SELECT doc_id, size, text_crc32, 'key' AS law, a.shard,
  CAST(row_number() OVER (PARTITION BY a.shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS BIGINT) AS slot, b.shard AS grown_shard
FROM d JOIN h AS a ON a.id = d.id AND a.n = 24 JOIN h AS b ON b.id = d.id AND b.n = 25
"""


def _leaf(n_chars: str = "n_chars") -> str:
    fields = ("doc_id", "source", "lang", n_chars, "text")
    return "sha256(" + " || ".join(f"coalesce(strlen(CAST({f} AS VARCHAR)) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


# tree and top hold every level of the groups' trees and of the tree over the
# subroots; a proof is the list of the other nodes of each run, L or R of the node.
MANIFEST = f"""
WITH RECURSIVE l AS (
  SELECT doc_id, coalesce('=' || lang, '-') AS g, {_leaf()} AS leaf,
    CASE WHEN {crc32("CAST(coalesce(doc_id, 0) AS VARCHAR)")} % 7 = 0 AND doc_id IS NOT NULL THEN {_leaf("CAST(n_chars AS HUGEINT) + 1")} END AS tampered
  FROM documents),
p AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l),
tree(g, lvl, pos, d) AS (
  SELECT g, 0, pos, leaf FROM p
  UNION ALL
  SELECT g, max(lvl) + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos))
  FROM (SELECT *, max(pos) OVER (PARTITION BY g) AS last FROM tree) WHERE last > 0 GROUP BY g, pos // 2),
subs AS (SELECT g, max(lvl) AS height, arg_max(d, lvl) AS subroot, row_number() OVER (ORDER BY g) - 1 AS rank FROM tree GROUP BY g),
top(lvl, pos, d) AS (
  SELECT 0, rank, subroot FROM subs
  UNION ALL
  SELECT max(lvl) + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos))
  FROM (SELECT *, max(pos) OVER () AS last FROM top) WHERE last > 0 GROUP BY pos // 2),
r AS (SELECT max(lvl) AS height, arg_max(d, lvl) AS root FROM top),
links AS (
  SELECT p.g, p.pos AS place, t.lvl AS step, coalesce(CASE WHEN t.pos % 2 = 0 THEN 'R' ELSE 'L' END || o.d, '') AS s
  FROM p JOIN subs USING (g) JOIN tree t ON t.g = p.g AND t.lvl < subs.height AND t.pos = p.pos >> t.lvl
    LEFT JOIN tree o ON o.g = t.g AND o.lvl = t.lvl AND o.pos = xor(t.pos, 1)
  UNION ALL
  SELECT p.g, p.pos, subs.height + t.lvl, coalesce(CASE WHEN t.pos % 2 = 0 THEN 'R' ELSE 'L' END || o.d, '')
  FROM p JOIN subs USING (g) CROSS JOIN r JOIN top t ON t.lvl < r.height AND t.pos = subs.rank >> t.lvl
    LEFT JOIN top o ON o.lvl = t.lvl AND o.pos = xor(t.pos, 1)),
proofs AS (SELECT g, place, list(s ORDER BY step) AS ss FROM links GROUP BY g, place),
x AS (
  SELECT doc_id, leaf, subroot, root, sha256(coalesce(array_to_string(list_transform(ss, lambda y: substr(y, 2)), ''), '')) AS proof_sha256,
    list_reduce([coalesce(tampered, leaf)] || coalesce(ss, []), lambda a, y:
      CASE WHEN y = '' THEN sha256(a) WHEN y[1] = 'L' THEN sha256(substr(y, 2) || a) ELSE sha256(a || substr(y, 2)) END) AS folded_root
  FROM p JOIN subs USING (g) CROSS JOIN r LEFT JOIN proofs ON proofs.g = p.g AND proofs.place = p.pos)
SELECT *, folded_root = root AS verified FROM x
"""

ORACLE_SQL = {
    "op8_warc_packages": WARC,
    "op11_conversation_repair": CONVERSATIONS,
    "op12_jump_shards": SHARDS,
    "op13_merkle_manifest": MANIFEST,
}
