"""DuckDB SQL that must give the rows of a query."""

from __future__ import annotations

from tabloom.llm import chat


def _replaced(text: str, role: bool) -> str:
    def quoted(s: str) -> str:
        return "chr(10)" if s == "\n" else "'" + s.replace("'", "''") + "'"

    out = f"replace({text}, '{chat.ESCAPE}', '{chat.ESCAPE}0')"
    for plain, token in chat._tokens(role):
        out = f"replace({out}, {quoted(plain)}, '{token}')"
    return out


_FIXED = len(chat.OPEN) + len(chat.CLOSE) + 2

CHAT = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER w AS pos, sum({_FIXED} + length({_replaced('role', True)}) + length({_replaced('text', False)})) OVER w AS upto
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(upto) FILTER (role = 'assistant'), 0)
    + CASE WHEN arg_max(role, pos) = 'assistant' THEN 0 ELSE max(upto) END AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id"""

WARC = """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
q AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS head FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND head IS NOT NULL AND head IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND head IS DISTINCT FROM page_id THEN head END AS refers_to
FROM q"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Exact near-duplicate components: all pairs that share a shingle, then the reachable ids.
NEAR = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
items AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(unnest(s)) AS h FROM sets),
often AS (SELECT h FROM items GROUP BY h HAVING count(*) > 1),
few AS MATERIALIZED (SELECT * FROM items WHERE h IN (SELECT h FROM often)),
links AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b FROM few a JOIN few b ON a.h = b.h AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION SELECT b, a FROM links),
reached AS (
  SELECT a AS node, a AS top FROM both_ways
  UNION
  SELECT r.node, e.b FROM reached r JOIN both_ways e ON e.a = r.top)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(c.top, s.doc_id) AS component_id, coalesce(c.top, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN (SELECT node, min(top) AS top FROM reached GROUP BY node) c ON c.node = s.doc_id"""

_TERMS = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')")

SEARCH = f"""
WITH query AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
words AS (
  SELECT doc, doc_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents)),
sizes AS (SELECT doc, any_value(doc_id) AS doc_id, count(*) AS n FROM words GROUP BY doc),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
counts AS (SELECT doc, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM query) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total),
parts AS (
  SELECT doc, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms))) AS part
  FROM counts JOIN weights USING (term) JOIN sizes USING (doc), total),
scores AS (
  SELECT item_id, doc, doc_id, CAST(sum(part * times) AS BIGINT) AS score
  FROM query JOIN parts USING (term) GROUP BY ALL HAVING sum(part * times) > 0)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores QUALIFY rank <= 10
"""


def _crc_table() -> str:
    """CRC-32 of each half byte."""
    out = []
    for v in range(16):
        for _ in range(4):
            v = v >> 1 ^ (0xEDB88320 if v & 1 else 0)
        out.append(v)
    return f"{out}::BIGINT[]"


def _crc32(text: str) -> str:
    step = f"xor(({_crc_table()})[CAST(x & 15 AS INTEGER) + 1], x >> 4)"
    byte = step.replace("x &", f"{step.replace('x ', 'xor(c, b) ')} &").replace("x >>", f"{step.replace('x ', 'xor(c, b) ')} >>")
    bytes_of = f"list_transform(string_split({text}, ''), lambda s: CAST(ascii(s) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes_of}), lambda c, b: {byte}), 4294967295)"


def _more(x: str, cost: str, letters: str) -> str:
    """Cost (8 digits) and letters of a repair with an edit put before it."""
    return f"lpad(CAST(CAST(substr({x}, 1, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0') || '{letters}' || substr({x}, 9)"


def _row(state: int, keep: dict[str, int], follows: int) -> str:
    never = "'99999999'"
    kept = " ".join(f"WHEN '{i}' THEN {_more(f'd.s{s}', 'late', 'K')}" for i, s in keep.items())
    return (f"least({_more(f'd.s{state}', '2', 'D')}, CASE WHEN gone THEN {never} ELSE least({_more(f'd.s{follows}', '1 + late', 'R')}, "
            f"CASE initial {kept} ELSE {never} END) END)")


#: Repairs of the rest of a conversation by what the turns before it ended with: nothing, s, u, a.
_CLOSED = (f"least(r0, {_more('r2', '5', 'I')}, {_more('r3', '10', 'II')}) AS s0, least(r1, {_more('r2', '5', 'I')}, {_more('r3', '10', 'II')}) AS s1, "
           f"least(r2, {_more('r3', '5', 'I')}) AS s2, least(r3, {_more('r2', '5', 'I')}) AS s3")

REPAIR = f"""
WITH RECURSIVE base AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM base WHERE kind <> 0),
placed AS (
  SELECT *, coalesce(CAST(conv_id AS VARCHAR), '-') AS c, substr(role, 1, 1) AS initial,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS pos,
    regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS last
  FROM damaged),
judged AS (
  SELECT *, last = '' AS blank, last <> '' AND again > 1 AS duplicate, last NOT IN ('', '.', '!', '?') AND again = 1 AS truncated,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) AS again FROM placed)),
costs AS (SELECT c, pos, initial, blank OR duplicate AS gone, CASE WHEN truncated THEN 5 ELSE 0 END AS late FROM judged),
solved AS (
  SELECT c, pos, {_CLOSED} FROM (
    SELECT c, max(pos) AS pos, '00000000' AS r0, '90000000' AS r1, '90000000' AS r2, '00000000' AS r3 FROM costs GROUP BY c)
  UNION ALL
  SELECT c, pos, {_CLOSED} FROM (
    SELECT d.c, d.pos - 1 AS pos, {_row(0, dict(s=1, u=2), 2)} AS r0, {_row(1, dict(u=2), 2)} AS r1,
      {_row(2, dict(a=3), 3)} AS r2, {_row(3, dict(u=2), 2)} AS r3
    FROM solved d JOIN costs USING (c, pos))),
plan AS (SELECT c, CAST(substr(s0, 1, 8) AS BIGINT) AS cost, substr(s0, 9) AS audit FROM solved WHERE pos = 0),
letters AS (
  SELECT c, i, substr(audit, i, 1) AS letter, sum(CASE substr(audit, i, 1) WHEN 'I' THEN 0 ELSE 1 END) OVER (PARTITION BY c ORDER BY i) AS pos
  FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS i FROM plan)),
kept AS (
  SELECT c, i, letter, role, CASE letter WHEN 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY c ORDER BY i) AS place,
    max(CASE WHEN letter = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c) AS lead
  FROM letters LEFT JOIN placed USING (c, pos) WHERE letter <> 'D'),
texts AS (
  SELECT c, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text,
    chr(10) ORDER BY i) AS t
  FROM kept GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY c)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '-') AS c FROM conversations)
LEFT JOIN counts USING (c) LEFT JOIN plan USING (c) LEFT JOIN texts USING (c)
"""
