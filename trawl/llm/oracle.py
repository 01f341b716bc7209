"""DuckDB SQL of the operators that SQL can express."""
from __future__ import annotations

from trawl.llm import line_dedup, mixing

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"

CHAT = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before,
         length(replace(replace(replace(text, '\', '\\'), '<turn', '<\turn'), '</turn', '<\/turn')) AS escaped FROM rows)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(escaped + CASE WHEN before IS NULL OR before <> role THEN length('<turn >') + length(role) + length('</turn>') + 1
                               ELSE length('<turn+>') END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

MIXING = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_WORDS}')), 0) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS draw FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, [{', '.join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight,
             source_size * {mixing.MAX_REPEAT} AS cap FROM s),
l AS (SELECT *, (sum(source_size) OVER () * CAST({mixing.SHARE} AS DOUBLE) - coalesce(sum(cap) OVER before, 0))
                / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS own_level FROM w
      WINDOW before AS (ORDER BY CAST(cap AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(CAST(cap AS DOUBLE), max(own_level) OVER () * weight) AS target FROM l),
r AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0 ELSE target / source_size END AS rate FROM t),
c AS (
  SELECT d.doc_id, d.size, r.source, r.source_size, r.target, k.seed,
         CAST(floor(rate) AS BIGINT) + CASE WHEN (draw + seed * {(1 << 52) // mixing.SEEDS}) % {1 << 52} < (rate - floor(rate)) * CAST({1 << 52} AS DOUBLE)
                                            THEN 1 ELSE 0 END AS copies
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source, (SELECT unnest(range({mixing.SEEDS})) AS seed) k),
best AS (
  SELECT source, arg_min(seed, (off, seed)) AS seed FROM (
    SELECT source, seed, abs(sum(copies * size) - any_value(target)) AS off FROM c GROUP BY source, seed) GROUP BY source)
SELECT c.doc_id, CAST(c.size AS BIGINT) AS size, c.source_size, c.target, CAST(c.copies * c.size AS BIGINT) AS taken
FROM c JOIN best ON c.source IS NOT DISTINCT FROM best.source AND c.seed = best.seed
"""

LINES = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row_no, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, row_no, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM d),
k AS (SELECT *, translate(trim(line, {_SPACE}), '{_UPPER}', '{_LOWER}') AS key FROM l),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= {line_dedup.MIN_CHARS} GROUP BY key
      HAVING count(DISTINCT row_no) >= {line_dedup.MIN_DOCS}),
m AS (SELECT k.*, f.key IS NOT NULL AND k.doc_id IS DISTINCT FROM f.last AS dropped FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(sum(CAST(dropped AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY row_no, doc_id
"""

def _fields(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return " || ".join(f"coalesce(CAST(strlen({v}) AS VARCHAR) || ':' || {v}, '-')" for v in values)


# Of the decimal digits of doc_id, bit by bit: the polynomial is the one of crc32.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: xor(c >> 1, 3988292384 * (c & 1)))))"""


def _tree(name: str, levels: int) -> str:
    """CTEs name_0 (given) to name_<levels>, and the sides of each node in its run."""
    out = []
    for k in range(levels):
        out.append(f"""{name}_{k + 1} AS MATERIALIZED (
  SELECT g, pos // 8 AS pos, CAST(ceil(any_value(size) / 8.0) AS BIGINT) AS size,
         CASE WHEN any_value(size) > 1 THEN sha256(string_agg(node, '' ORDER BY pos)) ELSE any_value(node) END AS node
  FROM {name}_{k} GROUP BY g, pos // 8)""")
        out.append(f"""{name}_side_{k} AS MATERIALIZED (
  SELECT n.g, n.pos, n.size, array_to_string(list_filter(r.nodes, lambda x, i: i <= n.pos % 8), '') AS l,
         array_to_string(list_filter(r.nodes, lambda x, i: i > n.pos % 8 + 1), '') AS r
  FROM {name}_{k} n JOIN (SELECT g, pos // 8 AS run, list(node ORDER BY pos) AS nodes FROM {name}_{k} GROUP BY g, pos // 8) r
    ON n.g = r.g AND n.pos // 8 = r.run)""")
    return ",\n".join(out)


def _climb(name: str, levels: int, g: str, pos: str, start: int) -> str:
    """CTEs climb_<start + 1> ... with the proof so far and the root folded so far."""
    return ",\n".join(f"""climb_{start + k + 1} AS MATERIALIZED (
  SELECT c.* EXCLUDE (proof, h), c.proof || s.l || s.r AS proof, CASE WHEN s.size > 1 THEN sha256(s.l || c.h || s.r) ELSE c.h END AS h
  FROM climb_{start + k} c JOIN {name}_side_{k} s ON c.{g} = s.g AND c.{pos} // {8 ** k} = s.pos)""" for k in range(levels))


# As many levels as 8^10 leaves of a language and 8^5 languages need.
MERKLE = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce('v' || lang, '') AS g, sha256({_fields("text")}) AS node,
         CASE WHEN {_CRC} % 3 = 0 THEN sha256({_fields(f"translate(text, '{_UPPER}', '{_LOWER}')")}) END AS other FROM documents),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, node) - 1 AS pos, count(*) OVER (PARTITION BY g) AS size FROM d),
low_0 AS (SELECT g, pos, size, node FROM leaves),
{_tree("low", 10)},
top_0 AS MATERIALIZED (SELECT '' AS g, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS size, node, g AS name FROM low_10),
{_tree("top", 5)},
climb_0 AS (SELECT l.*, t.pos AS top_pos, '' AS top_g, t.node AS subroot, '' AS proof, coalesce(l.other, l.node) AS h
            FROM leaves l JOIN top_0 t ON l.g = t.name),
{_climb("low", 10, "g", "pos", 0)},
{_climb("top", 5, "top_g", "top_pos", 10)}
SELECT c.doc_id, c.node AS leaf, c.subroot, r.node AS root, sha256(c.proof) AS proof_sha256, c.h AS folded_root, c.h = r.node AS verified
FROM climb_15 c, top_5 r
"""

_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

SEARCH = f"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS no, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERMS}') AS terms FROM documents),
size AS (SELECT count(*) AS docs, CAST(sum(len(terms)) AS BIGINT) AS terms FROM d WHERE len(terms) > 0),
i AS MATERIALIZED (
  SELECT row_number() OVER () AS item, item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_TERMS}') AS terms
  FROM (SELECT DISTINCT item_id, text FROM benchmark)),
q AS MATERIALIZED (SELECT item, item_id, term, count(*) AS times FROM (SELECT item, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
t AS MATERIALIZED (
  SELECT no, doc_id, n, term, count(*) AS tf FROM (SELECT no, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM t, size WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
s AS (
  SELECT item, item_id, no, doc_id,
         CAST(sum(q.times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * size.docs) // size.terms)))) AS BIGINT) AS score
  FROM t JOIN w USING (term) JOIN q USING (term), size GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""

SQL: dict[str, str] = {"op2_chat": CHAT, "op7_mixing": MIXING, "op9_line_dedup": LINES, "op11_ranked_search": SEARCH,
                       "op12_merkle": MERKLE}
