"""The SQL of those queries that SQL can express, for DuckDB."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEVELS = 7  # levels of a tree that the SQL of the manifest writes out: 16^7 leaves


def folded(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{UPPER.lower()}')"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    bits = f"""flatten(list_transform(range(1, length({text}) + 1), lambda k: list_transform(range(8),
    lambda b: CAST((ascii(substr({text}, CAST(k AS INT), 1)) >> CAST(b AS INT)) & 1 AS BIGINT))))"""
    return f"xor(4294967295, list_reduce({bits}, lambda c, b: xor(c >> 1, xor(c & 1, b) * 3988292384), 4294967295))"


def _manifest() -> str:
    def leaf(text: str) -> str:
        field = "coalesce(strlen(CAST({0} AS VARCHAR)) || ':' || CAST({0} AS VARCHAR), '-')"
        return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def level(below: str, name: str, kept: str) -> str:
        left, right = "array_to_string(hs[:p.i % 16], '')", "array_to_string(hs[p.i % 16 + 2:], '')"
        return f"""{name}_runs AS MATERIALIZED (SELECT g, i // 16 AS j, n, list(h ORDER BY i) AS hs FROM (SELECT DISTINCT g, i, n, h FROM {below}) GROUP BY ALL),
{name} AS MATERIALIZED (SELECT g, doc_id, leaf, {kept} p.i // 16 AS i, (n + 15) // 16 AS n,
    CASE WHEN n = 1 THEN h ELSE sha256(array_to_string(hs, '')) END AS h, CASE WHEN n = 1 THEN f ELSE sha256({left} || f || {right}) END AS f,
    CASE WHEN n = 1 THEN proof ELSE proof || {left} || {right} END AS proof
  FROM {below} p JOIN {name}_runs r USING (g, n) WHERE r.j = p.i // 16)"""

    parts = [
        f"docs AS (SELECT *, CAST(doc_id AS VARCHAR) AS d, {folded('text')} AS low FROM documents)",
        f"""leaves AS MATERIALIZED (SELECT coalesce('1' || source, '0') AS g, doc_id, {leaf('text')} AS leaf,
    CASE WHEN {_crc32('d')} % 5 = 0 THEN {leaf('low')} ELSE {leaf('text')} END AS changed FROM docs)""",
        """s0 AS MATERIALIZED (SELECT g, doc_id, leaf, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, changed) - 1 AS i,
    count(*) OVER (PARTITION BY g) AS n, leaf AS h, changed AS f, '' AS proof FROM leaves)""",
        *[level(f"s{k}", f"s{k + 1}", "") for k in range(LEVELS)],
        f"""t0 AS MATERIALIZED (SELECT '' AS g, doc_id, leaf, h AS subroot, dense_rank() OVER (ORDER BY g) - 1 AS i,
    (SELECT count(DISTINCT g) FROM leaves) AS n, h, f, proof FROM s{LEVELS})""",
        *[level(f"t{k}", f"t{k + 1}", "subroot,") for k in range(LEVELS)],
    ]
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = h AS verified FROM t{LEVELS}"""


MANIFEST = _manifest()

NEAR_DUPLICATES = f"""
WITH RECURSIVE texts AS (SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all({folded("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT r, doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM texts),
each AS MATERIALIZED (SELECT r, unnest(g) AS x FROM sets),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS n FROM each a JOIN each b ON a.x = b.x AND a.r < b.r GROUP BY ALL),
linked AS MATERIALIZED (SELECT a, b FROM common JOIN sets sa ON sa.r = a JOIN sets sb ON sb.r = b
    WHERE 100 * n >= 85 * (len(sa.g) + len(sb.g) - n)),
both_ways AS MATERIALIZED (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT r AS a, r AS b FROM sets UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a),
named AS (SELECT a AS r, min(doc_id) AS component_id FROM reach JOIN sets ON sets.r = b GROUP BY ALL)
SELECT doc_id, len(g) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM sets JOIN named USING (r)"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAMINATION = f"""
WITH words AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({folded("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents),
item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({folded("coalesce(text, '')")}, '{_WORDS}') AS w FROM benchmark),
windows AS MATERIALIZED (SELECT DISTINCT item, least(len(w), 10) AS size, array_to_string(w[i:i + 9], ' ') AS x
    FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item_words WHERE len(w) > 0)),
places AS (SELECT r, i, size, array_to_string(w[i:i + size - 1], ' ') AS x
    FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT DISTINCT size FROM windows))),
found AS MATERIALIZED (SELECT r, i, p.size, item FROM places p JOIN windows v ON v.size = p.size AND v.x = p.x),
hits AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS place FROM found) GROUP BY ALL),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY ALL)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated FROM words LEFT JOIN hits USING (r) LEFT JOIN items USING (r)"""

CHAT = """
WITH given AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)),
turns AS (SELECT *, lag(role) OVER w IS DISTINCT FROM role OR row_number() OVER w = 1 AS begins,
    row_number() OVER w AS k, length(replace(text, '<|', '<||')) AS size, length(replace(replace(role, '<|', '<||'), chr(10), '<|n|>')) AS name
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size + CASE WHEN begins THEN 12 + name + 1 + 10 + 1 ELSE 11 END) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""
