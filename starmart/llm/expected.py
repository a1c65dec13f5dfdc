"""Expected results as SQL for DuckDB, for the queries SQL can express."""

from __future__ import annotations

# Fixed value: the reflected polynomial of CRC-32.
POLYNOMIAL = 3988292384


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a text's UTF-8 bytes, eight shifts per byte."""
    octets = f"list_transform(range(0, octet_length(encode({text}))), lambda k: ('0x' || substr(hex(encode({text})), 2 * k::INT + 1, 2))::BIGINT)"
    shifts = f"list_reduce([xor(s, o), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: xor(c >> 1, {POLYNOMIAL} * (c & 1)))"
    return f"xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda s, o: {shifts}))"


OP11 = f"""
WITH RECURSIVE lowered AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]{{7,}}')) AS run FROM lowered),
hashed AS (SELECT run, {crc32("coalesce(doc_id::VARCHAR, '') || ':' || run")} AS h FROM runs),
results AS (
    SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
    FROM hashed
),
words AS (SELECT word, count(*) AS n FROM results WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
places AS (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words),
shorter AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM places),
near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
    UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word
),
ranked AS (
    SELECT word, other, other_n, count(*) OVER (PARTITION BY word) AS n_near,
           row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place
    FROM near
),
formed AS (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
           CASE WHEN r.other_n >= 10 * w.n THEN r.other END AS form,
           CASE WHEN r.other_n >= 10 * w.n THEN r.other_n END AS form_n
    FROM words w LEFT JOIN ranked r ON w.word = r.word AND r.place = 1
),
steps AS (
    SELECT word, word AS root, 0 AS step FROM formed
    UNION ALL SELECT s.word, f.form, s.step + 1 FROM steps s JOIN formed f ON s.root = f.word WHERE f.form IS NOT NULL
),
roots AS (SELECT word, arg_max(root, step) AS root FROM steps GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots r ON f.word = r.word
"""

OP13 = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS place
    FROM conversations WHERE conv_id IS NOT NULL
),
convs AS (SELECT conv_id, count(*) AS own, conv_id - conv_id % 5 AS base, {crc32("conv_id::VARCHAR")} % 9 AS h FROM turns GROUP BY conv_id),
plan AS (SELECT c.*, least(c.h, coalesce(b.own, 0)) AS taken FROM convs c LEFT JOIN convs b ON c.base = b.conv_id),
rebuilt AS (
    SELECT p.conv_id, t.place, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.base AND t.place < p.h
    UNION ALL
    SELECT p.conv_id, p.taken + t.place - p.h, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.place >= p.h
),
prefixes AS (
    SELECT conv_id, place + 1 AS depth, octet_length(encode(text)) AS bytes,
           sha256(string_agg(sha256(role) || sha256(text), '') OVER (PARTITION BY conv_id ORDER BY place)) AS node
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM plan
),
lengths AS (SELECT conv_id, max(depth) AS length FROM prefixes GROUP BY conv_id),
nodes AS (SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes FROM prefixes GROUP BY node, depth),
-- every node with each node on the path of its smallest member down to it
above AS (
    SELECT n.node, n.depth, (n.n_convs - 1) * n.bytes AS worth, p.node AS top, p.depth AS top_depth
    FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth
),
children AS (SELECT top AS node, count(*) AS n_children FROM above WHERE top_depth = depth - 1 GROUP BY top),
parents AS (SELECT a.node, p.conv_id AS parent_conv_id FROM above a JOIN nodes p ON a.top = p.node WHERE a.top_depth = a.depth - 1),
totals AS (
    SELECT a.top AS node, sum(a.worth) AS saved_tokens, sum(CASE WHEN c.node IS NULL THEN 1 ELSE 0 END) AS n_leaves
    FROM above a LEFT JOIN children c ON a.node = c.node GROUP BY a.top
),
ends AS (
    SELECT p.node, sha256(string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id)) AS ends_sha256
    FROM prefixes p JOIN lengths l ON p.conv_id = l.conv_id AND p.depth = l.length GROUP BY p.node
)
SELECT n.conv_id, n.depth, p.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       t.n_leaves::BIGINT AS n_leaves, t.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
FROM nodes n JOIN totals t ON n.node = t.node LEFT JOIN children c ON n.node = c.node
LEFT JOIN parents p ON n.node = p.node LEFT JOIN ends e ON n.node = e.node
"""

ORACLE_SQL: dict[str, str] = {
    "op11_spelling_variants": OP11,
    "op13_conversation_trie": OP13,
}
