"""The queries' results as DuckDB SQL, where SQL can say them."""

OP4 = r"""
WITH RECURSIVE worded AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
),
shingled AS (
  SELECT doc_id, CASE
    WHEN len(w) = 0 OR w IS NULL THEN []
    WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1),
                                      lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM worded
),
sized AS (SELECT doc_id, s, len(s) AS n FROM shingled),
single AS (SELECT doc_id, n, unnest(s) AS shingle FROM sized),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM single a JOIN single b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 85 * (na + nb - common)
  UNION ALL
  SELECT b, a FROM shared WHERE 100 * common >= 85 * (na + nb - common)
),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
),
least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
SELECT doc_id, n::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sized JOIN least USING (doc_id)
"""


def crc32_of(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text: each character is folded in, then eight shifts."""
    steps = f"flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] for c in string_split({text}, '')])"
    return (
        f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}::BIGINT[]),"
        " lambda crc, step: CASE WHEN step >= 0 THEN xor(crc, step)"
        " ELSE xor(crc >> 1, 3988292384::BIGINT * (crc & 1)) END), 4294967295::BIGINT)"
    )


OP11 = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
    coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
listed AS (
  SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY place) AS own,
    {crc32_of("conv_id::VARCHAR")} % 4 AS h
  FROM turns GROUP BY conv_id
),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(f.own[1:c.h], []), c.own[c.h + 1:]) AS turns
  FROM listed c LEFT JOIN listed f ON f.conv_id = c.conv_id - c.conv_id % 20
),
prefixes AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns FROM rebuilt
),
nodes AS (
  SELECT turns[1:depth] AS path, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ended
  FROM prefixes GROUP BY ALL
),
families AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
),
valued AS (
  SELECT n.*, coalesce(f.n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE
    (n_convs - 1) * len(regexp_extract_all(n.path[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
  FROM nodes n LEFT JOIN families f ON f.path = n.path
),
upward AS (
  SELECT path, saved, n_children, unnest(range(0, depth + 1)) AS up FROM valued
),
subtrees AS (
  SELECT path[1:up] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
  FROM upward GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children,
  s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(n.ended) AS ends_sha256
FROM valued n JOIN subtrees s ON s.path = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""

OP12 = r"""
WITH items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
sized AS (SELECT item, w, least(len(w), 10) AS n FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS gram
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM sized)
),
docs AS (
  SELECT row_number() OVER () AS no, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
placed AS (
  SELECT no, n, w, unnest(range(1, len(w) - n + 2)) AS i
  FROM docs CROSS JOIN (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
),
found AS (
  SELECT no, p.n, i, item FROM placed p JOIN windows v
  ON v.n = p.n AND v.gram = array_to_string(w[i:i + p.n - 1], ' ')
),
hits AS (
  SELECT no, count(DISTINCT place) AS n_hit
  FROM (SELECT no, unnest(range(i, i + n)) AS place FROM found) GROUP BY no
),
whose AS (
  SELECT no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT no, item FROM found) GROUP BY no
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hits USING (no) LEFT JOIN whose USING (no)
"""

OP13 = rf"""
WITH numbered AS (
  SELECT row_number() OVER () AS no, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS own,
    {crc32_of("coalesce(doc_id::VARCHAR, '')")} AS h
  FROM documents
),
chosen AS (
  SELECT *, len(own) AS n, h // 10 AS g, CASE WHEN len(own) > 0 THEN (h // 10) % len(own) END AS a
  FROM numbered
),
docs AS (
  SELECT no, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_concat(own[1:a],
    list_transform(range(0, n - a), lambda i: own[a + i % (1 + (n - a) // (3 + g % 8)) + 1]))
    ELSE own END AS w
  FROM chosen
),
words AS (SELECT no, n, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs),
equal AS (
  SELECT x.no, x.i, y.i - x.i AS q
  FROM words x JOIN words y ON x.no = y.no AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n
),
islands AS (
  SELECT no, q, i, i - row_number() OVER (PARTITION BY no, q ORDER BY i) AS island FROM equal
),
stretches AS (
  SELECT no, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY no, q, island
),
runs AS (
  SELECT no, s, l, min(q) AS q FROM stretches WHERE l >= greatest(6, 4 * q) GROUP BY no, s, l
),
listed AS (
  SELECT no, count(*) AS n_runs, first({{'s': s, 'l': l, 'q': q}} ORDER BY l DESC, s, q) AS best,
    string_agg(concat(s, ',', l, ',', q, chr(10)), '' ORDER BY s, q) AS lines
  FROM runs GROUP BY no
),
dropped AS (SELECT DISTINCT no, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (
  SELECT no, string_agg(word, ' ' ORDER BY i) AS text
  FROM words ANTI JOIN dropped USING (no, i) GROUP BY no
)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s::BIGINT AS start, best.l::BIGINT AS length,
  best.q::BIGINT AS period, (1000 * best.l // best.q)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (no) LEFT JOIN kept USING (no)
"""
