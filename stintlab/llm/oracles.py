"""SQL giving the queries' answers on another engine, where SQL can.

It takes its own way: seats are dealt one by one, vectors are all compared, digests are spelled
out bit by bit.
"""

from __future__ import annotations

_SIZED = r"""
sized AS (
    SELECT doc_id, source, md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS drawn, text,
        coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
    FROM documents
)"""

_MIXING = f"""
WITH {_SIZED},
sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
        row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM sized GROUP BY source
),
weighted AS (
    SELECT *, (place - 1) % 3 + 1 AS weight, 3 * source_size AS cap,
        3 * source_size / ((place - 1) % 3 + 1) AS room,
        CAST(sum(source_size) OVER () AS BIGINT) AS total
    FROM sources
),
levels AS (
    SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY room, place
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY room, place
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighted
),
targets AS (
    SELECT *, least(CAST(cap AS DOUBLE), max(CASE WHEN level <= room THEN level END) OVER ()
        * weight) AS target, CAST(ceil(n_docs / 4096) AS BIGINT) AS n_shards
    FROM levels
),
seats AS (
    SELECT place, count(*) AS blocks FROM (
        SELECT place, row_number() OVER (ORDER BY quotient DESC, place) AS nth, total FROM (
            SELECT place, total, target / (2 * unnest(range(CAST(target / 16 AS BIGINT) + 40)) + 1)
                AS quotient
            FROM targets WHERE target > 0) asks) ranked
    WHERE nth <= round(total / 16) GROUP BY place
),
placed AS (
    SELECT s.*, t.place, t.source_size, t.target, coalesce(b.blocks, 0) AS blocks,
        CAST('0x' || substr(drawn, 1, 8) AS BIGINT) % t.n_shards AS shard
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
    LEFT JOIN seats b ON b.place = t.place
),
shards AS (
    SELECT place, shard, blocks, CAST(sum(size) AS BIGINT) AS shard_size
    FROM placed GROUP BY place, shard, blocks
),
shard_seats AS (
    SELECT place, shard, count(*) AS quota FROM (
        SELECT place, shard, blocks,
            row_number() OVER (PARTITION BY place ORDER BY quotient DESC, shard) AS nth
        FROM (SELECT place, shard, blocks, shard_size / (2 * unnest(range(blocks)) + 1) AS quotient
            FROM shards WHERE shard_size > 0) asks) ranked
    WHERE nth <= blocks GROUP BY place, shard
),
laid AS (
    SELECT p.*, h.shard_size, least(coalesce(q.quota, 0) * 16, 3 * h.shard_size) AS words,
        coalesce(sum(size) OVER (PARTITION BY p.place, p.shard ORDER BY drawn, doc_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM placed p JOIN shards h ON h.place = p.place AND h.shard = p.shard
    LEFT JOIN shard_seats q ON q.place = p.place AND q.shard = p.shard
)
SELECT doc_id, size, source_size, target,
    CAST(CASE WHEN shard_size > 0 THEN words // shard_size * size
        + greatest(0, least(words % shard_size - before, size)) ELSE 0 END AS BIGINT) AS taken
FROM laid"""

_BASE32 = "".join(chr(c) for c in [*range(65, 91), *range(50, 56)])

_WARC = f"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
),
digests AS (
    SELECT page_id, payload, strlen(payload) AS payload_bytes,
        array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(
            instr('0123456789abcdef', substr(hex, i, 1)) - 1), 4, '0')), '') AS bits
    FROM payloads
),
firsts AS (SELECT payload, min(page_id) AS first FROM payloads GROUP BY payload)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('{_BASE32}',
        1 + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INTEGER)
        + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INTEGER)
        + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INTEGER)
        + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INTEGER)
        + CAST(substr(bits, 5 * i + 5, 1) AS INTEGER), 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM digests JOIN firsts USING (payload)"""

_TOP_K = """
WITH vectors AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.vec_id AS query_id, o.vec_id, CAST(list_inner_product(q.v, o.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors o ON o.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0
)
SELECT query_id, CAST(nth AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS nth
    FROM scored) ranked
WHERE nth <= 20"""


def _tree(text: str, name: str) -> str:
    """Steps from a text column to its tree."""
    return f"""
{name}_leaves AS (
    SELECT doc_id, {text}, list_transform(string_split({text}, chr(10)), lambda line:
        list_transform(regexp_extract_all(line, '[^.!?]{{1,32}}[.!?]?|[.!?]'), lambda x: sha256(x)))
        AS hashes
    FROM edits
),
{name}_paragraphs AS (
    SELECT doc_id, list_transform(hashes, lambda h: sha256(array_to_string(h, '')) || '{{'
        || array_to_string(list_transform(h, lambda x: substr(x, 1, 6)), '.') || '}}') AS nodes
    FROM {name}_leaves
),
{name}_sections AS (
    SELECT doc_id, string_split(rtrim(array_to_string(list_transform(nodes, lambda p: p ||
        CASE WHEN contains('048c', substr(p, 8, 1)) THEN ';' ELSE ',' END), ''), ';,'), ';') AS parts
    FROM {name}_paragraphs
),
{name}_hashed AS (
    SELECT doc_id, list_transform(parts, lambda s:
        sha256(array_to_string(regexp_extract_all(s, '([0-9a-f]{{64}})\\{{', 1), '')) || '['
        || rtrim(regexp_replace(s, '([0-9a-f]{{8}})[0-9a-f]{{56}}\\{{', '\\1{{', 'g'), ',') || ']')
        AS nodes
    FROM {name}_sections
),
{name}_tree AS (
    SELECT doc_id, sha256(array_to_string(list_transform(nodes, lambda s: substr(s, 1, 64)), ''))
        || ':' || array_to_string(list_transform(nodes, lambda s: substr(s, 1, 8)
        || substr(s, 65)), ';') AS tree
    FROM {name}_hashed
),
{name}_set AS (
    SELECT doc_id, tree, split_part(tree, ':', 1) AS root,
        list_distinct(regexp_extract_all(tree, '[{{.]([0-9a-f]{{6}})', 1)) AS leaves
    FROM {name}_tree
)"""


def _likeness(a: str, b: str) -> str:
    total = f"(len({a}.leaves) + len({b}.leaves))"
    return f"""CAST(CASE WHEN {a}.root = {b}.root THEN 1 WHEN {total} = 0 THEN 0
        ELSE least(2 * len(list_intersect({a}.leaves, {b}.leaves)), {total} - 1) / {total} END AS DOUBLE)"""


_MERKLE = f"""
WITH ordered AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n,
        coalesce(lead(doc_id) OVER (ORDER BY doc_id), min(doc_id) OVER ()) AS next_id
    FROM documents
),
edits AS (
    SELECT o.doc_id, o.n, o.text, o.next_id,
        substr(o.text, 1, o.n - o.n // 4) || substr(x.text, 1, o.n // 4) AS edited
    FROM ordered o JOIN ordered x ON x.doc_id = o.next_id
),
{_tree("text", "own")}, {_tree("edited", "new")}
SELECT e.doc_id, CAST(e.n AS BIGINT) AS n_chars, sha256(e.edited) AS edited_sha256,
    o.tree AS fingerprint, w.tree AS edited_fingerprint,
    {_likeness("o", "w")} AS near_edited, {_likeness("o", "x")} AS near_next
FROM edits e JOIN own_set o ON o.doc_id = e.doc_id JOIN new_set w ON w.doc_id = e.doc_id
JOIN own_set x ON x.doc_id = e.next_id"""

_INFILL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS text,
        sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents
),
cut AS (
    SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
    FROM drawn
),
placed AS (
    SELECT *, CAST(len(units) AS BIGINT) AS n,
        least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low,
        greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high
    FROM cut
),
parts AS (
    SELECT doc_id, text, n,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
            OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
        coalesce(array_to_string(units[1:low], ''), '') AS prefix,
        coalesce(array_to_string(units[low + 1:high], ''), '') AS middle,
        coalesce(array_to_string(units[high + 1:n], ''), '') AS suffix
    FROM placed
)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text
        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM parts
"""

_PHRASES = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
),
listed AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
runs AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS g
    FROM listed, range(1, 5) AS sizes(k)
),
counted AS (SELECT lang, k, g, count(*) AS f FROM runs GROUP BY lang, k, g),
totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE k = 1 GROUP BY lang),
candidates AS (SELECT * FROM counted WHERE k >= 2 AND f >= 30),
cuts AS (
    SELECT c.lang, c.k, c.g, c.f AS a, j, x.f AS l, y.f AS r,
        (2000000 * c.f::HUGEINT) // (x.f::HUGEINT + y.f::HUGEINT) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
    JOIN counted x ON x.lang = c.lang AND x.g = c.g[1:j]
    JOIN counted y ON y.lang = c.lang AND y.g = c.g[j + 1:c.k]
),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1
),
inside AS (
    SELECT lang, sub, max(f) AS f FROM (
        SELECT lang, f, k, unnest(flatten(list_transform(range(2, k),
            lambda m: list_transform(range(1, k - m + 2), lambda i: g[i:i + m - 1])))) AS sub
        FROM candidates WHERE k >= 3) subs
    GROUP BY lang, sub
),
kept AS (
    SELECT w.* FROM lowest w LEFT JOIN inside i ON i.lang = w.lang AND i.sub = w.g
    WHERE i.f IS NULL OR 100 * i.f::HUGEINT < 80 * w.a::HUGEINT
),
ranked AS (
    SELECT *, array_to_string(g, ' ') AS phrase,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(g, ' ')) AS rank
    FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op3_source_mixing": _MIXING,
    "op4_warc_index": _WARC,
    "op5_exact_topk": _TOP_K,
    "op8_merkle_fingerprints": _MERKLE,
    "op11_fill_in_middle": _INFILL,
    "op12_phrase_collocations": _PHRASES,
}
