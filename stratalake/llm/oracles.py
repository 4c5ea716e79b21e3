"""SQL that gives the rows of the queries which SQL can express, by query name."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str, between: str) -> str:
    return f"list_filter(string_split_regex({_LOWER.format(text)}, '{between}'), lambda w: w <> '')"


# Bytes as hexadecimal digits, as blobs have no substrings.
REPEATS = """
WITH d AS (
    SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents
), windows AS (
    SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS m FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS i FROM d WHERE n >= 200)
), often AS (
    SELECT m FROM windows GROUP BY m HAVING count(*) > 1
), hits AS (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows WHERE m IN (SELECT m FROM often)
), numbered AS (
    SELECT doc_id, i, sum(CASE WHEN before IS NULL OR i > before + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits
), runs AS (
    SELECT doc_id, min(i) AS s, max(i) + 200 AS e FROM numbered GROUP BY doc_id, run
), gaps AS (
    SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY s), 0) AS s, s AS e FROM runs
    UNION ALL SELECT d.doc_id, coalesce(max(r.e), 0), d.n FROM d LEFT JOIN runs r ON r.doc_id = d.doc_id GROUP BY d.doc_id, d.n
), kept AS (
    SELECT g.doc_id, string_agg(substr(d.h, CAST(2 * g.s + 1 AS BIGINT), CAST(2 * (g.e - g.s) AS BIGINT)), '' ORDER BY g.s) AS h
    FROM gaps g JOIN d ON d.doc_id = g.doc_id GROUP BY g.doc_id
)
SELECT d.doc_id, d.n AS n_bytes, CAST(coalesce(r.removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(r.spans, 0) AS BIGINT) AS n_spans,
    sha256(unhex(k.h)) AS kept_sha256
FROM d JOIN kept k ON k.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, sum(e - s) AS removed, count(*) AS spans FROM runs GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""

_FOLDED = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
CONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, {_words("coalesce(text, '')", _FOLDED)} AS ws FROM documents
), items AS (
    SELECT item_id, ws, least(10, len(ws)) AS size FROM (SELECT item_id, {_words("coalesce(text, '')", _FOLDED)} AS ws FROM benchmark)
    WHERE len(ws) > 0
), patterns AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, size, array_to_string(ws[i:i + size - 1], ' ') AS pattern
    FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM items)
), sizes AS (
    SELECT DISTINCT size FROM patterns
), places AS (
    SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM docs
), windows AS (
    SELECT doc_id, i, size, array_to_string(ws[i:i + size - 1], ' ') AS pattern FROM places, sizes WHERE i + size - 1 <= len(ws)
), hits AS (
    SELECT w.doc_id, w.i, w.size, p.item FROM windows w JOIN patterns p ON p.size = w.size AND p.pattern = w.pattern
), covered AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
), found AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(f.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(f.listed, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c ON c.doc_id = d.doc_id LEFT JOIN found f ON f.doc_id = d.doc_id
"""

# A SHA-1 is 32 letters of five bits: four letters from every five hexadecimal digits.
ARCHIVED = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS h FROM pages
), winners AS (
    SELECT payload, max(page_id) AS winner FROM p GROUP BY payload
)
SELECT page_id, CAST(octet_length(encode(p.payload)) AS BIGINT) AS payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(
        (CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) // (CAST([32768, 1024, 32, 1][i % 4 + 1] AS BIGINT))) % 32 + 1 AS BIGINT), 1)), '') AS payload_digest,
    CASE WHEN page_id = winner THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> winner THEN winner END AS refers_to, CAST(NULL AS VARCHAR) AS problem
FROM p JOIN winners w ON w.payload = p.payload
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {_words("coalesce(text, '')", "[\\x20\\x09-\\x0D]+")} AS ws FROM documents
), sets AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle FROM docs
), sizes AS (
    SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs JOIN sizes m ON m.doc_id = x JOIN sizes n ON n.doc_id = y WHERE 100 * common >= 75 * (m.n + n.n - common)
), ways AS (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents UNION SELECT r.doc_id, w.y FROM reached r JOIN ways w ON w.x = r.other
), found AS (
    SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, f.component_id, d.doc_id = f.component_id AS kept
FROM docs d JOIN found f ON f.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
"""

EXACT_SEARCH = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS parts
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), met AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.parts, c.parts) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM met
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

COLLOCATIONS = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), listed AS (
    SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), starts AS (
    SELECT lang, words, unnest(range(1, len(words) + 1)) AS pos FROM listed
), grams AS (
    SELECT lang, k, array_to_string(words[pos:pos + k - 1], ' ') AS phrase
    FROM starts, (VALUES (1), (2), (3), (4)) sizes(k) WHERE pos + k - 1 <= len(words)
), totals AS (
    SELECT lang, count(*) AS n FROM starts GROUP BY lang
), counts AS (
    SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
    SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words, unnest(range(1, k)) AS cut FROM counts WHERE k > 1
), scored AS (
    SELECT c.lang, c.phrase, c.a, c.words, c.cut, x.f AS l, y.f AS r,
           CAST((CAST(2000000 AS HUGEINT) * c.a) // (x.f + y.f) AS BIGINT) AS score
    FROM cuts c
    JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:c.cut], ' ')
    JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[c.cut + 1:c.k], ' ')
), weakest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
), longer AS (
    SELECT l.lang, array_to_string(l.words[s:s + k2 - 1], ' ') AS phrase, max(l.a) AS f
    FROM (SELECT lang, k, a, words FROM cuts WHERE cut = 1 AND k > 2) l,
         (VALUES (2), (3)) sizes(k2), (VALUES (1), (2), (3)) places(s)
    WHERE k2 < l.k AND s + k2 - 1 <= l.k GROUP BY ALL
), ranked AS (
    SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY score DESC, a DESC, w.phrase) AS rank,
           w.phrase, w.a, w.l, w.r, w.score
    FROM weakest w LEFT JOIN longer g ON g.lang = w.lang AND g.phrase = w.phrase
    WHERE g.f IS NULL OR 100 * g.f < 80 * w.a
)
SELECT ranked.lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""
