"""DuckDB statements for the operators that SQL can express, each over its whole table."""

from __future__ import annotations

#: Trees by recursion over levels, proofs by joining every node with its run; CRC-32 by eight shifts a byte.
MERKLE_MANIFEST = """
WITH RECURSIVE
columns AS (
    SELECT doc_id, 's' || source AS named, CAST(doc_id AS VARCHAR) AS d, source AS s, lang AS l, CAST(n_chars AS VARCHAR) AS c, text AS t,
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low
    FROM documents
),
stated AS (
    SELECT doc_id, coalesce(named, 'n') AS tree, d,
        coalesce(strlen(d) || ':' || d, '-') || coalesce(strlen(s) || ':' || s, '-') || coalesce(strlen(l) || ':' || l, '-')
            || coalesce(strlen(c) || ':' || c, '-') AS head,
        coalesce(strlen(t) || ':' || t, '-') AS body, coalesce(strlen(low) || ':' || low, '-') AS lowered
    FROM columns
),
summed AS (
    SELECT *, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(d, ''), lambda x: ord(x)::BIGINT)),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
            lambda a, b: xor(a >> 1, CASE WHEN a & 1 = 1 THEN 3988292384 ELSE 0 END)))) AS crc
    FROM stated
),
leaves AS (
    SELECT doc_id, tree, sha256(head || body) AS leaf, CASE WHEN crc % 5 = 0 THEN sha256(head || lowered) END AS tampered
    FROM summed
),
places AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS total
    FROM leaves
),
nodes AS (
    SELECT 0 AS level, tree, place, total, leaf AS node FROM places
    UNION ALL
    SELECT level + 1, tree, place // 16, (max(total) + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
    FROM nodes WHERE total > 1 GROUP BY level, tree, place // 16
),
subroots AS (
    SELECT tree, node AS subroot, level AS height, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS total
    FROM nodes WHERE total = 1
),
upper AS (
    SELECT 0 AS level, place, total, subroot AS node FROM subroots
    UNION ALL
    SELECT level + 1, place // 16, (max(total) + 15) // 16, sha256(string_agg(node, '' ORDER BY place))
    FROM upper WHERE total > 1 GROUP BY level, place // 16
),
steps AS (
    SELECT a.tree, a.level, a.place, coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS lft,
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS rgt
    FROM nodes a JOIN nodes b ON b.level = a.level AND b.tree = a.tree AND b.place // 16 = a.place // 16
    WHERE a.total > 1 GROUP BY ALL
),
upper_steps AS (
    SELECT a.level, a.place, coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS lft,
        coalesce(string_agg(b.node, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS rgt
    FROM upper a JOIN upper b ON b.level = a.level AND b.place // 16 = a.place // 16
    WHERE a.total > 1 GROUP BY ALL
),
proofs AS (
    SELECT tree, place, height, step, lft, rgt FROM (
        SELECT p.tree, p.place, s.height, t.level AS step, t.lft, t.rgt
        FROM places p JOIN subroots s ON s.tree = p.tree
        JOIN steps t ON t.tree = p.tree AND t.level < s.height AND t.place = p.place >> (4 * t.level)
        UNION ALL
        SELECT p.tree, p.place, s.height, s.height + t.level, t.lft, t.rgt
        FROM places p JOIN subroots s ON s.tree = p.tree JOIN upper_steps t ON t.place = s.place >> (4 * t.level)
    )
),
folds AS (
    SELECT tree, place, 0 AS step, coalesce(tampered, leaf) AS node FROM places
    UNION ALL
    SELECT f.tree, f.place, f.step + 1, sha256(p.lft || f.node || p.rgt)
    FROM folds f JOIN proofs p ON p.tree = f.tree AND p.place = f.place AND p.step = f.step
),
ends AS (SELECT tree, place, arg_max(node, step) AS folded_root FROM folds GROUP BY ALL),
joined AS (SELECT tree, place, string_agg(lft || rgt, '' ORDER BY step) AS siblings FROM proofs GROUP BY ALL),
top AS (SELECT node AS root FROM upper WHERE total = 1)
SELECT p.doc_id, p.leaf, s.subroot, t.root, sha256(coalesce(j.siblings, '')) AS proof_sha256, e.folded_root, e.folded_root = t.root AS verified
FROM places p JOIN subroots s ON s.tree = p.tree CROSS JOIN top t
JOIN ends e ON e.tree = p.tree AND e.place = p.place LEFT JOIN joined j ON j.tree = p.tree AND j.place = p.place
"""

#: Counts of all phrases of one to four words, the lowest cut of each candidate, and what longer ones leave of them.
PHRASE_COLLOCATIONS = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang, regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS parts
    FROM documents
),
pieces AS (SELECT row, lang, generate_subscripts(parts, 1) AS piece, unnest(parts) AS part FROM texts),
split AS (SELECT row, lang, piece, regexp_split_to_array(part, '[\x20\x09]+') AS words FROM pieces),
listed AS (SELECT row, lang, piece, generate_subscripts(words, 1) AS place, unnest(words) AS w1 FROM split),
followed AS (
    SELECT lang, w1, lead(w1, 1) OVER piece_words AS w2, lead(w1, 2) OVER piece_words AS w3, lead(w1, 3) OVER piece_words AS w4
    FROM listed WHERE w1 <> '' WINDOW piece_words AS (PARTITION BY row, piece ORDER BY place)
),
grams AS (
    SELECT lang, 1 AS k, w1 AS phrase, count(*) AS f FROM followed GROUP BY ALL
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM followed WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM followed WHERE w3 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM followed WHERE w4 IS NOT NULL GROUP BY ALL
),
-- A part is at least as frequent as the whole.
known AS MATERIALIZED (SELECT *, {'lang': lang, 'phrase': phrase} AS key FROM grams WHERE f >= 30),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS words FROM known WHERE k > 1),
cuts AS MATERIALIZED (
    SELECT c.lang, c.k, c.phrase, c.a, c.words, s.cut, {'lang': c.lang, 'phrase': array_to_string(c.words[1:s.cut], ' ')} AS head,
        {'lang': c.lang, 'phrase': array_to_string(c.words[s.cut + 1:], ' ')} AS rest
    FROM candidates c JOIN (VALUES (1), (2), (3)) s(cut) ON s.cut < c.k
),
scores AS (
    SELECT c.*, h.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (h.f + r.f))::BIGINT AS score
    FROM cuts c JOIN known h ON h.key = c.head
    JOIN known r ON r.key = c.rest
),
lowest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (
    SELECT c.lang, array_to_string(c.words[p.begin:p.begin + s.size - 1], ' ') AS phrase, max(c.a) AS longer
    FROM candidates c JOIN (VALUES (2), (3)) s(size) ON s.size < c.k JOIN (VALUES (1), (2), (3)) p(begin) ON p.begin + s.size - 1 <= c.k
    GROUP BY ALL
),
kept AS (
    SELECT b.* FROM lowest b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
    WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * b.a
),
ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
    FROM kept
)
SELECT x.lang, x.rank, x.phrase, x.a, x.l, x.r, t.n, x.score FROM ranked x JOIN totals t ON t.lang = x.lang WHERE x.rank <= 2000
"""

#: The response of equal payloads is the page with the smallest id.
WARC = """
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS size, sha256(coalesce(html, '')) AS digest FROM pages
),
firsts AS (SELECT digest, min(page_id) AS first FROM payloads WHERE size >= 100 GROUP BY digest),
typed AS (
    SELECT p.*, f.first, f.first IS NOT NULL AND f.first IS DISTINCT FROM p.page_id AS again
    FROM payloads p LEFT JOIN firsts f ON f.digest = p.digest
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest, if(again, 'revisit', 'response') AS record_type,
    CASE WHEN again THEN first END AS refers_to FROM typed
"""

#: Windows as joined words, each word marked when a repeated window begins at it or up to 34 words before.
SUBSTRING_DEDUP = r"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
    FROM documents
),
placed AS (SELECT row, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM texts),
begun AS (
    SELECT row, place, word, string_agg(word, ' ') OVER following AS sequence, count(*) OVER following AS size
    FROM placed WINDOW following AS (PARTITION BY row ORDER BY place ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
),
repeated AS (SELECT sequence FROM begun WHERE size = 35 GROUP BY sequence HAVING count(*) > 1),
marked AS (
    SELECT b.row, b.place, b.word, b.size = 35 AND r.sequence IS NOT NULL AS again FROM begun b LEFT JOIN repeated r ON r.sequence = b.sequence
),
judged AS (
    SELECT row, place, word, bool_or(again) OVER (PARTITION BY row ORDER BY place ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM marked
),
kept AS (
    SELECT row, count(*) FILTER (gone) AS removed, string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept FROM judged GROUP BY row
)
SELECT t.doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(coalesce(k.removed, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(k.kept, '')) AS kept_sha256 FROM texts t LEFT JOIN kept k ON k.row = t.row
"""
