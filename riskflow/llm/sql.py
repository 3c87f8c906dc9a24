"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

EXACT_DEDUP = """
WITH texts AS (
    SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(t) AS text_sha256
FROM texts
WINDOW same AS (PARTITION BY t)
"""

WARC = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS p FROM pages
), keyed AS (
    SELECT page_id, octet_length(p)::BIGINT AS payload_bytes, sha1(p) AS payload_digest,
           CASE WHEN octet_length(p) >= 1000 THEN max(page_id) OVER (PARTITION BY p) END AS response
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN response <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN response <> page_id THEN response END AS refers_to,
       true AS verified
FROM keyed
"""

LINE_DEDUP = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), places AS (
    SELECT r, doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM texts
), keyed AS (
    SELECT r, doc_id, i, lines[i] AS line,
           trim(translate(lines[i], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
    FROM places
), shared AS (
    SELECT key, max(doc_id) AS keep FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT r) >= 3
)
SELECT k.doc_id, count(*) AS n_lines, count(*) FILTER (WHERE keep IS NOT NULL AND keep <> k.doc_id) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE keep IS NULL OR keep = k.doc_id), '')) AS kept_sha256
FROM keyed k LEFT JOIN shared USING (key)
GROUP BY r, k.doc_id
"""

LEXICAL_SEARCH = r"""
WITH texts AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
), counted AS (
    SELECT row_number() OVER () AS r, doc_id, len(terms)::BIGINT AS n, terms FROM texts WHERE len(terms) > 0
), totals AS (
    SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM counted
), asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), postings AS (
    SELECT r, doc_id, n, term, count(*)::BIGINT AS tf
    FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM counted)
    WHERE term IN (SELECT term FROM asked) GROUP BY ALL
), weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM postings, totals GROUP BY term
), scores AS (
    SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * big_n) // big_l))))::BIGINT AS score
    FROM asked JOIN postings USING (term) JOIN weights USING (term), totals
    GROUP BY item_id, r, doc_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""

COLLOCATIONS = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
    FROM documents
), pieces AS (
    SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), places AS (
    SELECT lang, w, len, unnest(range(1, len(w) - len + 2)) AS i FROM split, (VALUES (1), (2), (3), (4)) AS v(len)
), phrases AS (
    SELECT lang, array_to_string(w[i : i + len - 1], ' ') AS phrase, count(*) AS f FROM places GROUP BY ALL HAVING count(*) >= 30
), totals AS (
    SELECT lang, sum(len(w))::BIGINT AS n FROM split GROUP BY lang
), candidates AS (
    SELECT lang, phrase, string_split(phrase, ' ') AS w, f AS a FROM phrases WHERE contains(phrase, ' ')
), cuts AS (
    SELECT *, unnest(range(1, len(w))) AS k FROM candidates
), cut_scores AS (
    SELECT c.lang, c.phrase, c.w, c.a, k, x.f AS l, y.f AS r,
           ((2000000::HUGEINT * c.a) // (x.f + y.f))::BIGINT AS score
    FROM cuts c
    JOIN phrases x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1 : k], ' ')
    JOIN phrases y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1 : len(c.w)], ' ')
), scored AS (
    SELECT * FROM cut_scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_places AS (
    SELECT lang, w, a, m, unnest(range(1, len(w) - m + 2)) AS i FROM candidates, (VALUES (2), (3)) AS v(m) WHERE len(w) > m
), around AS (
    SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longest FROM inner_places GROUP BY ALL
), ranked AS (
    SELECT s.lang, s.phrase, a, l, r, score,
           row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
    FROM scored s LEFT JOIN around o ON o.lang = s.lang AND o.phrase = s.phrase
    WHERE longest IS NULL OR 100 * longest < 80 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT_DEDUP,
        "op9_warc": WARC,
        "op11_lexical_search": LEXICAL_SEARCH,
        "op12_collocations": COLLOCATIONS,
        "op13_line_dedup": LINE_DEDUP,
    }
