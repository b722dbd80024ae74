"""DuckDB SQL with the rows of those text queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT *, list_transform(range(8), lambda g: ('0x' || substr(h, 1 + 5 * g, 5))::INT) AS bits FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS first_id FROM d)
SELECT page_id, url, strlen(html) AS payload_bytes,
    array_to_string(flatten(list_transform(bits, lambda b: list_transform([15, 10, 5, 0],
        lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((b >> s) & 31), 1)))), '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f
"""

_LINKED = f"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
    SELECT DISTINCT doc_id, ws[i:i + {{width}} - 1] AS sh
    FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - {{width}} + 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
    FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
    WHERE 100 * c >= {{percent}} * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT doc_id, coalesce(n, 0) AS n_shingles, root AS component_id{{more}}
FROM (SELECT a AS doc_id, min(b) AS root FROM reach GROUP BY 1) LEFT JOIN n USING (doc_id)
"""
OP5 = _LINKED.format(width=2, percent=80, more=", root = doc_id AS kept")
OP13 = _LINKED.format(width=4, percent=85, more="")

OP6 = """
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, s, array_to_string(ws[s:s + 19], ' ') AS k
    FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM t WHERE len(ws) >= 20)),
again AS (SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM again),
word AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t),
kept AS (SELECT doc_id, count(*) AS n, string_agg(w, ' ' ORDER BY i) AS k
    FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT t.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed,
    sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)
"""

OP9 = f"""
WITH words AS (
    SELECT doc_id, NULL AS item_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
    FROM documents
    UNION ALL
    SELECT NULL, item_id::VARCHAR, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')
    FROM benchmark),
item AS (
    SELECT DISTINCT item_id, size, array_to_string(ws[s:s + size - 1], ' ') AS k FROM (
        SELECT item_id, ws, least(10, len(ws)) AS size, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS s
        FROM words WHERE item_id IS NOT NULL AND len(ws) > 0)),
win AS (
    SELECT doc_id, s, size, array_to_string(ws[s:s + size - 1], ' ') AS k FROM (
        SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS s
        FROM words, (SELECT DISTINCT size FROM item) WHERE item_id IS NULL AND len(ws) >= size)),
found AS (SELECT doc_id, s, win.size, item_id FROM win JOIN item USING (k) WHERE win.size = item.size),
hit AS (SELECT doc_id, count(DISTINCT i) AS n FROM (
    SELECT doc_id, unnest(range(s, s + size)) AS i FROM found) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit ON hit.doc_id = w.doc_id LEFT JOIN ids ON ids.doc_id = w.doc_id
WHERE w.item_id IS NULL
"""

OP12 = f"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS ws FROM piece),
total AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1),
f AS (SELECT lang, ph, count(*) AS f FROM (
    SELECT lang, ws[i:i + k - 1] AS ph FROM (
        SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(ws) >= k)) GROUP BY 1, 2),
cand AS (SELECT lang, ph, f AS a FROM f WHERE len(ph) > 1 AND f >= 10),
cut AS (SELECT lang, ph, a, k, ph[1:k] AS first, ph[k + 1:] AS rest
    FROM (SELECT *, unnest(range(1, len(ph))) AS k FROM cand)),
score AS (SELECT cut.lang, cut.ph, a, k, x.f AS l, y.f AS r,
        ((1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.ph = first JOIN f y ON y.lang = cut.lang AND y.ph = rest),
low AS (SELECT * FROM score QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
inside AS (SELECT lang, ph, max(a) AS longer FROM (
    SELECT lang, unnest([ph[1:2], ph[2:3]]) AS ph, a FROM cand WHERE len(ph) = 3) GROUP BY 1, 2),
kept AS (SELECT low.*, array_to_string(low.ph, ' ') AS phrase
    FROM low LEFT JOIN inside USING (lang, ph) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_warc_chunks": OP1,
        "op5_near_duplicates": OP5,
        "op6_substring_dedup": OP6,
        "op9_decontamination": OP9,
        "op12_phrase_collocations": OP12,
        "op13_parity_sketch_join": OP13,
    }
