"""DuckDB's SQL for the corpus queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_WORDS = f"""docs AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS r, list_filter(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS w FROM documents)"""

#: Vectors' cosines are sums in double precision, as the query's.
OP1 = """WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings),
  sound AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
  links AS (SELECT a.vec_id AS u, b.vec_id AS v FROM sound AS a JOIN sound AS b ON a.vec_id <> b.vec_id
    WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= CAST(0.95 AS DOUBLE)),
  reach AS (SELECT vec_id AS u, vec_id AS v FROM v UNION SELECT r.u, l.v FROM reach AS r JOIN links AS l ON l.u = r.v),
  comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u),
  deg AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT v.vec_id, coalesce(d.n, 0) AS n_links, c.c AS component_id, v.vec_id = c.c AS kept FROM v JOIN comp AS c ON c.u = v.vec_id LEFT JOIN deg AS d ON d.u = v.vec_id"""

OP2 = f"""WITH RECURSIVE {_WORDS},
  grams AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s FROM docs),
  flat AS (SELECT doc_id, unnest(s) AS g FROM grams),
  links AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM flat AS a JOIN flat AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  good AS (SELECT l.u, l.v FROM links AS l JOIN grams AS a ON a.doc_id = l.u JOIN grams AS b ON b.doc_id = l.v WHERE 100 * l.n >= 75 * (len(a.s) + len(b.s) - l.n)),
  reach AS (SELECT doc_id AS u, doc_id AS v FROM docs UNION SELECT r.u, g.v FROM reach AS r JOIN good AS g ON g.u = r.v),
  comp AS (SELECT u, min(v) AS c FROM reach GROUP BY u)
SELECT g.doc_id, len(g.s) AS n_shingles, c.c AS component_id, g.doc_id = c.c AS kept FROM grams AS g JOIN comp AS c ON c.u = g.doc_id"""

#: Every word's n-grams of one to three words, with what other documents hold of them.
OP5 = f"""WITH {_WORDS},
  words AS (SELECT doc_id, r, len(w) AS n, unnest(range(1, len(w) + 1)) AS k, unnest(w) AS a FROM docs),
  grams AS (SELECT doc_id, r, n, k, a AS g1, lag(a) OVER p || ' ' || a AS g2, lag(a, 2) OVER p || ' ' || lag(a) OVER p || ' ' || a AS g3 FROM words WINDOW p AS (PARTITION BY r ORDER BY k)),
  flat AS (SELECT r, g1 AS g FROM grams UNION ALL SELECT r, g2 FROM grams WHERE g2 IS NOT NULL UNION ALL SELECT r, g3 FROM grams WHERE g3 IS NOT NULL),
  own AS (SELECT r, g, count(*) AS n FROM flat GROUP BY r, g),
  rest AS (SELECT o.r, o.g, t.n - o.n AS n FROM own AS o JOIN (SELECT g, sum(n) AS n FROM own GROUP BY g) AS t ON t.g = o.g),
  counted AS (SELECT g.r, g.n, g.k, c1.n AS c1, c2.n AS c2, c3.n AS c3, lag(c1.n) OVER p AS d1, lag(c2.n) OVER p AS d2, (SELECT count(*) FROM words) - g.n AS others FROM grams AS g
    JOIN rest AS c1 ON c1.r = g.r AND c1.g = g.g1 LEFT JOIN rest AS c2 ON c2.r = g.r AND c2.g = g.g2 LEFT JOIN rest AS c3 ON c3.r = g.r AND c3.g = g.g3 WINDOW p AS (PARTITION BY g.r ORDER BY g.k)),
  s1 AS (SELECT *, CASE WHEN c1 > 0 THEN ln(CAST(c1 AS DOUBLE)) - ln(CAST(greatest(others, 1) AS DOUBLE)) ELSE -ln(CAST(others + 1 AS DOUBLE)) END AS l1 FROM counted),
  s2 AS (SELECT *, CASE WHEN k < 2 THEN l1 WHEN c2 > 0 THEN ln(CAST(c2 AS DOUBLE)) - ln(CAST(d1 AS DOUBLE)) ELSE ln(CAST(0.4 AS DOUBLE)) + l1 END AS l2 FROM s1),
  s3 AS (SELECT *, CASE WHEN k < 3 THEN l2 WHEN c3 > 0 THEN ln(CAST(c3 AS DOUBLE)) - ln(CAST(d2 AS DOUBLE)) ELSE ln(CAST(0.4 AS DOUBLE)) + l2 END AS l3 FROM s2),
  summed AS (SELECT r, count(*) FILTER (WHERE c3 > 0) AS seen, sum(l3) AS s FROM s3 GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(s.seen, 0) AS n_seen, round(coalesce(s.s, 0), 6) AS log_score, round(s.s / len(d.w), 6) AS mean_log FROM docs AS d LEFT JOIN summed AS s ON s.r = d.r"""

OP10 = """WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
  newest AS (SELECT d, max(page_id) AS m FROM p WHERE n >= 1000 GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest, CASE WHEN p.page_id < m.m THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN p.page_id < m.m THEN m.m END AS refers_to
FROM p LEFT JOIN newest AS m ON m.d = p.d AND p.n >= 1000"""

OP11 = f"""WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS t FROM documents),
  g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.t) AS text_sha256 FROM d JOIN g ON g.t = d.t"""


def _rounds() -> str:
    """Common tables of the codes: entries b0, then distances, the nearest entries and the entries moved, twice, and a last
    assignment."""
    out = []
    for k in range(3):
        out.append(f"""f{k} AS (SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS far FROM p JOIN b{k} AS b ON b.part = p.part AND b.pos = p.pos GROUP BY ALL),
  a{k} AS (SELECT vec_id, part, entry, far FROM f{k} QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY far, entry) = 1)""")
        if k < 2:
            out.append(f"""m{k} AS (SELECT p.part, a.entry, p.pos, CAST(floor(CAST(sum(p.x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM p JOIN a{k} AS a ON a.vec_id = p.vec_id AND a.part = p.part GROUP BY ALL),
  b{k + 1} AS (SELECT b.part, b.entry, b.pos, coalesce(m.x, b.x) AS x FROM b{k} AS b LEFT JOIN m{k} AS m ON m.part = b.part AND m.entry = b.entry AND m.pos = b.pos)""")
    return ",\n  ".join(out)


_SOUND = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_WHOLE = "CAST(floor(256 * CAST(unnest(embedding) AS DOUBLE)) AS BIGINT)"

OP12 = f"""WITH flat AS (SELECT vec_id, unnest(range(len(embedding))) AS k, len(embedding) // 16 AS w, {_WHOLE} AS x FROM embeddings WHERE {_SOUND}),
  p AS (SELECT vec_id, k // w AS part, k % w AS pos, x FROM flat),
  b0 AS (SELECT part, e.entry, pos, x FROM p JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM (SELECT DISTINCT vec_id FROM p) ORDER BY vec_id LIMIT 64) AS e ON e.vec_id = p.vec_id),
  {_rounds()},
  c AS (SELECT a.vec_id, string_agg(printf('%02x', a.entry), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a2 AS a GROUP BY a.vec_id),
  l AS (SELECT c.*, e.label FROM c JOIN embeddings AS e ON e.vec_id = c.vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) FROM b2) AS codebooks_sha256 FROM l"""

OP13 = f"""WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE label IS NOT NULL AND {_SOUND}),
  s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id AND a.vec_id % 50 = 0),
  pos AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE alike QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM pos AS p JOIN s AS n ON n.anchor_id = p.anchor_id AND NOT n.alike AND 50 * p.positive_score <= 100 * n.score AND 100 * n.score <= 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.id) QUALIFY rank <= 3"""
