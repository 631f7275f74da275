"""The same results in DuckDB SQL, where SQL can express them over whole tables."""

from __future__ import annotations

SHARD_BYTES = 1_048_576

_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

OP5 = rf"""
WITH w AS (
  SELECT doc_id, coalesce({_WORDS}, []::VARCHAR[]) AS ws FROM documents
), t AS (
  SELECT doc_id, len(ws) AS n_words, unnest(ws) AS c, generate_subscripts(ws, 1) AS i, ws FROM w
), g AS (
  SELECT doc_id, n_words, i, c AS w1,
         CASE WHEN i >= 2 THEN ws[i-1] END AS b1,
         CASE WHEN i >= 3 THEN ws[i-2] END AS b2
  FROM t
), total AS (SELECT count(*) AS n FROM g
), c1 AS (SELECT w1, count(*) AS n FROM g GROUP BY ALL
), c2 AS (SELECT b1, w1, count(*) AS n FROM g WHERE b1 IS NOT NULL GROUP BY ALL
), c3 AS (SELECT b2, b1, w1, count(*) AS n FROM g WHERE b2 IS NOT NULL GROUP BY ALL
), d1 AS (SELECT doc_id, w1, count(*) AS n FROM g GROUP BY ALL
), d2 AS (SELECT doc_id, b1, w1, count(*) AS n FROM g WHERE b1 IS NOT NULL GROUP BY ALL
), d3 AS (SELECT doc_id, b2, b1, w1, count(*) AS n FROM g WHERE b2 IS NOT NULL GROUP BY ALL
), s AS (
  SELECT g.doc_id, g.n_words, g.b1, g.b2,
         greatest((SELECT n FROM total) - g.n_words, 1) AS rest,
         c1.n - d1.n AS u, c2.n - d2.n AS b, c3.n - d3.n AS t,
         x1.n - y1.n AS ub, x2.n - y2.n AS bb
  FROM g JOIN c1 USING (w1) JOIN d1 USING (doc_id, w1)
  LEFT JOIN c2 ON g.b1 = c2.b1 AND g.w1 = c2.w1
  LEFT JOIN d2 ON g.doc_id = d2.doc_id AND g.b1 = d2.b1 AND g.w1 = d2.w1
  LEFT JOIN c3 ON g.b2 = c3.b2 AND g.b1 = c3.b1 AND g.w1 = c3.w1
  LEFT JOIN d3 ON g.doc_id = d3.doc_id AND g.b2 = d3.b2 AND g.b1 = d3.b1 AND g.w1 = d3.w1
  LEFT JOIN c1 x1 ON x1.w1 = g.b1
  LEFT JOIN d1 y1 ON y1.doc_id = g.doc_id AND y1.w1 = g.b1
  LEFT JOIN c2 x2 ON x2.b1 = g.b2 AND x2.w1 = g.b1
  LEFT JOIN d2 y2 ON y2.doc_id = g.doc_id AND y2.b1 = g.b2 AND y2.w1 = g.b1
), v AS (
  SELECT doc_id,
    CASE WHEN b2 IS NOT NULL AND t > 0 THEN ln(t) - ln(bb)
         ELSE CASE WHEN b2 IS NOT NULL THEN ln(0.4) ELSE 0 END
            + CASE WHEN b1 IS NOT NULL AND b > 0 THEN ln(b) - ln(ub)
                   ELSE CASE WHEN b1 IS NOT NULL THEN ln(0.4) ELSE 0 END
                      + CASE WHEN u > 0 THEN ln(u) - ln(rest) ELSE ln(0.4) - ln(rest) END
              END
    END AS x
  FROM s
)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, round(sum(v.x) / len(w.ws), 6) AS log_score
FROM w LEFT JOIN v USING (doc_id) GROUP BY w.doc_id, w.ws
"""

OP10 = f"""
WITH d AS (
  SELECT doc_id, coalesce(strlen(text), 0)::BIGINT AS n_bytes,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT AS h
  FROM documents
), p AS (
  SELECT d.*, k.depth, d.h >> (60 - k.depth) AS prefix
  FROM d, (SELECT unnest(range(0, 61)) AS depth) k
), b AS (
  SELECT depth, prefix, sum(n_bytes) AS bytes, min(h) AS h0, max(h) AS h1 FROM p GROUP BY ALL
), f AS (
  SELECT p.doc_id, p.h, p.n_bytes, min(p.depth)::INTEGER AS depth
  FROM p JOIN b USING (depth, prefix) WHERE b.bytes <= {SHARD_BYTES} OR b.h0 = b.h1
  GROUP BY ALL
)
SELECT doc_id, substr(lpad(bin(h), 60, '0'), 1, depth) AS shard, depth, 0::BIGINT AS part, n_bytes
FROM f
"""

_SHINGLES = f"""
w AS (SELECT doc_id, coalesce({_WORDS}, []::VARCHAR[]) AS ws FROM documents),
sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[]
                               WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
                               ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i+1] || ' ' || ws[i+2])
                          END) AS s
    FROM w)
),
sz AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
rare AS (SELECT s FROM sh GROUP BY s HAVING count(*) > 1),
rs AS (SELECT sh.doc_id, sh.s FROM sh JOIN rare USING (s)),
inter AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM rs a JOIN rs b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM inter JOIN sz x ON x.doc_id = a JOIN sz y ON y.doc_id = b
  WHERE 100 * i >= 90 * (x.n + y.n - i)
),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links)
"""

OP7 = f"""
WITH RECURSIVE {_SHINGLES},
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM documents
  UNION
  SELECT r.node, e.b FROM reach r JOIN both_ways e ON e.a = r.seen
)
SELECT d.doc_id, coalesce(sz.n, 0)::BIGINT AS n_shingles, min(r.seen) AS component_id
FROM documents d LEFT JOIN sz USING (doc_id) JOIN reach r ON r.node = d.doc_id
GROUP BY d.doc_id, sz.n
"""

OP3 = """
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM e
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.seen
), comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node
), deg AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(deg.n, 0)::BIGINT AS n_links, comp.component_id,
       e.vec_id = comp.component_id AS kept
FROM e JOIN comp ON comp.node = e.vec_id LEFT JOIN deg ON deg.a = e.vec_id
"""

_DUCK_WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP8 = f"""
WITH dw AS (SELECT doc_id, coalesce({_DUCK_WORDS}, []::VARCHAR[]) AS ws FROM documents),
bw AS (SELECT item_id, coalesce({_DUCK_WORDS}, []::VARCHAR[]) AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS k,
         unnest(list_transform(range(1, len(ws) - least(10, len(ws)) + 2),
                lambda i: array_to_string(ws[i:i + least(10, len(ws)) - 1], ' '))) AS s
  FROM bw WHERE len(ws) > 0
),
ks AS (SELECT DISTINCT k FROM win),
spots AS (SELECT doc_id, ws, ks.k, unnest(range(1, len(ws) - ks.k + 2)) AS i FROM dw, ks WHERE len(ws) >= ks.k),
hit AS (
  SELECT a.doc_id, a.i, a.k, w.item_id
  FROM spots a JOIN win w ON w.k = a.k AND w.s = array_to_string(a.ws[a.i:a.i + a.k - 1], ' ')
),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS s
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT dw.doc_id, len(dw.ws)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit,
       coalesce(items.n, 0)::BIGINT AS n_items, sha256(coalesce(items.s, '')) AS items_sha256,
       covered.n IS NOT NULL AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP11_ROUNDS = 10


def _op11() -> str:
    """Ten unrolled rounds over (vector, component, whole number) rows."""
    ctes = [
        """kept AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = 64
), x AS MATERIALIZED (
  SELECT vec_id, unnest(range(64))::INTEGER AS d, unnest(list_transform(v, lambda c: floor(1024 * c)::BIGINT)) AS n
  FROM kept
), s AS (
  SELECT vec_id, row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c FROM kept
), c0 AS MATERIALIZED (SELECT s.c::INTEGER AS c, x.d, x.n FROM s JOIN x USING (vec_id) WHERE s.c < 8)"""
    ]
    for r in range(_OP11_ROUNDS + 1):
        ctes.append(
            f"""a{r} AS MATERIALIZED (
  SELECT vec_id, min(c)::INTEGER AS c, min(dist) AS dist FROM (
    SELECT *, min(dist) OVER (PARTITION BY vec_id) AS least FROM (
      SELECT x.vec_id, k.c, sum((x.n - k.n) * (x.n - k.n))::BIGINT AS dist
      FROM x JOIN c{r} k ON k.d = x.d GROUP BY x.vec_id, k.c)
  ) WHERE dist = least GROUP BY vec_id)"""
        )
        if r < _OP11_ROUNDS:
            ctes.append(
                f"""m{r} AS (
  SELECT a.c, x.d, sum(x.n)::BIGINT AS total, count(*) AS m FROM a{r} a JOIN x USING (vec_id) GROUP BY a.c, x.d
), c{r + 1} AS MATERIALIZED (
  SELECT k.c, k.d, CASE WHEN m.m IS NULL THEN k.n
                        ELSE (m.total - ((m.total % m.m) + m.m) % m.m) // m.m END AS n
  FROM c{r} k LEFT JOIN m{r} m ON m.c = k.c AND m.d = k.d)"""
            )
    last = _OP11_ROUNDS
    return f"""WITH {", ".join(ctes)},
h AS (SELECT c, sha256(string_agg(n::VARCHAR, ',' ORDER BY d)) AS digest FROM c{last} GROUP BY c)
SELECT a.vec_id, a.c AS cluster, a.dist AS distance,
       (sum(a.dist) OVER (PARTITION BY a.c))::BIGINT AS cluster_inertia,
       (sum(a.dist) OVER ())::BIGINT AS inertia, h.digest AS centroid_sha256
FROM a{last} a JOIN h USING (c)"""


OP13 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []::VARCHAR[]) AS ws
  FROM documents
), marks AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT w.part, coalesce(marks.good, false) AS good, coalesce(marks.toxic, false) AS toxic,
         (len(ws) < 100)::INTEGER
         + 2 * (100 * len(list_distinct(ws)) < 80 * len(ws))::INTEGER
         + 4 * (100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * len(t))::INTEGER
         + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER
         + 16 * (w.doc_id > min(w.doc_id) OVER (PARTITION BY t))::INTEGER AS mask
  FROM w LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM f GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || letter FROM orders, letters WHERE position(letter IN o) = 0
), steps AS (
  SELECT o.o AS filter_order, k.step, l.letter, l.bit,
         (SELECT coalesce(sum(b.bit), 0)::INTEGER FROM letters b WHERE position(b.letter IN o.o) < k.step) AS earlier
  FROM (SELECT o FROM orders WHERE len(o) = 5) o, (SELECT unnest(range(1, 6)) AS step) k, letters l
  WHERE l.letter = o.o[k.step:k.step]
), counted AS (
  SELECT c.part, s.filter_order, s.step, s.letter,
         sum(CASE WHEN c.mask & (s.earlier | s.bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN c.mask & s.bit <> 0 AND c.mask & s.earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN c.mask & s.bit <> 0 AND c.mask & s.earlier <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN c.mask = s.bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN c.mask & s.bit <> 0 AND c.mask & s.earlier = 0 THEN c.good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN c.mask & s.bit <> 0 AND c.mask & s.earlier = 0 THEN c.toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM cells c, steps s GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM counted
"""

SQL = {
    "op3_lattice_dedup": OP3,
    "op5_backoff_score": OP5,
    "op7_jaccard_join": OP7,
    "op8_decontaminate": OP8,
    "op10_extendible_shards": OP10,
    "op11_hadamard_clusters": _op11(),
    "op13_filter_audit": OP13,
}
