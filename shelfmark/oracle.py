"""The same results in ANSI-style SQL, for comparison on the same parquet tables."""

from __future__ import annotations

SQL: dict[str, str] = {}

COLUMN_NAME = """
  trim(regexp_replace(regexp_replace(trim(lower({c})), '(_en|_kh|_km)$', ''), '[^a-z0-9]+', '_', 'g'), '_')
"""
ALIASED = """
  CASE {c} WHEN 'ref_year' THEN 'year' WHEN 'ref_month' THEN 'month' WHEN 'month_num' THEN 'month'
    WHEN 'ref_quarter' THEN 'quarter' WHEN 'partner_country_en' THEN 'country_partner'
    WHEN 'country_partner_en' THEN 'country_partner' WHEN 'province_en' THEN 'province'
    WHEN 'capital_province' THEN 'province' ELSE {c} END
"""


def title_key(c: str) -> str:
    return f"""trim(regexp_replace(regexp_replace(regexp_replace(lower({c}),
      '\\b\\d{{4}}\\s*-\\s*\\d{{4}}\\b', ' ', 'g'), '\\b(?:fy\\s*)?\\d{{4}}\\b', ' ', 'g'),
      '[^a-z0-9]+', ' ', 'g'))"""


TITLES = f"""
titles0 AS (
  SELECT p_partkey AS id, p_name || ' ' || p_brand || CASE p_partkey % 3
      WHEN 0 THEN ' FY' || (2000 + p_size)
      WHEN 1 THEN ' (' || (2000 + p_size) || '-' || (2001 + p_size) || ')'
      ELSE ' ' || (2000 + p_size) END AS title,
    p_brand AS organization_id, p_type AS category, p_size AS size, p_retailprice AS price
  FROM part),
titles AS (SELECT *, {title_key('title')} AS series_key FROM titles0)
"""

DOCS = """
docs AS (
  SELECT doc_id AS id, lang AS category, source AS organization_id,
    list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+'), lambda x: x <> ''))) AS columns
  FROM documents)
"""

SCHEMA_PAIRS = (
    DOCS
    + """,
entries AS (SELECT id, category, len(columns) AS n, unnest(columns) AS w FROM docs WHERE len(columns) > 0),
shared AS (
  SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k,
    any_value(a.category) AS ca, any_value(b.category) AS cb, md5(string_agg(a.w, ' ' ORDER BY a.w)) AS shared
  FROM entries a JOIN entries b ON a.w = b.w AND a.id < b.id GROUP BY a.id, b.id),
pairs AS (
  SELECT a AS dataset_a_id, b AS dataset_b_id, round(k::DOUBLE / (na + nb - k), 3) AS jaccard_score,
    k AS n_shared, shared, ca = cb AS same_category
  FROM shared WHERE k::DOUBLE / (na + nb - k) >= 0.6)
"""
)

PAGES = f"""
links AS (
  SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages),
names AS (
  SELECT DISTINCT page_id, {ALIASED.format(c='c')} AS name
  FROM (SELECT page_id, {COLUMN_NAME.format(c='link')} AS c FROM links) WHERE c <> ''),
page_columns AS (SELECT page_id, list(name ORDER BY name) AS columns FROM names GROUP BY page_id),
ordered_names AS (
  SELECT page_id, name, min(pos) AS pos FROM (
    SELECT page_id, pos, {ALIASED.format(c='c')} AS name FROM (
      SELECT page_id, pos, {COLUMN_NAME.format(c='link')} AS c FROM (
        SELECT page_id, unnest(l) AS link, unnest(range(len(l))) AS pos
        FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)))
    WHERE c <> '') GROUP BY page_id, name),
recs AS (
  SELECT p.page_id AS id, regexp_extract(html, '<title>(.*?)</title>', 1) AS title,
    {title_key("regexp_extract(html, '<title>(.*?)</title>', 1)")} AS series_key,
    regexp_extract(url, 'https?://([^/]+)/', 1) AS org,
    nullif(regexp_extract(url, 'https?://[^/]+/([a-z]+)/', 1), '') AS category,
    regexp_extract(url, '^([a-z]+)', 1) AS frequency, contains(url, '?') AS covered,
    coalesce(c.columns, []::VARCHAR[]) AS columns
  FROM pages p LEFT JOIN page_columns c ON c.page_id = p.page_id),
records AS (
  SELECT *, list_distinct(list_filter(string_split(series_key, ' '), lambda x: x <> '')) AS words,
    CASE WHEN series_key = '' THEN '#' || id ELSE series_key END AS series
  FROM recs)
"""

SCORED = (
    PAGES
    + """,
parts AS (
  SELECT x.id AS target_id, y.id AS dataset_id, y.series, x.org = y.org AS same_org,
    coalesce(x.category = y.category, false) AS same_cat,
    list_sort(list_intersect(x.columns, y.columns)) AS shared,
    len(x.columns) AS nx, len(y.columns) AS ny,
    len(list_intersect(x.words, y.words)) AS tw, len(x.words) AS tx, len(y.words) AS ty,
    CASE WHEN nullif(x.frequency, '') = nullif(y.frequency, '') THEN 0.5 ELSE 0 END
      + CASE WHEN x.covered AND y.covered THEN 0.5 ELSE 0 END AS temporal
  FROM records x JOIN records y ON x.id <> y.id),
scored AS (
  SELECT *, CASE WHEN greatest(nx, ny) > 0 THEN len(shared)::DOUBLE / greatest(nx, ny) ELSE 0 END AS co,
    CASE WHEN tx + ty - tw > 0 THEN tw::DOUBLE / (tx + ty - tw) ELSE 0 END AS ti
  FROM parts),
totals AS (SELECT *, co * 0.65 + ti * 0.25 + temporal::DOUBLE * 0.10 AS score FROM scored)
"""
)


def ranked(scope: str, source: str = "totals", k: int = 5, name: str = "ranked") -> str:
    return f"""
{name}_one AS (
  SELECT *, row_number() OVER (PARTITION BY target_id, series ORDER BY score DESC, dataset_id) AS r1
  FROM {source} WHERE {scope}),
{name} AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY score DESC, dataset_id)::INT AS rank
    FROM {name}_one WHERE r1 = 1) WHERE rank <= {k})
"""


def similar(scope: str) -> str:
    return f"""
WITH {SCORED}, {ranked(scope)}
SELECT target_id, rank, dataset_id, round(score, 4) AS score, round(co, 4) AS column_overlap,
  round(ti, 4) AS title_similarity, round(temporal::DOUBLE, 4) AS temporal_compatibility,
  array_to_string(shared, ',') AS shared,
  coalesce(nullif(concat_ws('; ',
    CASE WHEN len(shared) > 0 THEN 'shared columns: ' || array_to_string(shared[1:5], ', ') END,
    CASE WHEN same_cat THEN 'same category' END,
    CASE WHEN same_org THEN 'same organization' END), ''), 'similar title and schema') AS reason
FROM ranked
"""


SQL["normalize_title"] = f"WITH {TITLES} SELECT id, title, series_key FROM titles"

SQL["normalize_column"] = f"""
WITH {DOCS}, w AS (SELECT id, unnest(columns) AS t FROM docs),
n AS (SELECT DISTINCT id, {ALIASED.format(c='c')} AS name FROM (SELECT id, {COLUMN_NAME.format(c='t')} AS c FROM w))
SELECT name, count(*) AS documents FROM n GROUP BY name
"""

SQL["strip_script"] = """
WITH s AS (
  SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^\\x00-\\x7F]+', ' ', 'g'), '\\s+', ' ', 'g')) AS t
  FROM documents)
SELECT doc_id, length(t) AS n, md5(t) AS digest FROM s
"""

SQL["uuid5_ids"] = f"""
WITH {TITLES}, h AS (
  SELECT id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(title)) AS d FROM titles)
SELECT id, substr(d, 1, 8) || '-' || substr(d, 9, 4) || '-5' || substr(d, 14, 3) || '-' ||
  substr('89ab', (strpos('0123456789abcdef', substr(d, 17, 1)) - 1)::INT % 4 + 1, 1) || substr(d, 18, 3) || '-' ||
  substr(d, 21, 12) AS uuid
FROM h
"""

SQL["parse_number"] = """
SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS text,
  replace(format('{:,.2f}', o_totalprice), ',', '')::DOUBLE AS number
FROM orders
"""

SQL["unique_columns"] = """
SELECT p_name AS title, arg_max(p_brand, p_partkey) AS description, min(p_partkey) AS first_seen,
  p_name || ': ' || arg_max(p_brand, p_partkey) AS semantic_string
FROM part GROUP BY p_name
"""

SQL["temporal_compat"] = """
SELECT l_linestatus, o_orderstatus, score::DOUBLE AS score, count(*) AS n FROM (
  SELECT l_linestatus, o_orderstatus,
    CASE WHEN l_linestatus = o_orderstatus THEN 0.5 ELSE 0 END
    + CASE WHEN l_returnflag <> 'N' AND o_orderpriority LIKE '1%' THEN 0.5 ELSE 0 END AS score
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
GROUP BY ALL
"""

SQL["cosine_next"] = """
SELECT a.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1
"""

SQL["series_members"] = f"""
WITH {TITLES}, m AS (
  SELECT series_key, id, title, count(*) OVER (PARTITION BY series_key) AS n_members
  FROM titles WHERE series_key <> '' AND title <> '')
SELECT * FROM m WHERE n_members > 1
"""

SQL["series_pairs"] = f"""
WITH {TITLES}
SELECT a.id AS query_dataset_id, a.title AS query_title, a.series_key,
  string_agg(b.id, ',' ORDER BY b.id) AS relevant, count(*) AS n_relevant, 'rule_based' AS label_source
FROM titles a JOIN titles b ON a.series_key = b.series_key AND a.id <> b.id
WHERE a.series_key <> '' GROUP BY a.id, a.title, a.series_key
"""

SQL["schema_pairs"] = f"WITH {SCHEMA_PAIRS} SELECT * FROM pairs"

SQL["schema_links"] = f"""
WITH {DOCS}, g AS (
  SELECT min(id) AS group_id, columns, count(*) AS members, category
  FROM docs WHERE len(columns) > 0 GROUP BY columns, category
), p AS (
  SELECT a.group_id AS group_a, b.group_id AS group_b, a.members AS members_a,
    len(list_intersect(a.columns, b.columns)) AS i, len(a.columns) AS na, len(b.columns) AS nb,
    coalesce(a.category = b.category, false) AS same_category,
    CASE WHEN a.group_id = b.group_id THEN a.members * (a.members - 1) // 2 ELSE a.members * b.members END AS n_pairs
  FROM g a JOIN g b ON a.group_id <= b.group_id WHERE a.group_id < b.group_id OR a.members > 1)
SELECT group_a, group_b, members_a, round(i::DOUBLE / (na + nb - i), 3) AS jaccard_score, same_category, n_pairs
FROM p WHERE i::DOUBLE / (na + nb - i) >= 0.6
"""

SQL["schema_groups"] = f"""
WITH {DOCS}
SELECT min(id) AS group_id, len(columns) AS n, count(*) AS members, category
FROM docs WHERE len(columns) > 0 GROUP BY columns, category
"""

SQL["page_schema_pairs"] = f"""
WITH {PAGES}, p AS (
  SELECT a.id AS dataset_a_id, b.id AS dataset_b_id, a.title AS dataset_a_title, b.title AS dataset_b_title,
    list_sort(list_intersect(a.columns, b.columns)) AS s, len(a.columns) AS na, len(b.columns) AS nb,
    coalesce(a.category = b.category, false) AS same_category
  FROM records a JOIN records b ON a.id < b.id WHERE len(a.columns) > 0 AND len(b.columns) > 0)
SELECT dataset_a_id, dataset_b_id, dataset_a_title, dataset_b_title,
  round(len(s)::DOUBLE / (na + nb - len(s)), 3) AS jaccard_score, array_to_string(s, ',') AS shared, same_category
FROM p WHERE len(s)::DOUBLE / (na + nb - len(s)) >= 0.6
"""

SQL["rank_pairs"] = f"""
WITH {SCHEMA_PAIRS}
SELECT row_number() OVER (ORDER BY jaccard_score DESC, dataset_a_id, dataset_b_id) AS position,
  dataset_a_id, dataset_b_id, jaccard_score FROM pairs
"""

SQL["sample_for_labels"] = f"""
WITH {SCHEMA_PAIRS}
SELECT dataset_a_id, dataset_b_id, jaccard_score, same_category FROM pairs
WHERE NOT same_category OR NOT EXISTS (SELECT 1 FROM pairs WHERE NOT same_category)
ORDER BY jaccard_score DESC, dataset_a_id, dataset_b_id LIMIT 20
"""

COSINES = """
cosines AS (
  SELECT a.vec_id AS query_id, b.vec_id AS id, a.label AS la, b.label AS lb,
    round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
  FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
"""


def nearest(k: int, where: str = "true", source: str = "cosines") -> str:
    return f"""
nearest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id)::INT AS rank
    FROM {source} WHERE {where}) WHERE rank <= {k})
"""


HITS = "SELECT query_id, id, round(score, 4) AS score, rank FROM nearest"

SQL["vector_topk"] = f"WITH {COSINES}, {nearest(5)} {HITS}"
SQL["vector_grid"] = SQL["vector_topk"]
SQL["vector_threshold"] = f"WITH {COSINES}, {nearest(10, 'score >= 0.3')} {HITS}"
SQL["vector_similar_pairs"] = f"""
WITH {COSINES} SELECT query_id AS a, id AS b, round(score, 4) AS score FROM cosines
WHERE query_id < id AND score >= 0.35
"""
SQL["vector_overfetch"] = f"""
WITH {COSINES}, fetched AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS f FROM cosines)
  WHERE f <= 14),
{nearest(5, 'lb < 5', 'fetched')} {HITS}
"""
SQL["vector_upsert"] = """
SELECT vec_id AS id, round(CASE WHEN label = 3 THEN (embedding[1] * 2)::FLOAT ELSE embedding[1] END::DOUBLE, 4) AS first
FROM embeddings
"""

SQL["hash_embed_topk"] = """
WITH w AS (
  SELECT 'q' AS side, item_id AS id, unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+'), lambda x: x <> '')) AS w FROM benchmark
  UNION ALL
  SELECT 'c', doc_id, unnest(list_filter(regexp_split_to_array(lower(text), '[ \\t\\r\\n]+'), lambda x: x <> '')) FROM documents),
b AS (
  SELECT side, id, ('0x' || substr(md5(w), 1, 8))::BIGINT % 64 AS b, count(*)::DOUBLE AS n FROM w GROUP BY ALL),
len AS (SELECT side, id, sqrt(sum(n * n)) AS len FROM b GROUP BY ALL),
dots AS (
  SELECT q.id AS query_id, c.id AS id, sum(q.n * c.n) AS dot
  FROM b q JOIN b c ON q.b = c.b WHERE q.side = 'q' AND c.side = 'c' GROUP BY ALL),
cosines AS (
  SELECT query_id, d.id, round(dot / (x.len * y.len), 9) AS score
  FROM dots d JOIN len x ON x.side = 'q' AND x.id = query_id JOIN len y ON y.side = 'c' AND y.id = d.id),
""" + nearest(5) + HITS

LETTERS = "[" + ", ".join(f"(length({{c}}) - length(replace({{c}}, '{x}', '')))::DOUBLE" for x in "abcdefghijklmnopqrstuvwxyz") + "]"

SQL["search_text"] = f"""
WITH q AS (SELECT item_id AS id, {LETTERS.format(c='text')} AS v FROM benchmark),
c AS (SELECT doc_id AS id, lang, {LETTERS.format(c='text')} AS v FROM documents),
cosines AS (
  SELECT * FROM (
    SELECT q.id AS query_id, c.id AS id, c.lang, round(coalesce(nullif(list_cosine_similarity(q.v, c.v), 'nan'::DOUBLE), 0), 9) AS score
    FROM q JOIN c ON true) WHERE score >= 0.9),
{nearest(3)}
SELECT query_id, id, lang, round(score, 4) AS score, rank FROM nearest
"""

SQL["stream_embed"] = f"""
WITH t AS (
  SELECT doc_id::VARCHAR AS id, CASE WHEN doc_id % 3 = 0 THEN text || ' zzz' ELSE text END AS text FROM documents),
v AS (SELECT id, {LETTERS.format(c='text')} AS v FROM t)
SELECT id, list_sum(v)::BIGINT AS letters, v[26]::BIGINT AS z FROM v
"""

SQL["similar_global"] = similar("true")
SQL["similar_category"] = similar("same_cat")
SQL["similar_organization"] = similar("same_org")

SQL["similar_planned"] = f"""
WITH {SCORED},
v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
cosines AS (
  SELECT a.vec_id AS target_id, b.vec_id AS dataset_id,
    greatest(round(coalesce(nullif(list_cosine_similarity(a.e, b.e), 'nan'::DOUBLE), 0), 9), 0) AS emb
  FROM v a JOIN v b ON a.vec_id <> b.vec_id),
planned AS (
  SELECT t.* EXCLUDE (score), coalesce(c.emb, 0) AS emb,
    co * 0.30 + ti * 0.15 + temporal::DOUBLE * 0.10 + coalesce(c.emb, 0) * 0.45 AS score
  FROM totals t LEFT JOIN cosines c USING (target_id, dataset_id)),
{ranked("true", "planned", name="everywhere")},
{ranked("same_org", "planned", name="inside")},
found AS (
  SELECT 'global' AS scope, * FROM everywhere UNION ALL SELECT 'organization' AS scope, * FROM inside)
SELECT scope, target_id, rank, dataset_id, round(score, 4) AS score, round(co, 4) AS column_overlap,
  round(ti, 4) AS title_similarity, round(temporal::DOUBLE, 4) AS temporal_compatibility,
  round(emb, 4) AS embedding_similarity
FROM found
"""

SQL["semantic_columns"] = """
WITH v AS (SELECT vec_id, vec_id // 10 AS d, embedding::DOUBLE[] AS e FROM embeddings),
sims AS (
  SELECT a.d AS x, a.vec_id AS c, b.d AS y, max(round(list_cosine_similarity(a.e, b.e), 9)) AS s
  FROM v a JOIN v b ON a.d <> b.d GROUP BY ALL),
n AS (SELECT d, count(*) AS n FROM v GROUP BY d),
pairs AS (
  SELECT x AS target_id, y AS dataset_id, sum(CASE WHEN s >= 0.3 THEN s ELSE 0 END) / greatest(any_value(nx.n), any_value(ny.n)) AS score
  FROM sims JOIN n nx ON nx.d = x JOIN n ny ON ny.d = y GROUP BY x, y)
SELECT target_id, rank, dataset_id, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY round(score, 9) DESC, dataset_id)::INT AS rank FROM pairs)
WHERE rank <= 5
"""

SQL["token_overlap_top"] = f"""
WITH {TITLES}, k AS (
  SELECT DISTINCT series_key AS id, list_distinct(list_filter(string_split(series_key, ' '), lambda x: x <> '')) AS w FROM titles),
p AS (
  SELECT a.id AS target_id, b.id AS dataset_id, len(list_intersect(a.w, b.w)) AS s, len(a.w) AS na, len(b.w) AS nb
  FROM k a JOIN k b ON a.id <> b.id),
j AS (SELECT target_id, dataset_id, CASE WHEN na > 0 AND nb > 0 THEN s::DOUBLE / (na + nb - s) ELSE 0 END AS score FROM p)
SELECT target_id, rank, dataset_id, round(score, 4) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY score DESC, dataset_id)::INT AS rank FROM j)
WHERE rank <= 3
"""

SQL["diversified_topk"] = f"""
WITH {TITLES}, one AS (
  SELECT *, row_number() OVER (PARTITION BY category, series_key ORDER BY price DESC, id) AS r FROM titles)
SELECT category, rank, id, series_key, price FROM (
  SELECT *, row_number() OVER (PARTITION BY category ORDER BY price DESC, id)::INT AS rank FROM one WHERE r = 1)
WHERE rank <= 10
"""

SQL["rerank_pool"] = f"""
WITH {SCORED}, v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE vec_id IN (SELECT page_id FROM pages)),
cos AS (
  SELECT a.vec_id AS q, b.vec_id AS i, round(list_cosine_similarity(a.e, b.e), 9) AS s FROM v a JOIN v b ON true),
pool AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY s DESC, i) AS r FROM cos) WHERE r <= 20 AND q <> i),
pooled AS (SELECT t.* FROM totals t JOIN pool ON q = target_id AND i = dataset_id),
{ranked('true', 'pooled', 5, 'g')}, {ranked('same_cat', 'pooled', 5, 'c')}, {ranked('same_org', 'pooled', 5, 'o')}
SELECT 'global' AS scope, target_id, rank, dataset_id, round(score, 4) AS score FROM g
UNION ALL SELECT 'category', target_id, rank, dataset_id, round(score, 4) FROM c
UNION ALL SELECT 'organization', target_id, rank, dataset_id, round(score, 4) FROM o
"""

PROFILES = """
schema_line AS (SELECT page_id, string_agg(name, ', ' ORDER BY pos) AS s FROM ordered_names
  WHERE NOT ends_with(name, '_kh') GROUP BY page_id),
profiles AS (
  SELECT r.id, concat_ws(chr(10),
    CASE WHEN s <> '' THEN 'Schema: ' || s END,
    CASE WHEN squeezed <> '' THEN 'Dataset: ' || squeezed END,
    CASE WHEN org <> '' THEN 'Organization: ' || org END,
    CASE WHEN category <> '' THEN 'Categories: ' || category END) AS profile
  FROM (SELECT *, trim(regexp_replace(title, '[\\s\\p{Z}]+', ' ', 'g')) AS squeezed FROM records) r
  LEFT JOIN schema_line ON page_id = r.id)
"""

SQL["semantic_profile"] = f"WITH {PAGES}, {PROFILES} SELECT id, profile FROM profiles"

SQL["live_rank"] = f"""
WITH {PAGES}, {PROFILES}, e AS (
  SELECT r.id, r.series, r.org, r.category, {LETTERS.format(c='profile')} AS v
  FROM records r JOIN profiles p ON p.id = r.id WHERE profile <> ''),
totals AS (
  SELECT x.id AS target_id, y.id AS dataset_id, y.series, x.org = y.org AS same_org,
    coalesce(x.category = y.category, false) AS same_cat, round(list_cosine_similarity(x.v, y.v), 9) AS score
  FROM e x JOIN e y ON x.id <> y.id),
{ranked('true', 'totals', 5, 'g')}, {ranked('same_cat', 'totals', 5, 'c')}, {ranked('same_org', 'totals', 5, 'o')}
SELECT 'global' AS scope, target_id, rank, dataset_id, round(score, 4) AS score FROM g
UNION ALL SELECT 'category', target_id, rank, dataset_id, round(score, 4) FROM c
UNION ALL SELECT 'organization', target_id, rank, dataset_id, round(score, 4) FROM o
"""

SQL["vector_neighbors"] = f"""
WITH {COSINES}, {nearest(3)}
SELECT query_id AS target_id, rank, n.id AS dataset_id,
  coalesce(CASE WHEN p.page_id IS NOT NULL THEN regexp_extract(html, '<title>(.*?)</title>', 1) END, 'vector ' || n.id) AS title,
  round(score, 4) AS score, lb::VARCHAR AS category, '' AS organization
FROM nearest n LEFT JOIN pages p ON p.page_id = n.id
"""

SQL["label_counts"] = """
SELECT count(*) AS pairs, count(*) FILTER (toxic = 1) AS joinable, count(*) FILTER (quality = 1) AS similar,
  count(*) FILTER (toxic = 1 AND quality = 1) AS both FROM labels
"""

SQL["judged_pairs"] = """
SELECT d.doc_id, lang,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.doc_id % 7 = 0 THEN false ELSE quality = 1 END::VARCHAR AS similar,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.doc_id % 7 = 0 THEN false ELSE toxic = 1 END::VARCHAR AS joinable,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.doc_id % 7 = 0 THEN 'Error: unreadable judgment' ELSE 'r' || l.doc_id END AS reasoning,
  CASE WHEN l.doc_id IS NOT NULL THEN 'judge' END AS label_source
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
"""

RATE = """SELECT count(*) AS queries, coalesce(sum(hit), 0)::BIGINT AS hits,
  round(sum(hit)::DOUBLE / nullif(count(*), 0), 4) AS hit_rate FROM"""

SQL["hit_rate"] = f"""
WITH {COSINES}, {nearest(5)}
{RATE} (SELECT query_id, max(CASE WHEN la = lb THEN 1 ELSE 0 END) AS hit FROM nearest GROUP BY query_id)
"""

SQL["series_hit_rate"] = f"""
WITH {SCORED}, {ranked('true')},
members AS (SELECT id, series_key, count(*) OVER (PARTITION BY series_key) AS n FROM records WHERE series_key <> ''),
hits AS (
  SELECT DISTINCT target_id FROM ranked r JOIN records x ON x.id = target_id JOIN records y ON y.id = dataset_id
  WHERE x.series_key = y.series_key)
{RATE} (SELECT CASE WHEN target_id IS NULL THEN 0 ELSE 1 END AS hit FROM members LEFT JOIN hits ON target_id = id WHERE n > 1)
"""

SQL["joinable_hit_rate"] = f"""
WITH {SCORED}, {ranked('true')}, cases AS (
  SELECT target_id, dataset_id FROM totals
  WHERE target_id < dataset_id AND NOT same_cat AND len(shared) > 0
    AND len(shared)::DOUBLE / (nx + ny - len(shared)) >= 0.6)
{RATE} (SELECT CASE WHEN r.target_id IS NULL THEN 0 ELSE 1 END AS hit
  FROM cases c LEFT JOIN ranked r ON r.target_id = c.target_id AND r.dataset_id = c.dataset_id)
"""

SQL["facet_counts"] = """
SELECT 'category' AS facet, lang AS value, count(*) AS dataset_count FROM documents WHERE lang IS NOT NULL GROUP BY lang
UNION ALL SELECT 'organization', source, count(*) FROM documents WHERE source IS NOT NULL GROUP BY source
UNION ALL SELECT 'format', CASE WHEN n_chars < 1000 THEN 'short' ELSE 'long' END, count(*) FROM documents GROUP BY 2
"""

SQL["facet_labels"] = """
SELECT 'category' AS facet, p_type AS value, count(*) AS dataset_count, upper(p_type[1]) || lower(p_type[2:]) AS label_en,
  NULL::VARCHAR AS label_kh, p_type[1:3] AS abbreviation FROM part GROUP BY p_type
UNION ALL SELECT 'organization', p_brand, count(*), upper(p_brand[1]) || lower(p_brand[2:]), NULL, p_brand[1:3] FROM part GROUP BY p_brand
UNION ALL SELECT 'format', CASE WHEN p_size > 25 THEN 'big' ELSE 'small' END, count(*), NULL, NULL, NULL FROM part GROUP BY 2
"""

SQL["count_data"] = "SELECT count(*) AS datasets, count(DISTINCT source) AS datasources FROM documents"

SQL["home_summary"] = f"""
WITH {TITLES}
SELECT 'stats' AS section, 0 AS rank, NULL::VARCHAR AS id, 'datasets' AS title, count(*)::DOUBLE AS value FROM titles
UNION ALL SELECT 'stats', 0, NULL, 'downloads', sum(size)::DOUBLE FROM titles
UNION ALL SELECT * FROM (SELECT 'featured', row_number() OVER (ORDER BY price DESC, id)::INT, id::VARCHAR, title, price FROM titles ORDER BY price DESC, id LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'recent', row_number() OVER (ORDER BY id DESC)::INT, id::VARCHAR, title, id::DOUBLE FROM titles ORDER BY id DESC LIMIT 5)
"""

LISTING = TITLES + """,
listing AS (
  SELECT id, title AS name, category AS description, organization_id, price AS views_count,
    CASE WHEN size > 25 THEN 'CSV' ELSE 'xlsx' END AS format, lower(title || ' ' || category) AS t FROM titles)
"""

SQL["search_catalog"] = f"""
WITH {LISTING}
SELECT id, name, (contains(t, 'ring')::INT + contains(t, 'small')::INT) AS relevance, views_count FROM listing
WHERE (contains(t, 'ring') OR contains(t, 'small')) AND description IN ('ECONOMY', 'SMALL', 'LARGE')
  AND organization_id IN ('Brand#1', 'Brand#2', 'Brand#3', 'Brand#4', 'Brand#5') AND upper(format) = 'CSV'
ORDER BY views_count DESC, id LIMIT 5 OFFSET 5
"""

SQL["search_matches"] = f"""
WITH {LISTING}, m AS (
  SELECT id, name, contains(t, 'red')::INT + contains(t, 'widget')::INT + contains(t, 'economy')::INT AS relevance
  FROM listing WHERE upper(format) = 'XLSX')
SELECT * FROM m WHERE relevance > 0
"""

SQL["filter_format"] = f"WITH {LISTING} SELECT id, format FROM listing WHERE upper(format) = 'CSV'"

SQL["match_keyword"] = """
SELECT doc_id, relevance FROM (
  SELECT doc_id, contains(t, 'the')::INT + contains(t, 'onte')::INT + contains(t, 'der')::INT + contains(t, 'que')::INT AS relevance
  FROM (SELECT doc_id, lower(text || ' ' || source) AS t FROM documents)) WHERE relevance > 0
"""

SQL["auto_suggest"] = f"""
WITH {TITLES} SELECT DISTINCT title AS suggestion FROM titles WHERE contains(lower(title), 'ring') ORDER BY 1 LIMIT 10
"""

SQL["suggest_many"] = f"""
WITH {TITLES}, terms AS (
  SELECT DISTINCT unnest(list_concat([p_name, p_brand[4:7]], string_split(p_name, ' '))) AS term FROM part),
t AS (SELECT DISTINCT title AS suggestion FROM titles),
hits AS (
  SELECT term, suggestion, row_number() OVER (PARTITION BY term ORDER BY suggestion)::INT AS rank
  FROM terms JOIN t ON contains(lower(suggestion), lower(term)))
SELECT * FROM hits WHERE rank <= 10
"""

SQL["match_keywords"] = """
WITH d AS (SELECT doc_id AS id, lower(concat_ws(' ', text, source)) AS t FROM documents),
terms AS (
  SELECT DISTINCT item_id AS key, unnest(string_split_regex(lower(text), '\\s+')) AS term FROM benchmark),
words AS (SELECT DISTINCT term FROM terms WHERE term <> ''),
hit AS (SELECT term, id FROM words JOIN d ON contains(d.t, term)),
df AS (SELECT term, count(*) AS n FROM hit GROUP BY term),
w AS (SELECT term, ln(1 + ((SELECT count(*) FROM d) - n + 0.5) / (n + 0.5)) AS w FROM df),
m AS (
  SELECT key, id, count(*) AS relevance, sum(w) AS weight
  FROM terms JOIN hit USING (term) JOIN w USING (term) GROUP BY key, id),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY relevance DESC, round(weight, 6) DESC, id)::INT AS rank FROM m)
SELECT key, id, relevance, round(weight, 4) AS weight, rank FROM r WHERE rank <= 20
"""

_SORTS = {
    "NEWEST": "lpad((id * 7919 % 1000)::VARCHAR, 4, '0')",
    "RECENTLY_UPDATED": "CASE WHEN id % 10 > 0 THEN lpad((id * 31 % 97)::VARCHAR, 3, '0') END",
    "MOST_DOWNLOADED": "id * 17 % 53",
    "MOST_POPULAR": "views_count",
    "MOST_RELEVANT": "contains(t, 'ring')::INT + contains(t, 'small')::INT",
}
SQL["sort_orders"] = f"WITH {LISTING}" + " UNION ALL ".join(
    f"""
SELECT * FROM (
  SELECT '{name}' AS sort_by, row_number() OVER (ORDER BY {order} DESC NULLS LAST, id) AS position, id, name FROM listing
  WHERE contains(t, 'ring') OR contains(t, 'small')) WHERE position <= 10"""
    for name, order in _SORTS.items()
)

DESCRIBED = TITLES + """,
described AS (
  SELECT id, regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g') || '-' || id AS slug,
    CASE WHEN size % 5 = 0 THEN '' ELSE title END AS title_en, CASE WHEN size % 3 = 0 THEN upper(title) END AS title_kh,
    category AS description_en, NULL::VARCHAR AS description_kh FROM titles)
"""

SQL["detail_lookup"] = f"""
WITH {DESCRIBED}, keys AS (SELECT l_partkey::VARCHAR AS key FROM lineitem UNION SELECT slug FROM described)
SELECT key, id, coalesce(nullif(title_kh, ''), nullif(title_en, '')) AS title, description_en AS description
FROM keys JOIN described ON key = id::VARCHAR OR key = slug
"""

SQL["seo_projection"] = f"WITH {DESCRIBED} SELECT * FROM described"

SQL["sort_pages"] = """
SELECT doc_id, n_chars, (r - 1) // 20 + 1 AS page, (r - 1) % 20 + 1 AS position
FROM (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) AS r FROM documents)
"""

SQL["page_envelope"] = """
SELECT count(*) AS total, 1 AS page, 20 AS page_size, ceil(count(*) / 20.0)::BIGINT AS total_pages FROM documents
"""

SQL["display_rank"] = """
SELECT source, count(*) AS dataset_count, row_number() OVER (ORDER BY count(*) DESC, source) AS position
FROM documents GROUP BY source
"""

SQL["list_articles"] = """
SELECT conv_id || '-' || turn AS id, role AS category, md5(text) AS digest, turn AS created_at FROM conversations
WHERE role = 'assistant' AND contains(lower(text), 'the')
ORDER BY text ASC NULLS LAST, conv_id || '-' || turn LIMIT 10 OFFSET 10
"""

SQL["group_ids"] = """
SELECT coalesce(nullif(s_nationkey, 0)::VARCHAR, 'unknown') AS nation, count(*) AS n_ids,
  string_agg(s_suppkey, ',' ORDER BY s_suppkey) AS ids FROM supplier GROUP BY 1
"""

SQL["group_members"] = """
WITH c AS (SELECT coalesce(nullif(c_nationkey, 0)::VARCHAR, 'unknown') AS nation, c_custkey FROM customer)
SELECT nation, c_custkey, count(*) OVER (PARTITION BY nation) AS n_ids FROM c
"""

LINES = """
lines AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus) - 1 AS pos
  FROM lineitem)
"""

SQL["flatten"] = f"""
WITH {LINES}, names AS (
  SELECT l_orderkey, string_agg(CASE WHEN l_returnflag = 'N' THEN l_linestatus ELSE l_returnflag END, ' | ' ORDER BY pos) AS categories
  FROM lines GROUP BY l_orderkey)
SELECT o_orderkey::VARCHAR AS id, 'Order ' || o_orderkey AS name, o_orderstatus AS format, o_orderpriority AS frequency,
  CASE WHEN c_custkey % 2 = 1 THEN c_name ELSE c_mktsegment END AS organization,
  CASE WHEN c_custkey % 2 = 1 THEN '' ELSE 'AB' END AS organization_abbr,
  coalesce(categories, '') AS categories, o_custkey AS views, strftime(o_orderdate, '%Y-%m-%d') AS created_at
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN names ON l_orderkey = o_orderkey
"""

SQL["unwrap_envelope"] = f"""
WITH {LINES}, n AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, pos, l_partkey AS id, l_quantity AS quantity, n AS n_records, n AS total,
  CASE l_orderkey % 4 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 3 THEN 1 END::VARCHAR AS page,
  CASE l_orderkey % 4 WHEN 0 THEN 5 WHEN 3 THEN n END::VARCHAR AS page_size,
  CASE l_orderkey % 4 WHEN 1 THEN 9 WHEN 3 THEN 1 END::VARCHAR AS total_pages
FROM lines JOIN n ON k = l_orderkey
"""

SQL["check_completeness"] = """
SELECT true AS matched, count(DISTINCT l_orderkey) AS bodies, count(*) AS pulled FROM lineitem
"""

SQL["assemble_pages"] = """
SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS ord, o_orderkey AS id FROM orders
WHERE o_orderkey // 200 + 1 <= (SELECT max(o_orderkey // 200 + 1) // 2 FROM orders)
"""

SQL["json_payload"] = """
SELECT event_id AS id, value, (props::JSON ->> '$.k')::BIGINT AS k FROM events
"""

SQL["preview_rows"] = f"""
WITH {LINES}, n AS (SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1)
SELECT l_orderkey, pos, 'part,supplier' AS columns, l_partkey::VARCHAR AS part, l_suppkey::VARCHAR AS supplier, n AS total
FROM lines JOIN n ON k = l_orderkey
"""

SQL["preview_wide"] = f"""
WITH {LINES}
SELECT l_orderkey, pos, l_partkey AS part, CASE WHEN l_orderkey % 2 = 0 THEN l_quantity END AS amount,
  CASE WHEN l_orderkey % 2 > 0 THEN 's' || l_suppkey END AS supplier,
  CASE WHEN l_orderkey % 2 > 0 THEN (l_suppkey % 2 = 0)::VARCHAR END AS even
FROM lines
"""

SQL["geo_features"] = f"""
WITH {LINES}
SELECT l_orderkey, pos, 'FeatureCollection' AS collection_type, 'Point' AS geometry_type,
  '[' || l_partkey || ',' || l_suppkey || ']' AS coordinates, l_linenumber::BIGINT AS line FROM lines
"""

SQL["file_entries"] = """
SELECT o_orderkey AS dataset_id, 'part_' || l_partkey || '.csv' AS name,
  CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey::VARCHAR WHEN l_suppkey IS NOT NULL THEN '1,2 kB' END AS size,
  CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey END::VARCHAR AS size_bytes
FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
"""

INDEX = """
idx AS (
  SELECT o_orderkey, CASE WHEN n > 0 THEN 'file' WHEN o_orderstatus = 'P' THEN 'json' ELSE 'none' END AS method, n,
    CASE WHEN coalesce(n, 0) = 0 AND o_orderstatus = 'P' THEN o_custkey END AS json_row_count
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)
"""
SQL["access_method"] = f"WITH {INDEX} SELECT o_orderkey, method, json_row_count::VARCHAR AS json_row_count FROM idx"
SQL["harvest_summary"] = f"""
WITH {INDEX}
SELECT count(*) AS datasets, count(*) FILTER (method = 'file') AS file_datasets, count(*) FILTER (method = 'json') AS json_datasets,
  count(*) FILTER (method = 'none') AS none_datasets, sum(CASE WHEN method = 'file' THEN n ELSE 0 END)::BIGINT AS total_files,
  sum(coalesce(json_row_count, 0))::BIGINT AS preview_rows FROM idx
"""
SQL["large_previews"] = f"""
WITH {INDEX} SELECT o_orderkey, json_row_count FROM idx WHERE method = 'json' AND coalesce(json_row_count, 0) > 700
"""
SQL["fetch_status_counts"] = """
SELECT CASE WHEN o_orderstatus = 'P' THEN 'error' WHEN n > 0 THEN 'with_columns' ELSE 'no_column_data' END AS status, count(*) AS n
FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1
"""

SQL["pending_antijoin"] = """
SELECT doc_id AS id, lang AS category FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND coalesce(toxic, 0) <> 1)
"""


def newest(keys: str, fields: str, where: str = "true", desc: str = "DESC") -> str:
    return f"""SELECT {fields} FROM (
      SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY ts {desc}, event_id {desc}) AS r FROM events WHERE {where})
      WHERE r = 1"""


SQL["last_wins"] = newest("user_id", "user_id, event_id AS id, value")
SQL["first_wins"] = newest("user_id, event_type", "user_id, event_type AS name, event_id AS id", desc="ASC")
SQL["merge_runs"] = newest("user_id, event_type", "user_id, event_type AS name, event_id AS id, value")
SQL["snapshot_diff"] = """
WITH o AS (SELECT user_id, count(*) AS n FROM events WHERE ts < '2024-01-16' GROUP BY 1),
n AS (SELECT user_id, count(*) AS n FROM events WHERE ts >= '2024-01-16' GROUP BY 1)
SELECT coalesce(o.user_id, n.user_id) AS user_id, o.n::VARCHAR AS old_value, n.n::VARCHAR AS new_value,
  CASE WHEN o.n IS NULL THEN 'added' WHEN n.n IS NULL THEN 'removed' WHEN o.n = n.n THEN 'unchanged' ELSE 'changed' END AS change,
  coalesce(n.n, 0) - coalesce(o.n, 0) AS delta
FROM o FULL JOIN n ON o.user_id = n.user_id
"""
SQL["updated_since"] = """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders WHERE o_orderdate > TIMESTAMP '1998-06-30'
"""
SQL["latest_per_key"] = newest("event_type", "event_type AS name, event_id AS id, value, props")
SQL["stream_latest"] = SQL["latest_per_key"]
SQL["stream_latest_delayed"] = newest("user_id", "user_id AS name, event_id AS id, value")
SQL["latest_per_user"] = newest("user_id, event_type", "user_id, event_type AS name, event_id AS id, value")
SQL["today_only"] = newest(
    "event_type", "event_type AS currency_id, event_id AS id, value", "ts::DATE = DATE '2024-01-15'"
)

# The provinces in the order of the catalogue.
PROVINCE_LIST = """[
  'Phnom Penh', 'Sihanoukville', 'Siem Reap', 'Battambang', 'Takeo', 'Koh Kong', 'Kratie', 'Kampot', 'Kep',
  'Kampong Thom', 'Svay Rieng', 'Mondulkiri', 'Banteay Meanchey', 'Kandal', 'Prey Veng', 'Kampong Chhnang',
  'Strung Treng', 'Preah Vihear', 'Tboung Khmum', 'Pailin', 'Ratanakiri', 'Kampong Speu', 'Kampong Cham',
  'Oddar Meanchey', 'Pursat']"""
SQL["validate_key"] = f"""
WITH d AS (SELECT {PROVINCE_LIST} AS l),
requested AS (
  SELECT s_suppkey, s_suppkey % 27 AS i, coalesce(l[(s_suppkey % 27 + 1)::INT], 'Unknown ' || (s_suppkey % 27)) AS name FROM supplier, d),
have AS (SELECT DISTINCT l[(user_id % 20 + 1)::INT] AS name FROM events, d)
SELECT s_suppkey, r.name, CASE WHEN i >= 25 THEN 400 WHEN h.name IS NULL THEN 404 ELSE 200 END AS status,
  CASE WHEN i >= 25 THEN 'ERROR_PARAMS' WHEN h.name IS NULL THEN 'REAL_TIME_API_DATA_NOT_FOUND' END AS error_name,
  CASE WHEN i >= 25 THEN 'Invalid province' WHEN h.name IS NULL THEN 'Weather data not found' END AS error_msg
FROM requested r LEFT JOIN have h ON h.name = r.name
"""

_MAIL = "^[^@ ]+@[A-Za-z0-9-]+([.][A-Za-z0-9-]+)+$"
SQL["validate_rows"] = f"""
WITH s AS (
  SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN '  ' ELSE ' ' || c_name END AS first_name, c_mktsegment AS last_name,
    CASE c_custkey % 3 WHEN 0 THEN 'u' || c_custkey || '@example.com' WHEN 1 THEN 'u' || c_custkey ELSE 'u' || c_custkey || '@host' END AS email,
    repeat('7', (c_custkey % 20)::INT) AS phone, CASE WHEN c_custkey % 11 <> 0 THEN c_name END AS message
  FROM customer),
e AS (
  SELECT c_custkey, trim(first_name) AS first_name, list_filter([
    CASE WHEN trim(first_name) = '' THEN 'first_name' END,
    CASE WHEN trim(last_name) = '' THEN 'last_name' END,
    CASE WHEN coalesce(trim(message), '') = '' THEN 'message' END,
    CASE WHEN NOT regexp_matches(email, '{_MAIL}') THEN 'email' END,
    CASE WHEN length(phone) NOT BETWEEN 9 AND 15 THEN 'phone' END], lambda x: x IS NOT NULL) AS errors FROM s)
SELECT c_custkey, first_name, array_to_string(errors, ',') AS errors, len(errors) AS n_errors FROM e
"""

SQL["sample_ids"] = "SELECT doc_id FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 10"

SQL["typed_lines"] = """
SELECT event_id, CASE WHEN event_id % 7 > 0 THEN (props::JSON ->> '$.k')::BIGINT END AS k,
  CASE WHEN event_id % 7 = 0 THEN 'json_invalid' END AS error
FROM events
"""

SQL["time_stamps"] = """
WITH t AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL
    WHEN o_orderkey % 2 = 0 THEN date_trunc('second', o_orderdate) - INTERVAL 7 HOUR
    ELSE date_trunc('second', o_orderdate) END AS moment
  FROM orders)
SELECT o_orderkey, strftime(moment, '%Y-%m-%dT%H:%M:%SZ') AS iso, strftime(moment, '%Y%m%d') AS stamp FROM t
"""

SQL["usable_ids"] = """
SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN p_name ELSE p_brand END AS usable FROM part
"""

SQL["judge_prompts"] = """
SELECT p_partkey, md5('Compare two datasets of an open-data catalogue.' || chr(10) || 'First: "' || p_name || '"' || chr(10)
  || 'Second: "' || p_type || '"' || chr(10) || 'Columns in both: ' || p_brand || ', ' || p_size || chr(10)
  || 'similar: do they treat the same topic?' || chr(10)
  || 'joinable: do they share a key such as a place or a country that makes a join useful? '
  || 'A year or month alone is a weak key.' || chr(10)
  || 'Answer as JSON: {"similar": true or false, "joinable": true or false, "reasoning": "one or two sentences"}') AS prompt
FROM part
"""

SQL["judge_calls"] = f"""
WITH p AS ({SQL["judge_prompts"]})
SELECT p_partkey, (prompt[1] <> '0' AND prompt[2] < '8')::VARCHAR AS similar,
  (prompt[1] <> '0' AND prompt[3] < '8')::VARCHAR AS joinable,
  CASE WHEN prompt[1] = '0' THEN 'Error: ConnectionError: ' || prompt[1:4] ELSE prompt[4:9] END AS reasoning,
  'judge' AS label_source
FROM p
"""

SQL["landed_extras"] = """
SELECT p_partkey::VARCHAR AS id, p_name AS name, p_partkey AS views_count, p_size::BIGINT AS organization_id,
  p_brand AS organization_name, CASE WHEN p_partkey % 3 > 0 THEN p_type END AS license, p_retailprice AS price,
  p_brand || '|' || p_type AS tags
FROM part
"""

SQL["labeled_pairs"] = f"""
WITH {PAGES}, p AS (
  SELECT a.id + b.id AS n, len(list_intersect(a.columns, b.columns)) AS s, len(a.columns) AS na, len(b.columns) AS nb
  FROM records a JOIN records b ON a.id < b.id WHERE len(a.columns) > 0 AND len(b.columns) > 0)
SELECT CASE WHEN n % 3 > 0 THEN 'judge' END AS label_source, count(*) AS pairs,
  count(*) FILTER (n % 3 > 0 AND n % 2 = 0) AS joinable, count(*) FILTER (n % 3 > 0) AS similar
FROM p WHERE s::DOUBLE / (na + nb - s) >= 0.6 GROUP BY 1
"""

_TYPE, _BRAND, _NAME = (
    ALIASED.format(c="(" + COLUMN_NAME.format(c=c) + ")") for c in ("p_type", "p_brand || ' _en'", "p_name")
)

LANDED = f"""
landed AS (
  SELECT p_partkey, p_partkey::VARCHAR AS id, p_name || ' ' || (p_size + 2000) AS title, p_brand, p_type,
    CASE WHEN p_partkey % 2 = 0 THEN 'monthly' ELSE 'yearly' END AS frequency, p_partkey % 4 = 0 AS covered,
    list_distinct(CASE WHEN p_partkey % 3 = 0 THEN ['old_name', {_TYPE}] ELSE ['year', {_BRAND}, {_NAME}] END) AS columns
  FROM part WHERE p_partkey % 50 <> 49),
recs AS (
  SELECT id, title, {title_key('title')} AS series_key, (p_partkey % 25)::VARCHAR AS org, p_brand, p_type AS category,
    frequency, covered, columns FROM landed),
records AS (
  SELECT *, list_distinct(list_filter(string_split(series_key, ' '), lambda x: x <> '')) AS words,
    CASE WHEN series_key = '' THEN '#' || id ELSE series_key END AS series
  FROM recs)
"""

SQL["landed_records"] = f"""
WITH {LANDED}
SELECT id, title, series_key, org::BIGINT AS organization_id, p_brand AS organization_name, frequency,
  covered::VARCHAR AS covered, category, array_to_string(list_sort(columns), ',') AS columns
FROM records
"""

SQL["similar_landed"] = f"""
WITH {LANDED}{SCORED.removeprefix(PAGES)}, {ranked('same_org')}
SELECT target_id, rank, dataset_id, round(score, 4) AS score FROM ranked
"""

SQL["landed_schema_columns"] = f"""
WITH {LANDED} SELECT id, array_to_string(list_sort(columns), ',') AS columns FROM landed
"""

SQL["first_category"] = f"""
WITH {LANDED}
SELECT id, title, p_partkey % 25 AS organization_id, p_brand AS organization_name, p_type AS category_slug, frequency,
  CASE WHEN covered THEN '2000' END AS coverage_start, CASE WHEN covered THEN '2010' END AS coverage_end
FROM landed
"""

SQL["export_and_read"] = f"""
WITH {LANDED}
SELECT id, title AS name, p_brand AS organization, p_type AS categories, frequency,
  count(*) OVER () AS pulled, 7 AS api_total, '2024-05-06T23:30:00Z' AS fetched_at
FROM landed
"""

SQL["snapshots"] = """
SELECT '20240506' AS snapshot_date, '2024-05-06T23:30:00Z' AS fetched_at, o_orderstatus, count(*) AS orders, sum(o_orderkey)::BIGINT AS keys
FROM orders GROUP BY ALL
UNION ALL
SELECT '20240507', '2024-05-07T01:00:00Z', o_orderstatus, count(*), sum(o_orderkey)::BIGINT
FROM orders WHERE o_orderkey % 2 = 0 GROUP BY ALL
"""

SQL["completeness"] = """
SELECT max(n) AS api_reported_total, sum(n)::BIGINT AS pulled_count, max(n) = sum(n) AS count_matched
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey)
"""

SQL["rejected_vectors"] = """
SELECT vec_id AS id, CASE WHEN vec_id % 9 = 0 THEN 'length 10 instead of 64' ELSE 'no vector' END AS reason
FROM embeddings WHERE vec_id % 9 = 0 OR vec_id % 11 = 0
"""

SQL["stream_catalog"] = """
SELECT id, name, event_id FROM (
  SELECT user_id AS id, event_type AS name, event_id,
    row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1
"""
