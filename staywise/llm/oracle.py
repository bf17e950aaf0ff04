"""SQL for the rows of those queries that SQL can express over whole tables."""

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, {_WORDS} AS size,
         md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS o
  FROM documents),
each AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source),
weighed AS (
  SELECT *, CASE place % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 3 * total AS cap
  FROM each),
parts AS (
  SELECT *, CAST(sum(total) OVER () AS BIGINT) AS budget,
    CAST(sum(total) OVER () - coalesce(sum(cap) OVER fuller, 0) AS DOUBLE)
      / CAST(sum(w) OVER () - coalesce(sum(w) OVER fuller, 0) AS DOUBLE) AS part
  FROM weighed
  WINDOW fuller AS (ORDER BY CAST(cap AS DOUBLE) / w, place
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, total, place, w, budget,
    least(CAST(cap AS DOUBLE), (SELECT max(part) FROM parts) * w) AS target
  FROM parts),
placed AS (
  SELECT doc_id, size, s.source, t.total, t.place, t.w, t.budget, t.target,
    sum(size) OVER (PARTITION BY s.source ORDER BY o, doc_id, size
                    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
copies AS (
  SELECT doc_id, size, upto, place, budget,
    CAST(e * total + upto AS DOUBLE) / w AS finish
  FROM placed, (VALUES (0), (1), (2)) AS epochs(e) WHERE size > 0),
taken AS (
  SELECT place, upto, count(*) AS n FROM (
    SELECT *, sum(size) OVER (ORDER BY finish, place
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS used
    FROM copies)
  WHERE used <= budget GROUP BY ALL)
SELECT p.doc_id, p.size, p.total AS source_size, p.target,
       CASE WHEN p.size > 0 THEN p.size * coalesce(n, 0) ELSE 0 END AS taken
FROM placed p LEFT JOIN taken t ON p.place = t.place AND p.upto = t.upto AND p.size > 0
"""

_RULES = """
WITH split AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
rules(h, p, v) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
judged AS (
  SELECT *, (SELECT max({'n': length(h || p), 'rule': h || p, 'verdict': v}) FROM rules
             WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
  FROM split)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict
FROM judged
"""

_TOP = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id,
  CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 5
"""

_NEAR = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
unit AS (SELECT *, sqrt(list_inner_product(v, v)) AS n FROM v),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b
  FROM unit x JOIN unit y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_inner_product(x.v, y.v) / (x.n * y.n) >= 0.98),
reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(least.b, vec_id)) AS component_id,
       vec_id <= coalesce(least.b, vec_id) AS kept
FROM embeddings LEFT JOIN least ON vec_id = least.a LEFT JOIN degree ON vec_id = degree.a
"""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# A checksum is a table look-up per byte; the table is made as the polynomial says.
_DRAW = rf"""
WITH tab AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS tab
  FROM range(256) AS r(b)),
texts AS (
  SELECT 's' AS side, doc_id, text FROM documents UNION ALL SELECT 't', NULL, text FROM benchmark),
worded AS MATERIALIZED (
  SELECT side, row_number() OVER () AS row, doc_id, regexp_extract_all(
    {_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
runs AS (
  SELECT side, row, unnest(list_concat(w,
    list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS f
  FROM worded),
counted AS MATERIALIZED (SELECT side, row, f, count(*) AS n FROM runs GROUP BY ALL),
spelled AS (SELECT f, hex(f) AS h FROM (SELECT DISTINCT f FROM counted)),
bucketed AS MATERIALIZED (
  SELECT f, xor(list_reduce(
      list_transform(range(1, len(h), 2), lambda i: CAST('0x' || h[i:i + 1] AS BIGINT)),
      lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 10000 AS b
  FROM spelled, tab),
sides AS (
  SELECT b, coalesce(sum(n) FILTER (side = 's'), 0) AS s, coalesce(sum(n) FILTER (side = 't'), 0) AS t
  FROM counted JOIN bucketed USING (f) GROUP BY b),
totals AS (SELECT coalesce(sum(s), 0) AS s_, coalesce(sum(t), 0) AS t_ FROM sides),
gains AS (
  SELECT b, CAST(floor(1000 * ln((CAST(t + 1 AS DOUBLE) * CAST(s_ + 10000 AS DOUBLE))
    / (CAST(s + 1 AS DOUBLE) * CAST(t_ + 10000 AS DOUBLE)))) AS BIGINT) AS gain FROM sides, totals),
weighed AS (
  SELECT row, sum(n) AS n, sum(n * gain) AS weight
  FROM counted JOIN bucketed USING (f) JOIN gains USING (b) WHERE side = 's' GROUP BY row),
scored AS (
  SELECT d.row, doc_id, len(w) >= 20 AS fit, CAST(coalesce(n, 0) AS BIGINT) AS n_features,
    CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || sha256('42:' ||
      coalesce(CAST(doc_id AS VARCHAR), ''))[1:8] AS BIGINT) + 0.5) / 4294967296.0E0))) AS BIGINT) AS score
  FROM worded d LEFT JOIN weighed USING (row) WHERE side = 's'),
placed AS (
  SELECT *, row_number() OVER (ORDER BY fit DESC, score DESC, doc_id, row) AS place,
    count(*) FILTER (fit) OVER () * 5 // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank
FROM placed
"""

_SHARE = "1 + (1000000000::HUGEINT * ({} + 5)) // ({})"

_AUDIT = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER.format("coalesce(text, '')")},
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
terms AS (SELECT row, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (
  SELECT lang, term, count(*) AS n FROM terms GROUP BY ALL HAVING count(DISTINCT row) >= 30),
langs AS (SELECT lang, count(*) AS v, sum(n) AS n_ FROM kept GROUP BY lang),
counts AS MATERIALIZED (
  SELECT lang, source, term, count(*) AS n FROM terms SEMI JOIN kept USING (lang, term) GROUP BY ALL),
groups AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS n_
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST({_SHARE.format("coalesce(c.n, 0)", "g.n_ + 5 * l.v")} AS BIGINT) AS p,
    CAST({_SHARE.format("k.n", "l.n_ + 5 * l.v")} AS BIGINT) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
apart AS (
  SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source
  GROUP BY ALL),
found AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item,
    CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN apart a ON a.lang = x.lang AND a.source = x.source AND a.item = y.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (
    PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op1_topk_search": _TOP,
    "op3_mix_sources": _MIX,
    "op8_vector_classes": _NEAR,
    "op6_url_filter": _RULES,
    "op12_importance_draw": _DRAW,
    "op13_source_divergence": _AUDIT,
}
