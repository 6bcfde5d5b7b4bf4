"""Shared pieces of the comparison SQL."""

from vectorloom.functions.text import STRIP_CHARS
from vectorloom.plans.tables import QUERY, TABLE_MODEL

STRIP = "'" + STRIP_CHARS + "'"

DOCS = """docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS bibcode, source AS title, text AS abstract, lang,
         CAST(2000 + doc_id % 10 AS INTEGER) AS year, doc_id AS seq,
         (doc_id % 10) * 70368744177664 + doc_id AS arrival
  FROM documents)"""

HASHED = f"""{DOCS},
hashed AS (
  SELECT bibcode, year, arrival, lower(abstract) AS text,
         sha256(lower(trim(lower(abstract), {STRIP}))) AS text_hash
  FROM docs WHERE abstract <> ''),
firsts AS (
  SELECT text_hash, min(arrival) AS arrival, count(*) AS copies,
         arg_min(bibcode, arrival) AS first_seen_bibcode, arg_min(year, arrival) AS first_seen_year
  FROM hashed GROUP BY text_hash)"""

VECS = f"""vecs AS (
  SELECT CAST(vec_id AS VARCHAR) AS bibcode, CAST(2000 + vec_id % 10 AS INTEGER) AS year,
         '{TABLE_MODEL}' AS model, (vec_id % 10) * 70368744177664 + vec_id AS arrival,
         embedding, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, label
  FROM embeddings)"""

CATALOG = f"""{DOCS}, {VECS},
log AS (
  SELECT bibcode, year, row_number() OVER (PARTITION BY year ORDER BY arrival) - 1 AS row_id,
         '{TABLE_MODEL}' AS model, 1 AS version FROM docs
  UNION ALL
  SELECT bibcode, year + 10, row_number() OVER (PARTITION BY year ORDER BY arrival) - 1,
         model, 2 FROM vecs),
catalog AS (
  SELECT *, 'embeddings_' || replace(replace(model, '/', '_'), ':', '_') || '_' || year AS vector_file,
         count(*) OVER (PARTITION BY bibcode, model) - 1 AS replaced
  FROM log QUALIFY row_number() OVER (PARTITION BY bibcode, model ORDER BY version DESC, row_id DESC) = 1)"""


def hashed_vectors(name: str, source: str, key: str, text: str, dim: int) -> str:
    """CTEs for the sparse hashing vectors of a text column: ``{name}(key, d, x)``."""
    return f"""{name}_tok AS (
  SELECT {key}, unnest(regexp_split_to_array({text}, '[ \\t\\n\\r\\f\\x0b]+')) AS t FROM {source}),
{name}_cnt AS (
  SELECT {key}, ('0x' || substr(md5(t), 1, 8))::BIGINT % {dim} AS d,
         sum(CASE WHEN substr(md5(t), 9, 1) < '8' THEN 1 ELSE -1 END)::DOUBLE AS c
  FROM {name}_tok WHERE t <> '' GROUP BY 1, 2),
{name}_len AS (SELECT {key}, sqrt(sum(c * c)) AS len FROM {name}_cnt GROUP BY 1),
{name}_raw AS (
  SELECT {key}, d, CAST(CAST(c / len AS FLOAT) AS DOUBLE) AS x
  FROM {name}_cnt JOIN {name}_len USING ({key}) WHERE len > 0),
{name} AS (
  SELECT {key}, d, x / sqrt(sum(x * x) OVER (PARTITION BY {key})) AS x, x AS stored FROM {name}_raw)"""


QUERY_TEXT = f"q_text AS (SELECT 0 AS q, '{QUERY}' AS text)"

QUERY_VECTOR = """probe AS (
  SELECT list_transform(p, lambda x: x / sqrt(list_sum(list_transform(p, lambda y: y * y)))) AS p
  FROM (SELECT list_transform(range(64), lambda i: sin(i + 1)) AS p))"""


def bm25(name: str, source: str, key: str, text: str, query: str = QUERY) -> str:
    """CTEs for the BM25 score of one query: ``{name}(key, keyword)``."""
    words = ", ".join(f"('{w}')" for w in dict.fromkeys(query.split()))
    return f"""{name}_term AS (SELECT * FROM (VALUES {words}) AS v(t)),
{name}_word AS (
  SELECT {key}, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}]+')) AS t FROM {source}),
{name}_size AS (
  SELECT s.{key}, coalesce(n, 0) AS n
  FROM {source} s LEFT JOIN (SELECT {key}, count(*) AS n FROM {name}_word WHERE t <> '' GROUP BY 1) USING ({key})),
{name}_tf AS (SELECT {key}, t, count(*) AS tf FROM {name}_word SEMI JOIN {name}_term USING (t) GROUP BY 1, 2),
{name}_df AS (SELECT t, count(*) AS df FROM {name}_tf GROUP BY 1),
{name}_all AS (SELECT count(*) AS total, avg(n) AS mean FROM {name}_size),
{name} AS (
  SELECT {key}, round(sum(ln(1 + (total - df + 0.5) / (df + 0.5)) * tf * 2.2
         / (tf + 1.2 * (0.25 + 0.75 * n / mean))), 9) AS keyword
  FROM {name}_tf JOIN {name}_df USING (t) JOIN {name}_size USING ({key}), {name}_all GROUP BY 1)"""
