"""The registered queries of this subpackage; thin forms of its operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from vectorloom.llm import byte_bpe, chunk_prints, exact_dedup, lexical_search, ngram_join, ngram_lm, packing, prefix_trie, quality, secret_scan, sharding, token_files, toxicity
from vectorloom.llm.common import documents
from vectorloom.plans.registry import query


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file of the installed package."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_files")
def op1_token_files(spark, sf_dir):
    return token_files.write_and_read(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), end_id=0)


@query("op2_chunk_prints")
def op2_chunk_prints(spark, sf_dir):
    return chunk_prints.compare_edited(documents(spark, sf_dir))


@query("op3_byte_bpe")
def op3_byte_bpe(spark, sf_dir):
    return byte_bpe.round_trip(documents(spark, sf_dir), vocabulary("byte_bpe_multi_50k.tiktoken"))


@query("op4_secret_scan")
def op4_secret_scan(spark, sf_dir):
    return secret_scan.find_secrets(documents(spark, sf_dir))


@query("op5_shard")
def op5_shard(spark, sf_dir):
    shards = sharding.shard_by_bytes(documents(spark, sf_dir))
    return shards.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    return toxicity.score_documents(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


OP7_SQL = r"""
WITH norm AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM norm WINDOW w AS (PARTITION BY t)
"""


@query("op7_exact_dedup", OP7_SQL)
def op7_exact_dedup(spark, sf_dir):
    return exact_dedup.find_copies(documents(spark, sf_dir))


@query("op8_pack")
def op8_pack(spark, sf_dir):
    return packing.pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json"), capacity=1024, end_id=2)


OP9_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r) AS component_id
FROM documents d JOIN reach USING (doc_id) LEFT JOIN sizes s USING (doc_id) GROUP BY d.doc_id
"""


@query("op9_ngram_join", OP9_SQL)
def op9_ngram_join(spark, sf_dir):
    return ngram_join.near_duplicates(documents(spark, sf_dir))


@query("op10_quality")
def op10_quality(spark, sf_dir):
    return quality.score_documents(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), corpus AS (
  SELECT count(*) AS nd, sum(len(w))::BIGINT AS nt FROM words WHERE len(w) > 0
), wanted AS (
  SELECT item_id, t, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY item_id, t
), held AS (
  SELECT doc_id, t, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM words)
  WHERE t IN (SELECT t FROM wanted) GROUP BY doc_id, t
), weights AS (
  SELECT t, floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM held, corpus GROUP BY t, nd
), scored AS (
  SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // nt))))::BIGINT AS score
  FROM wanted JOIN held USING (t) JOIN weights USING (t), corpus GROUP BY item_id, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 20
"""


@query("op11_lexical_search", OP11_SQL)
def op11_lexical_search(spark, sf_dir):
    return lexical_search.rank_documents(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"), k=20)


@query("op12_ngram_lm")
def op12_ngram_lm(spark, sf_dir):
    return ngram_lm.score_documents(documents(spark, sf_dir))


OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i,
         coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({'role': role, 'text': text} ORDER BY i) AS l, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    flatten(list_transform(range(1, length(c::VARCHAR) + 1),
      lambda j: list_prepend(ascii(substr(c::VARCHAR, j, 1))::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
    lambda x, y: CASE WHEN y >= 0 THEN xor(x, y) ELSE xor(x >> 1, (x & 1) * 3988292384) END)) % 6 AS h
  FROM turns GROUP BY c
), rebuilt AS (
  SELECT o.c, list_concat(coalesce(b.l, [])[1:o.h], o.l[o.h + 1:]) AS l FROM own o LEFT JOIN own b ON b.c = o.c - o.c % 100
), prefixes AS (
  SELECT c, len(l) AS n, d, l[1:d] AS p, CASE WHEN d > 0 THEN l[1:d - 1] END AS up, coalesce(length(l[d].text), 0) AS chars
  FROM (SELECT c, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT d, p, min(c) AS conv_id, any_value(up) AS up, count(*) AS n_convs, (count(*) - 1) * any_value(chars) AS saved,
         coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '') AS ends FROM prefixes GROUP BY d, p
), linked AS (
  SELECT n.*, u.conv_id AS parent_conv_id FROM nodes n LEFT JOIN nodes u ON u.d = n.d - 1 AND u.p = n.up
), children AS (
  SELECT parent_conv_id AS conv_id, d - 1 AS d, count(*) AS n FROM linked WHERE d > 0 GROUP BY ALL
), counted AS (
  SELECT l.*, coalesce(k.n, 0) AS n_children FROM linked l LEFT JOIN children k ON k.conv_id = l.conv_id AND k.d = l.d
), totals AS (
  SELECT a.d, a.conv_id, sum(b.saved)::BIGINT AS saved_tokens, count(*) FILTER (WHERE b.n_children = 0) AS n_leaves
  FROM counted a JOIN counted b ON b.d >= a.d AND b.p[1:a.d] = a.p GROUP BY a.d, a.conv_id
)
SELECT c.conv_id, c.d AS depth, c.parent_conv_id, c.n_convs, c.n_children, t.n_leaves, t.saved_tokens, sha256(c.ends) AS ends_sha256
FROM counted c JOIN totals t ON t.d = c.d AND t.conv_id = c.conv_id
"""


@query("op13_prefix_trie", OP13_SQL)
def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.build(documents(spark, sf_dir, "conversations"))
