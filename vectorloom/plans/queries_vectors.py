"""Queries on vectors, the catalog, search and exports."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.functions import vectors as V
from vectorloom.operators import ann as N
from vectorloom.operators import catalog as C
from vectorloom.operators import embed as E
from vectorloom.operators import export as X
from vectorloom.operators import hybrid as H
from vectorloom.operators import search as S
from vectorloom.operators import stats as A
from vectorloom.operators.store import VectorStore
from vectorloom.plans import tables as B
from vectorloom.plans.flagship import neighbours_of_unique_records
from vectorloom.plans.oracle_parts import CATALOG, DOCS, HASHED, QUERY_TEXT, QUERY_VECTOR, VECS, bm25, hashed_vectors
from vectorloom.plans.registry import query
from vectorloom.session import shared_folder


def _checksum(column="embedding"):
    return F.round(V.component_sums(column)[0], 6).alias("checksum")


def _digits(column, scale=1e6):
    """A vector as text, so that all components are compared."""
    return F.array_join(F.transform(column, lambda x: F.round(x.cast("double") * scale).cast("bigint").cast("string")), ",")


def _six(column):
    return F.round(column, 6)


def _embedded(spark, sf_dir, model=B.MODEL):
    """All documents through the hashing model, with year and arrival."""
    return E.embed_texts(B.prepared(spark, sf_dir), model).select("bibcode", "year", "arrival", "model", "embedding")


def _benchmark_vectors(spark, sf_dir):
    texts = B.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.lower("text").alias("text"))
    return E.embed_texts(texts, B.MODEL).select("query_id", "embedding")


DOC_VECTORS = "prep AS (SELECT bibcode, year, arrival, lower(abstract) AS text FROM docs), " + hashed_vectors(
    "dv", "prep", "bibcode", "text", 64
)
BENCH_VECTORS = "bench AS (SELECT item_id AS query_id, lower(text) AS text FROM benchmark), " + hashed_vectors(
    "bv", "bench", "query_id", "text", 64
)
QUERY_VECTORS = QUERY_TEXT + ", " + hashed_vectors("qv", "q_text", "q", "text", 64)
COS = "(list_sum(list_transform(list_zip(v, p), lambda z: z[1] * z[2])) / sqrt(list_sum(list_transform(v, lambda x: x * x))))"

# ---------------------------------------------------------------- vector maths


@query("l2_normalize", f"""WITH {VECS} SELECT bibcode, round(list_sum(v) / sqrt(list_sum(list_transform(v, lambda x: x * x))), 6)
       AS checksum, 1.0::DOUBLE AS norm FROM vecs""")  # fmt: skip
def l2_normalize(spark, sf_dir):
    unit = B.vectors(spark, sf_dir).select("bibcode", V.unit("embedding").alias("unit"))
    return unit.select("bibcode", _checksum("unit"), _six(V.norm("unit")).alias("norm"))


@query(
    "cosine_pairs",
    f"""WITH {DOCS}, {DOC_VECTORS}, {VECS},
        stored AS (SELECT bibcode, unnest(v) AS y, unnest(range(64)) AS d FROM vecs),
        len AS (SELECT bibcode, sqrt(sum(y * y)) AS len FROM stored GROUP BY 1)
        SELECT bibcode, round(sum(x * y) / any_value(len), 6) AS cosine
        FROM stored JOIN dv USING (bibcode, d) JOIN len USING (bibcode) GROUP BY 1""",
)
def cosine_pairs(spark, sf_dir):
    """Stored vector against the hashing vector of the same record."""
    hashing = _embedded(spark, sf_dir).select("bibcode", F.col("embedding").alias("other"))
    both = B.vectors(spark, sf_dir).select("bibcode", "embedding").join(hashing, "bibcode")
    return both.select("bibcode", _six(V.cosine("embedding", "other")).alias("cosine"))


@query(
    "similarity_matrix",
    f"""WITH {BENCH_VECTORS},
        pairs AS (SELECT a.query_id AS i, b.query_id AS j, round(coalesce(sum(x.x * y.x), 0), 9) AS c
          FROM (SELECT DISTINCT query_id FROM bv) a CROSS JOIN (SELECT DISTINCT query_id FROM bv) b
          LEFT JOIN bv x ON x.query_id = a.query_id LEFT JOIN bv y ON y.query_id = b.query_id AND y.d = x.d GROUP BY 1, 2)
        SELECT i AS query_id, count(*) AS columns,
               string_agg(CAST(CAST(round(c * 1e6) AS BIGINT) AS VARCHAR), ',' ORDER BY j) AS cosines FROM pairs GROUP BY 1""",
)
def similarity_matrix(spark, sf_dir):
    """Cosines among the benchmark texts, one matrix row per text."""
    blocks = S.similarity_matrix(_benchmark_vectors(spark, sf_dir), "query_id")
    cells = F.array_sort(F.flatten(F.collect_list(F.arrays_zip("columns", "cosines")))).alias("cells")
    matrix = blocks.groupBy("query_id").agg(cells)
    matrix = matrix.select("query_id", F.col("cells.columns").alias("columns"), F.col("cells.cosines").alias("cosines"))
    return matrix.select("query_id", F.size("columns").cast("bigint").alias("columns"), _digits("cosines").alias("cosines"))


_HALF = """CASE WHEN x = 0 THEN 0.0
  WHEN abs(x) < 6.103515625e-05 THEN round_even(x * 16777216, 0) / 16777216
  ELSE round_even(x / pow(2, floor(log2(abs(x))) - 10), 0) * pow(2, floor(log2(abs(x))) - 10) END"""


@query(
    "quantize_f16",
    f"""WITH {VECS}, c AS (SELECT bibcode, unnest(v) AS x FROM vecs)
        SELECT bibcode, round(sum({_HALF}), 9) AS checksum, round(max(abs(x - ({_HALF}))), 9) AS max_error
        FROM c GROUP BY 1""",
)
def quantize_f16(spark, sf_dir):
    rows = B.vectors(spark, sf_dir).select("bibcode", "embedding", V.half_precision("embedding").alias("half"))
    errors = F.zip_with("embedding", "half", lambda a, b: F.abs(a.cast("double") - b.cast("double")))
    checksum = F.round(V.component_sums("half")[0], 9)
    return rows.select("bibcode", checksum.alias("checksum"), F.round(F.array_max(errors), 9).alias("max_error"))


@query(
    "storage_footprint",
    f"""WITH {VECS}, c AS (SELECT bibcode, unnest(v) AS x FROM vecs)
        SELECT count(DISTINCT bibcode) AS vectors, count(*) AS components, true AS two_bytes_each,
               round(max(abs(x - ({_HALF}))), 9) AS max_error FROM c""",
)
def storage_footprint(spark, sf_dir):
    """The vectors in a store: bytes in its files, and what the rounding costs."""
    given = B.vectors(spark, sf_dir)
    store = VectorStore(spark, shared_folder(spark, "half"))
    filled = given.withColumns({"text_hash": F.lit(""), "error": F.lit(None).cast("string"), "status": F.lit("ok")})
    # one block, as a year of a real corpus would be: small files are mostly page headers
    filled = filled.withColumns({"batch_no": F.lit(0), "year": F.lit(2000)})
    store.write_vectors(filled, 1)
    size = store.footprint().agg(F.sum("vectors").alias("vectors"), F.sum("components").alias("components"), F.sum("bytes").alias("bytes"))
    both = store.results(1).select("bibcode", F.col("embedding").alias("half")).join(given, "bibcode")
    errors = F.transform(F.arrays_zip("embedding", "half"), lambda p: F.abs(p["embedding"].cast("double") - p["half"].cast("double")))
    worst = both.agg(F.max(F.array_max(errors)).alias("worst"))
    nominal = 2 * F.col("components")
    return size.join(F.broadcast(worst)).select(
        "vectors", "components", F.col("bytes").between(nominal, 1.05 * nominal).alias("two_bytes_each"),
        F.round("worst", 9).alias("max_error"),
    )


@query("wide_vectors", f"WITH {VECS} SELECT bibcode, " + ", ".join(f"embedding[{i + 1}] AS dim_{i}" for i in range(64)) + " FROM vecs")
def wide_vectors(spark, sf_dir):
    return X.wide_rows(B.vectors(spark, sf_dir), 64)


@query(
    "vector_stats",
    f"""WITH {VECS}, c AS (SELECT bibcode, unnest(v) AS x FROM vecs)
        SELECT bibcode, 64::INTEGER AS dim, round(sqrt(sum(x * x)), 6) AS norm, round(avg(x), 6) AS mean,
               round(stddev_pop(x), 6) AS std FROM c GROUP BY 1""",
)
def vector_stats(spark, sf_dir):
    stats = A.vector_stats(B.vectors(spark, sf_dir))
    return stats.select("bibcode", "dim", *[_six(F.col(c)).alias(c) for c in ("norm", "mean", "std")])


@query(
    "corpus_vector_stats",
    f"""WITH {VECS}, c AS (SELECT bibcode, unnest(v) AS x FROM vecs),
        n AS (SELECT avg(norm) AS mean_norm, count(*) AS vectors FROM (SELECT sqrt(sum(x * x)) AS norm FROM c GROUP BY bibcode))
        SELECT any_value(vectors) AS vectors, 64::INTEGER AS dim, round(any_value(mean_norm), 6) AS mean_norm,
               round(stddev_pop(x), 6) AS component_std FROM c, n""",
)
def corpus_vector_stats(spark, sf_dir):
    stats = A.corpus_vector_stats(B.vectors(spark, sf_dir))
    return stats.select("vectors", "dim", _six("mean_norm").alias("mean_norm"), _six("component_std").alias("component_std"))


@query("pca_2d")
def pca_2d(spark, sf_dir):
    return A.pca_projection(B.vectors(spark, sf_dir))


@query(
    "pca_figures",
    f"""WITH {VECS}, c AS (SELECT unnest(v) AS x, unnest(range(64)) AS d FROM vecs)
        SELECT (SELECT count(*) FROM vecs) AS rows, round(sum(s), 6) AS total_variance, true AS centred, true AS uncorrelated,
               true AS first_is_larger, true AS share_fits FROM (SELECT var_samp(x) AS s FROM c GROUP BY d)""",
)
def pca_figures(spark, sf_dir):
    """What the projection must satisfy, with the variance of all components."""
    vectors = B.vectors(spark, sf_dir)
    parts = vectors.select(F.posexplode("embedding").alias("d", "x")).groupBy("d").agg(F.var_samp(F.col("x").cast("double")).alias("s"))
    total = parts.agg(F.sum("s").alias("total"))
    one, two = F.var_samp("pc1"), F.var_samp("pc2")
    figures = A.pca_projection(vectors).agg(
        F.count("*").alias("rows"), one.alias("one"), two.alias("two"), F.corr("pc1", "pc2").alias("corr"),
        F.greatest(F.abs(F.avg("pc1")), F.abs(F.avg("pc2"))).alias("mean"), F.max("explained_variance").alias("share"),
    )
    fits = F.abs(F.col("share") * F.col("total") - F.col("one") - F.col("two")) < 1e-6 * F.col("total")
    return figures.join(F.broadcast(total)).select(
        "rows", _six("total").alias("total_variance"), (F.col("mean") < 1e-6).alias("centred"),
        (F.abs("corr") < 1e-6).alias("uncorrelated"), (F.col("one") >= F.col("two")).alias("first_is_larger"), fits.alias("share_fits"),
    )


# ---------------------------------------------------------------- models


@query(
    "embed_corpus",
    f"""WITH {DOCS}, {DOC_VECTORS}
        SELECT bibcode, year, 64::INTEGER AS dim, string_agg(CAST(CAST(round(coalesce(stored, 0) * 1e6) AS BIGINT) AS VARCHAR), ','
               ORDER BY r.d) AS embedding
        FROM (SELECT bibcode, year, unnest(range(64)) AS d FROM docs) r LEFT JOIN dv USING (bibcode, d) GROUP BY 1, 2""",
)
def embed_corpus(spark, sf_dir):
    return _embedded(spark, sf_dir).select(
        "bibcode", "year", F.size("embedding").alias("dim"), _digits("embedding").alias("embedding")
    )


class _NoBars:
    """A model that cannot read texts with a bar in them."""

    name, dim = "nobars://4", 4

    def embed(self, texts):
        if any("|" in text for text in texts):
            raise ValueError("bar")
        return np.ones((len(texts), self.dim))


@query(
    "embed_failures",
    f"""WITH {DOCS} SELECT bibcode, CASE WHEN contains(abstract, '|') THEN 'failed' ELSE 'ok' END AS status,
        CASE WHEN contains(abstract, '|') THEN 'ValueError: bar' END AS error FROM docs""",
)
def embed_failures(spark, sf_dir):
    """A failing call marks its own texts; here every call has one text."""
    E.register_provider("nobars", lambda name: _NoBars())
    return E.embed_texts(B.prepared(spark, sf_dir), "nobars://4", limit=1).select("bibcode", "status", "error")


_MODELS = [B.MODEL, "hash://32", B.TABLE_MODEL]


def _through_models(spark, sf_dir):
    embedded = E.embed_with_models(B.prepared(spark, sf_dir), _MODELS[:2])
    return embedded.unionByName(B.vectors(spark, sf_dir).select("bibcode", "model", "embedding"))


@query(
    "model_pair_similarity",
    f"""WITH {DOCS}, {DOC_VECTORS}, {VECS},
        stored AS (SELECT bibcode, unnest(v) AS y, unnest(range(64)) AS d FROM vecs),
        c AS (SELECT bibcode, round(sum(x * y), 5) AS cosine FROM stored JOIN dv USING (bibcode, d) GROUP BY 1),
        ids AS (SELECT bibcode FROM docs UNION SELECT bibcode FROM vecs)
        SELECT bibcode, '{_MODELS[0]}' AS model_1, '{_MODELS[1]}' AS model_2, NULL::DOUBLE AS cosine FROM ids
        UNION ALL SELECT bibcode, '{_MODELS[1]}', '{_MODELS[2]}', NULL FROM ids
        UNION ALL SELECT bibcode, '{_MODELS[0]}', '{_MODELS[2]}', cosine FROM ids LEFT JOIN c USING (bibcode)""",
)
def model_pair_similarity(spark, sf_dir):
    pairs = A.model_pair_similarity(_through_models(spark, sf_dir), _MODELS)
    return pairs.withColumn("cosine", F.round("cosine", 5))


@query(
    "model_compare",
    f"""WITH {DOCS}, {DOC_VECTORS}, {hashed_vectors("d32", "prep", "bibcode", "text", 32)}, {VECS},
        c AS (SELECT '64' AS model, bibcode, 64 AS dim, stored AS x FROM dv UNION ALL SELECT '32', bibcode, 32, stored FROM d32
          UNION ALL SELECT 'embeddings', bibcode, 64, unnest(v) FROM vecs),
        s AS (SELECT model, bibcode, any_value(dim) AS dim, sqrt(sum(x * x)) AS norm, sum(x) / any_value(dim) AS mean,
          sqrt(sum(x * x) / any_value(dim) - pow(sum(x) / any_value(dim), 2)) AS std FROM c GROUP BY 1, 2),
        given AS (SELECT * FROM (VALUES ('64', 1), ('32', 2), ('embeddings', 3)) AS m(model, place) WHERE model IN (SELECT model FROM s)),
        units AS (SELECT bibcode, unnest(v) / sqrt(list_sum(list_transform(v, lambda x: x * x))) AS y, unnest(range(64)) AS d
          FROM vecs WHERE list_sum(list_transform(v, lambda x: x * x)) > 0),
        means AS (SELECT bibcode, d, avg(y) AS y FROM units GROUP BY 1, 2),
        alike AS (SELECT '64' AS model, 'embeddings' AS other_model, sum(x * y) AS cosine
          FROM dv JOIN means USING (bibcode, d) GROUP BY bibcode)
        SELECT model, NULL::VARCHAR AS other_model, count(*) AS texts, max(dim)::INTEGER AS dim, round(avg(norm), 6) AS mean_norm,
               round(avg(mean), 6) AS mean_component, round(avg(std), 6) AS mean_std, NULL::DOUBLE AS mean_cosine FROM s GROUP BY 1
        UNION ALL SELECT a.model, b.model, count(cosine), NULL, NULL, NULL, NULL, round(avg(cosine), 6)
        FROM given a JOIN given b ON a.place < b.place LEFT JOIN alike ON alike.model = a.model AND alike.other_model = b.model
        GROUP BY a.model, b.model""",
)
def model_compare(spark, sf_dir):
    """Figures of each model, then each pair of models with the mean cosine of what they give the same text."""
    compared = A.model_comparison(_through_models(spark, sf_dir), _MODELS)
    figures = [_six(F.col(c)).alias(c) for c in ("mean_norm", "mean_component", "mean_std", "mean_cosine")]
    return compared.select("model", "other_model", "texts", "dim", *figures)


# ---------------------------------------------------------------- catalog


@query("load_embeddings", f"WITH {VECS} SELECT bibcode, year, model, 64::INTEGER AS dim, round(list_sum(v), 6) AS checksum FROM vecs")
def load_embeddings(spark, sf_dir):
    return B.vectors(spark, sf_dir).select("bibcode", "year", "model", F.size("embedding").alias("dim"), _checksum())


@query("build_manifest", f'WITH {VECS} SELECT year, model, 64::INTEGER AS dim, count(*) AS "count" FROM vecs GROUP BY year, model')
def build_manifest(spark, sf_dir):
    return C.manifests(B.vectors(spark, sf_dir))


@query(
    "assign_row_ids",
    f"WITH {DOCS} SELECT bibcode, year, row_number() OVER (PARTITION BY year ORDER BY arrival) - 1 AS row_id FROM docs",
)
def assign_row_ids(spark, sf_dir):
    rows = B.prepared(spark, sf_dir).withColumn("model", F.lit(B.MODEL))
    return C.assign_row_ids(rows).select("bibcode", "year", "row_id")


@query(
    "append_embeddings",
    f"""WITH {DOCS}, {VECS}, old AS (SELECT year, count(*) AS n FROM vecs GROUP BY year)
        SELECT bibcode, year, coalesce(n, 0)::BIGINT + row_number() OVER (PARTITION BY year ORDER BY arrival) - 1 AS row_id
        FROM docs LEFT JOIN old USING (year)""",
)
def append_embeddings(spark, sf_dir):
    """Documents appended to the blocks of the stored vectors: their row ids go on."""
    added = B.prepared(spark, sf_dir).withColumn("model", F.lit(B.TABLE_MODEL))
    entries = C.catalog_entries(added, "f", "p")
    return C.append_entries(entries, C.manifests(B.vectors(spark, sf_dir))).select("bibcode", "year", "row_id")


@query(
    "upsert_index",
    f"WITH {CATALOG} SELECT bibcode, model, year, row_id, vector_file, CAST(version AS BIGINT) AS version, replaced FROM catalog",
)
def upsert_index(spark, sf_dir):
    merged = C.upsert(B.catalog_log(spark, sf_dir))
    return merged.select("bibcode", "model", "year", "row_id", "vector_file", "version", "replaced")


@query("merge_indexes", f"WITH {CATALOG} SELECT bibcode, model, year, row_id, replaced FROM catalog")
def merge_indexes(spark, sf_dir):
    log = B.catalog_log(spark, sf_dir)
    merged = C.merge_catalogs([log.where("version = 1"), log.where("version = 2")])
    return merged.select("bibcode", "model", "year", "row_id", "replaced")


@query("remove_year_model", f"WITH {CATALOG} SELECT bibcode, year, model FROM catalog WHERE year <> 2013")
def remove_year_model(spark, sf_dir):
    left = C.remove_year_model(C.upsert(B.catalog_log(spark, sf_dir)), 2013, B.TABLE_MODEL)
    return left.select("bibcode", "year", "model")


@query(
    "index_stats",
    f"""WITH {CATALOG} SELECT count(*) AS total_embeddings, count(DISTINCT bibcode) AS unique_bibcodes,
        count(DISTINCT year || model) AS total_manifests FROM log""",
)
def index_stats(spark, sf_dir):
    return C.index_stats(B.catalog_log(spark, sf_dir))


@query(
    "year_model_counts",
    f"""WITH {CATALOG} SELECT year, model, year || '_' || model AS label, count(*) AS embeddings FROM catalog GROUP BY year, model""",
)
def year_model_counts(spark, sf_dir):
    return C.year_model_counts(C.upsert(B.catalog_log(spark, sf_dir)))


@query("list_years", f"WITH {CATALOG} SELECT DISTINCT year FROM catalog")
def list_years(spark, sf_dir):
    return C.list_years(C.upsert(B.catalog_log(spark, sf_dir)))


@query("list_models", f"WITH {CATALOG} SELECT DISTINCT model FROM catalog")
def list_models(spark, sf_dir):
    return C.list_models(C.upsert(B.catalog_log(spark, sf_dir)))


@query(
    "lookup_bibcode",
    f"""WITH {CATALOG} SELECT bibcode, year, row_id, model, vector_file FROM catalog
        WHERE bibcode IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
)
def lookup_bibcode(spark, sf_dir):
    """Catalog entries of all labelled records."""
    wanted = B.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("bibcode"))
    return C.lookup_records(C.upsert(B.catalog_log(spark, sf_dir)), wanted, B.TABLE_MODEL)


@query(
    "get_embedding",
    f"""WITH {CATALOG} SELECT c.bibcode, c.year, c.row_id, round(list_sum(v), 6) AS checksum
        FROM catalog c JOIN vecs USING (bibcode, model) WHERE c.bibcode IN (SELECT bibcode FROM docs)""",
)
def get_embedding(spark, sf_dir):
    """Vectors of all documents that have one."""
    catalog = C.upsert(B.catalog_log(spark, sf_dir))
    wanted = B.records(spark, sf_dir).select("bibcode")
    found = C.embeddings_of(catalog, B.vectors(spark, sf_dir), wanted, B.TABLE_MODEL)
    return found.select("bibcode", "year", "row_id", _checksum())


@query("sample_entries", "SELECT 20::BIGINT AS entries, 20::BIGINT AS keys, 20::BIGINT AS known")
def sample_entries(spark, sf_dir):
    """What any sample must be: so many different entries, all of the catalog."""
    catalog = C.upsert(B.catalog_log(spark, sf_dir))
    drawn = C.sample_entries(catalog, 20, seed=7).select("bibcode", "model", "year", "row_id")
    known = catalog.select("bibcode", "model", "year", "row_id", F.lit(1).alias("known"))
    joined = drawn.join(known, ["bibcode", "model", "year", "row_id"], "left")
    return joined.agg(
        F.count("*").alias("entries"), F.count_distinct("bibcode", "model").alias("keys"), F.count("known").alias("known")
    )


# ---------------------------------------------------------------- search

_PROBED = f"""{VECS}, {QUERY_VECTOR}, scored AS (SELECT bibcode, year, round({COS}, 9) AS score FROM vecs, probe)"""


@query(
    "topk_exact",
    f"""WITH {_PROBED} SELECT CAST(row_number() OVER (ORDER BY score DESC, bibcode) AS INTEGER) AS rank, bibcode,
        round(score, 6) AS score FROM scored ORDER BY score DESC, bibcode LIMIT 10""",
)
def topk_exact(spark, sf_dir):
    hits = S.topk(B.vectors(spark, sf_dir), B.query_vector(), 10)
    return hits.withColumn("score", _six("score"))


@query(
    "topk_l2",
    f"""WITH {_PROBED}, near AS (SELECT bibcode, sqrt(2 - 2 * score) AS distance FROM scored)
        SELECT CAST(row_number() OVER (ORDER BY distance, bibcode) AS INTEGER) AS rank, bibcode,
        round(distance, 6) AS score FROM near ORDER BY distance, bibcode LIMIT 10""",
)
def topk_l2(spark, sf_dir):
    hits = S.topk(B.vectors(spark, sf_dir), B.query_vector(), 10, metric="l2")
    return hits.withColumn("score", _six("score"))


@query(
    "topk_all_years",
    f"""WITH {_PROBED} SELECT year, CAST(row_number() OVER (PARTITION BY year ORDER BY score DESC, bibcode) AS INTEGER) AS year_rank,
        CAST(row_number() OVER (ORDER BY score DESC, bibcode) AS INTEGER) AS rank, bibcode,
        round(score, 6) AS score FROM scored QUALIFY rank <= 20""",
)
def topk_all_years(spark, sf_dir):
    """Best of every year, merged: the overall best are among them."""
    yearly = S.topk_per_year(B.vectors(spark, sf_dir), B.query_vector(), 20).withColumnRenamed("rank", "year_rank")
    best = yearly.orderBy(F.desc("score"), "bibcode").limit(20)
    rank = F.row_number().over(W.orderBy(F.desc("score"), "bibcode"))
    return best.select("year", "year_rank", rank.alias("rank"), "bibcode", _six("score").alias("score"))


@query(
    "search_similar",
    f"""WITH {DOCS}, {DOC_VECTORS}, {QUERY_VECTORS},
        scored AS (SELECT bibcode, round(coalesce(sum(dv.x * qv.x), 0), 9) AS score FROM dv LEFT JOIN qv USING (d) GROUP BY 1)
        SELECT year, CAST(row_number() OVER (PARTITION BY year ORDER BY score DESC, bibcode) AS INTEGER) AS rank, bibcode,
               round(score, 6) AS score FROM scored JOIN docs USING (bibcode) QUALIFY rank <= 10""",
)
def search_similar(spark, sf_dir):
    """A text searched in the stored vectors of every year."""
    hits = S.topk_per_year(B.document_vectors(spark, sf_dir), E.embed_one(B.QUERY, B.MODEL), 10)
    return hits.select("year", "rank", "bibcode", _six("score").alias("score"))


_KNN = f"""{BENCH_VECTORS},
  scored AS (SELECT query_id, bibcode, round(sum(bv.x * dv.x), 9) AS score FROM bv JOIN dv USING (d) GROUP BY 1, 2),
  ranked AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, bibcode) AS INTEGER) AS rank,
    bibcode, round(score, 6) AS score FROM scored QUALIFY rank <= 10)
  SELECT * FROM ranked"""


@query("knn_join", f"WITH {DOCS}, {DOC_VECTORS}, {_KNN}")
def knn_join(spark, sf_dir):
    """The ten nearest documents of every benchmark text."""
    hits = S.knn_join(B.document_vectors(spark, sf_dir), _benchmark_vectors(spark, sf_dir), 10)
    return hits.withColumn("score", _six("score"))


@query(
    "unique_neighbours",
    f"""WITH {HASHED}, prep AS (SELECT bibcode, text FROM hashed SEMI JOIN firsts USING (arrival)),
        {hashed_vectors("dv", "prep", "bibcode", "text", 64)}, {_KNN}""",
)
def unique_neighbours(spark, sf_dir):
    hits = neighbours_of_unique_records(spark, sf_dir)
    return hits.withColumn("score", _six("score"))


@query("knn_join_cells", f"WITH {DOCS}, {DOC_VECTORS}, {_KNN}")
def knn_join_cells(spark, sf_dir):
    """The same join the way it runs for a query table of any size."""
    corpus, queries = B.document_vectors(spark, sf_dir), _benchmark_vectors(spark, sf_dir)
    hits = S.knn_join(corpus, queries, 10, force_passes=True)
    return hits.withColumn("score", _six("score"))


CELLS, BITS, PROBES = 16, 4, 6


@query("topk_ivf")
def topk_ivf(spark, sf_dir):
    return _ivf_hits(spark, sf_dir, B.document_vectors(spark, sf_dir))


def _ivf_hits(spark, sf_dir, corpus):
    centroids = N.Centroids.fit(corpus, CELLS, seed=1, max_iter=5)
    filed = N.assign_cells(corpus, centroids)
    return N.approximate_knn(filed, centroids, _benchmark_vectors(spark, sf_dir), 10, PROBES)


@query("topk_lsh")
def topk_lsh(spark, sf_dir):
    planes = N.Hyperplanes(64, BITS, seed=1)
    filed = N.assign_cells(B.document_vectors(spark, sf_dir), planes)
    return N.approximate_knn(filed, planes, _benchmark_vectors(spark, sf_dir), 10, PROBES)


@query("topk_lsh_all_cells", f"WITH {DOCS}, {DOC_VECTORS}, {_KNN}")
def topk_lsh_all_cells(spark, sf_dir):
    """With every cell probed the approximate search is exact."""
    planes = N.Hyperplanes(64, BITS, seed=1)
    filed = N.assign_cells(B.document_vectors(spark, sf_dir), planes)
    hits = N.approximate_knn(filed, planes, _benchmark_vectors(spark, sf_dir), 10, 1 << BITS)
    return hits.withColumn("score", _six("score"))


@query("topk_lsh_routed", f"WITH {DOCS}, {DOC_VECTORS}, {_KNN}")
def topk_lsh_routed(spark, sf_dir):
    """Queries routed to their cells, the way it runs for a query table of any size; all cells probed."""
    planes = N.Hyperplanes(64, BITS, seed=1)
    filed = N.assign_cells(B.document_vectors(spark, sf_dir), planes)
    hits = N.approximate_knn(filed, planes, _benchmark_vectors(spark, sf_dir), 10, 1 << BITS, force_routes=True)
    return hits.withColumn("score", _six("score"))


@query("ann_recall", "SELECT 10 * count(*) AS expected, true AS enough, true AS share_fits FROM benchmark")
def ann_recall(spark, sf_dir):
    """Six of sixteen cells find at least three fifths of the exact hits."""
    corpus = B.document_vectors(spark, sf_dir)
    exact = S.knn_join(corpus, _benchmark_vectors(spark, sf_dir), 10)
    found = N.recall(_ivf_hits(spark, sf_dir, corpus), exact)
    fits = F.abs(F.col("recall") * F.col("expected") - F.col("found")) < 1e-9
    return found.select("expected", (F.col("recall") >= 0.6).alias("enough"), fits.alias("share_fits"))


_SOUND = """SELECT 10 * count(*) AS hits, 10 * count(*) AS places, 10 * count(*) AS same_score FROM benchmark"""


def _sound(spark, sf_dir, hits):
    """What approximate hits must be: ten places a query, and each score the one the vectors have."""
    corpus = B.document_vectors(spark, sf_dir).select("bibcode", F.col("embedding").alias("one"))
    asked = _benchmark_vectors(spark, sf_dir).select("query_id", F.col("embedding").alias("other"))
    joined = hits.join(corpus, "bibcode", "left").join(asked, "query_id", "left")
    same = F.abs(V.cosine("one", "other") - F.col("score")) < 1e-6
    return joined.agg(
        F.count("*").alias("hits"), F.count_distinct("query_id", "rank").alias("places"), F.count_if(same).alias("same_score")
    )


@query("ivf_hits_sound", _SOUND)
def ivf_hits_sound(spark, sf_dir):
    return _sound(spark, sf_dir, topk_ivf(spark, sf_dir))


@query("lsh_hits_sound", _SOUND)
def lsh_hits_sound(spark, sf_dir):
    return _sound(spark, sf_dir, topk_lsh(spark, sf_dir))


# ---------------------------------------------------------------- keyword and vector


@query(
    "bm25_scan",
    f"""WITH {DOCS}, {bm25("kw", "docs", "bibcode", "abstract")}
        SELECT CAST(row_number() OVER (ORDER BY keyword DESC, bibcode) AS INTEGER) AS rank, bibcode,
        round(keyword, 6) AS score FROM kw WHERE keyword > 0 ORDER BY keyword DESC, bibcode LIMIT 20""",
)
def bm25_scan(spark, sf_dir):
    """Texts that are not indexed, scored in the row."""
    hits = H.bm25_topk(B.records(spark, sf_dir), B.QUERY, 20, ["abstract"])
    return hits.withColumn("score", _six("score"))


def _query_vectors():
    return {"embedding": E.embed_one(B.QUERY, B.MODEL)}


_BM25 = bm25("kw", "docs", "bibcode", "abstract")
_SEM = f"""{QUERY_VECTORS}, sem AS (
  SELECT bibcode, round(coalesce(sum(dv.x * qv.x), 0), 9) + 1 AS semantic FROM dv LEFT JOIN qv USING (d) GROUP BY 1)"""
_BOTH = f"""{DOCS}, {DOC_VECTORS}, {_BM25}, {_SEM},
paired AS (SELECT bibcode, coalesce(semantic, 0) AS semantic, coalesce(keyword, 0) AS keyword
  FROM sem FULL JOIN kw USING (bibcode))"""


@query(
    "bm25_topk",
    f"""WITH {DOCS}, {_BM25} SELECT CAST(row_number() OVER (ORDER BY keyword DESC, bibcode) AS INTEGER) AS rank, bibcode,
        round(keyword, 6) AS score FROM kw WHERE keyword > 0 ORDER BY keyword DESC, bibcode LIMIT 20""",
)
def bm25_topk(spark, sf_dir):
    hits = B.term_index(spark, sf_dir).search(B.QUERY, 20, ["abstract"])
    return hits.withColumn("score", _six("score"))


@query(
    "hybrid_topk",
    f"""WITH {_BOTH}, fused AS (SELECT *, round(0.7::DOUBLE * semantic + 0.3::DOUBLE * keyword, 9) AS score FROM paired)
        SELECT CAST(row_number() OVER (ORDER BY score DESC, bibcode) AS INTEGER) AS rank, bibcode, round(semantic, 6) AS semantic,
        round(keyword, 6) AS keyword, round(score, 6) AS score FROM fused ORDER BY score DESC, bibcode LIMIT 20""",
)
def hybrid_topk(spark, sf_dir):
    docs, index = B.document_vectors(spark, sf_dir), B.term_index(spark, sf_dir)
    hits = H.hybrid_topk(docs, B.QUERY, _query_vectors(), k=20, keyword_fields=["abstract"], index=index)
    return hits.select("rank", "bibcode", *[_six(c).alias(c) for c in ("semantic", "keyword", "score")])


@query(
    "hybrid_fields",
    f"""WITH {DOCS}, {VECS}, {QUERY_VECTOR}, {DOC_VECTORS}, {_SEM}, {bm25("kw1", "docs", "bibcode", "abstract", "src1 the galaxies")},
        {bm25("kw2", "docs", "bibcode", "title", "src1 the galaxies")},
        st AS (SELECT bibcode, round({COS}, 9) + 1 AS stored FROM vecs, probe),
        fused AS (SELECT d.bibcode, coalesce(semantic, 0) + coalesce(stored, 0) AS semantic,
          coalesce(kw1.keyword, 0) + coalesce(kw2.keyword, 0) AS keyword
          FROM docs d LEFT JOIN sem USING (bibcode) LEFT JOIN st USING (bibcode)
          LEFT JOIN kw1 USING (bibcode) LEFT JOIN kw2 USING (bibcode))
        SELECT bibcode, round(semantic, 5) AS semantic, round(keyword, 5) AS keyword,
               round(0.5 * semantic + 0.5 * keyword, 5) AS score FROM fused ORDER BY round(0.5 * semantic + 0.5 * keyword, 9) DESC, bibcode LIMIT 20""",
)
def hybrid_fields(spark, sf_dir):
    """Two vector columns and two text fields, each side summed."""
    stored = B.vectors(spark, sf_dir).select("bibcode", F.col("embedding").alias("stored"))
    docs = B.document_vectors(spark, sf_dir).join(stored, "bibcode", "left")
    probes, index = {**_query_vectors(), "stored": B.query_vector()}, B.term_index(spark, sf_dir)
    hits = H.hybrid_topk(docs, "src1 the galaxies", probes, (1.0, 1.0), 20, ["abstract", "title"], index=index)
    return hits.select("bibcode", *[F.round(c, 5).alias(c) for c in ("semantic", "keyword", "score")])


@query(
    "hybrid_weight_sweep",
    f"""WITH {_BOTH}, grid(kind, ws, wk) AS (VALUES ('semantic', 0.7::DOUBLE, 0.3::DOUBLE), ('keyword', 0.3, 0.7), ('balanced', 0.5, 0.5)),
        fused AS (SELECT kind, bibcode, round(ws * semantic + wk * keyword, 9) AS score FROM paired, grid)
        SELECT kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY score DESC, bibcode) AS INTEGER) AS rank, bibcode,
               round(score, 6) AS score FROM fused QUALIFY rank <= 10""",
)
def hybrid_weight_sweep(spark, sf_dir):
    docs, index = B.document_vectors(spark, sf_dir), B.term_index(spark, sf_dir)
    hits = H.weight_sweep(docs, B.QUERY, _query_vectors(), keyword_fields=["abstract"], index=index)
    return hits.select("kind", "rank", "bibcode", _six("score").alias("score"))


# ---------------------------------------------------------------- exports


@query(
    "assign_chunks",
    f"""WITH {DOCS}, n AS (SELECT bibcode, row_number() OVER (ORDER BY arrival) - 1 AS p FROM docs)
        SELECT bibcode, p // 250 AS chunk, CAST(p % 250 AS INTEGER) AS index_in_chunk FROM n""",
)
def assign_chunks(spark, sf_dir):
    return X.assign_chunks(B.prepared(spark, sf_dir), 250).select("bibcode", "chunk", "index_in_chunk")


@query(
    "chunk_metadata",
    f"""WITH {VECS}, n AS (SELECT bibcode, row_number() OVER (ORDER BY arrival) - 1 AS p FROM vecs)
        SELECT p // 250 AS chunk, count(*)::BIGINT AS papers_in_chunk, arg_min(bibcode, p) AS first_bibcode,
               arg_max(bibcode, p) AS last_bibcode, 64::INTEGER AS embedding_dimension,
               string_agg(bibcode || ':' || (p % 250), ',' ORDER BY bibcode) AS places FROM n GROUP BY 1""",
)
def chunk_metadata(spark, sf_dir):
    chunks = X.chunk_metadata(X.assign_chunks(B.vectors(spark, sf_dir), 250))
    pairs = F.transform(F.array_sort(F.map_entries("bibcode_to_index")), lambda e: F.concat_ws(":", e["key"], e["value"]))
    return chunks.withColumn("places", F.array_join(pairs, ",")).drop("bibcode_to_index")


@query(
    "solr_docs",
    f"""WITH {VECS} SELECT bibcode, '{B.TABLE_MODEL}' AS embedding_model, 64::INTEGER AS embedding_dim, 'title,abstract' AS fields_used,
        round(list_sum(v), 6) AS checksum FROM vecs""",
)
def solr_docs(spark, sf_dir):
    docs = X.search_documents(B.vectors(spark, sf_dir), B.TABLE_MODEL, ["title", "abstract"])
    fields = F.array_join("fields_used", ",").alias("fields_used")
    return docs.select("bibcode", "embedding_model", "embedding_dim", fields, _checksum("embedding_vector"))
