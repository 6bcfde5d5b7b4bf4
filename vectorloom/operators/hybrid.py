"""Keyword (BM25), vector and combined ranking for one query over a whole corpus.

With a stored term index the keyword scores come from the postings of the query's terms
and are joined to the vector scores by key. Texts that are not indexed are scored in
the row they belong to; the corpus figures then come from one aggregate over the same
table, used as a scalar subquery.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.functions import text as X
from vectorloom.functions import vectors as V
from vectorloom.operators.positions import top_per_group
from vectorloom.session import spread_small

if TYPE_CHECKING:
    from vectorloom.operators.term_index import TermIndex

K1, B = 1.2, 0.75
DEFAULT_WEIGHTS = (0.7, 0.3)  # semantic, keyword


def query_terms(query: str) -> list[str]:
    """Distinct words of the query, split like the documents."""
    return [t for t in dict.fromkeys(re.split(r"[\W_]+", query.lower())) if t]


def normalise_weights(semantic: float, keyword: float) -> tuple[float, float]:
    total = semantic + keyword
    return (semantic / total, keyword / total) if total > 0 else (semantic, keyword)


def weight_label(semantic: float, keyword: float) -> str:
    return "semantic" if semantic > keyword else "keyword" if keyword > semantic else "balanced"


def _add_up(values: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for value in values:
        total = total + value
    return total


def with_bm25(
    docs: DataFrame,
    query: str,
    fields: Sequence[str] = ("text",),
    out: str = "keyword",
    corpus: DataFrame | None = None,
) -> DataFrame:
    """Add the BM25 score of ``query``, summed over the fields; 0 where no term occurs.

    Document counts come from ``corpus``, by default from ``docs``. Give the bare text
    table where ``docs`` is costly to compute: the counts are a pass of their own.
    """
    docs = spread_small(docs)
    corpus = docs if corpus is None else spread_small(corpus)
    terms = query_terms(query)
    if not terms:
        return docs.withColumn(out, F.lit(0.0))
    # each step is its own projection: words, then counts and corpus figures, then scores
    words = [_words_of(field).alias(f"_words{i}") for i, field in enumerate(fields)]
    counted, helpers = docs.select("*", *words), []
    for i, _ in enumerate(fields):
        found = F.col(f"_words{i}")
        holding = [F.count_if(F.array_contains(found, t)).alias(f"df{j}") for j, t in enumerate(terms)]
        figures = F.struct(F.count("*").alias("n"), F.avg(F.size(found)).alias("mean"), *holding)
        columns = {f"_corpus{i}": corpus.select(*words).agg(figures.alias("figures")).scalar(), f"_size{i}": F.size(found)}
        for j, term in enumerate(terms):
            columns[f"_tf{i}_{j}"] = F.size(found) - F.size(F.array_remove(found, term))
        counted = counted.withColumns(columns)
        helpers += [f"_words{i}", *columns]
    scores = [_term_score(i, j) for i, _ in enumerate(fields) for j, _ in enumerate(terms)]
    return counted.withColumn(out, F.round(_add_up(scores), V.SCORE_DECIMALS)).drop(*helpers)


def _words_of(field: str) -> Column:
    return F.coalesce(X.words(field), F.array().cast("array<string>"))


def _term_score(field: int, term: int) -> Column:
    """BM25 of one term in one field; 0 where the term does not occur."""
    corpus, tf = F.col(f"_corpus{field}"), F.col(f"_tf{field}_{term}")
    df = corpus.getField(f"df{term}")
    idf = F.log1p((corpus.getField("n") - df + 0.5) / (df + 0.5))
    share = F.coalesce(F.col(f"_size{field}") / F.nullif(corpus.getField("mean"), F.lit(0.0)), F.lit(1.0))
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * share))


def ranked(rows: DataFrame, k: int, key: str) -> DataFrame:
    """The ``k`` best rows with a score above 0, numbered; ties go to the lower key."""
    best = rows.orderBy(F.desc("score"), F.asc(key)).limit(k)
    numbered = best.withColumn("rank", F.row_number().over(W.orderBy(F.desc("score"), F.asc(key))))
    # rows that match nothing come last; filtered before the limit, the predicate would
    # be pushed below the score and every score computed twice
    return numbered.where(F.col("score") > 0)


def bm25_topk(
    docs: DataFrame, query: str, k: int = 10, fields: Sequence[str] = ("text",), key: str = "bibcode"
) -> DataFrame:
    scored = with_bm25(docs, query, fields, "score").select(key, "score")
    return ranked(scored, k, key).select("rank", key, "score")


def with_scores(
    docs: DataFrame,
    query: str,
    query_vectors: Mapping[str, Sequence[float]],
    keyword_fields: Sequence[str] = ("text",),
    corpus: DataFrame | None = None,
    index: TermIndex | None = None,
    key: str = "bibcode",
) -> DataFrame:
    """Add ``semantic`` (cosine + 1, summed over vector columns) and ``keyword``.

    A row without a vector has semantic score 0, one without a term of the query keyword
    score 0. With ``index`` the texts aren't read; ``docs`` then keep only key and scores.
    """
    cosines = [
        F.coalesce(V.score_against(list(vector))(column) + 1.0, F.lit(0.0)) for column, vector in query_vectors.items()
    ]
    semantic = _add_up(cosines)
    if index is None:
        return with_bm25(docs, query, keyword_fields, corpus=corpus).withColumn("semantic", semantic)
    keyword = index.scores(query, keyword_fields).withColumnRenamed(index.key, key)
    scored = docs.select(key, semantic.alias("semantic")).join(keyword, key, "left")
    return scored.withColumn("keyword", F.coalesce("keyword", F.lit(0.0)))


def hybrid_topk(
    docs: DataFrame,
    query: str,
    query_vectors: Mapping[str, Sequence[float]],
    weights: tuple[float, float] = DEFAULT_WEIGHTS,
    k: int = 10,
    keyword_fields: Sequence[str] = ("text",),
    key: str = "bibcode",
    corpus: DataFrame | None = None,
    index: TermIndex | None = None,
) -> DataFrame:
    """The ``k`` best rows by ``w_s * semantic + w_k * keyword``."""
    semantic, keyword = normalise_weights(*weights)
    scored = with_scores(docs, query, query_vectors, keyword_fields, corpus, index, key)
    fused = F.round(semantic * F.col("semantic") + keyword * F.col("keyword"), V.SCORE_DECIMALS)
    rows = scored.select(key, "semantic", "keyword", fused.alias("score"))
    return ranked(rows, k, key).select("rank", key, "semantic", "keyword", "score")


def weight_sweep(
    docs: DataFrame,
    query: str,
    query_vectors: Mapping[str, Sequence[float]],
    grid: Sequence[tuple[float, float]] = ((0.7, 0.3), (0.3, 0.7), (0.5, 0.5)),
    k: int = 10,
    keyword_fields: Sequence[str] = ("text",),
    key: str = "bibcode",
    corpus: DataFrame | None = None,
    index: TermIndex | None = None,
) -> DataFrame:
    """``hybrid_topk`` for several weights in one pass over the corpus."""
    settings = []
    for semantic, keyword in (normalise_weights(*pair) for pair in grid):
        settings.append(
            F.struct(
                F.lit(weight_label(semantic, keyword)).alias("kind"),
                F.lit(float(semantic)).alias("semantic_weight"),
                F.lit(float(keyword)).alias("keyword_weight"),
            )
        )
    scored = with_scores(docs, query, query_vectors, keyword_fields, corpus, index, key)
    rows = scored.select(key, "semantic", "keyword", F.inline(F.array(*settings)))
    fused = F.col("semantic_weight") * F.col("semantic") + F.col("keyword_weight") * F.col("keyword")
    rows = rows.withColumn("score", F.round(fused, V.SCORE_DECIMALS))
    groups = ["kind", "semantic_weight", "keyword_weight"]
    best = top_per_group(rows, groups, [F.desc("score"), F.asc(key)], k)
    return best.where(F.col("score") > 0).select(*groups, "rank", key, "score")
