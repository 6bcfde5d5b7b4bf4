"""The flagship query: from raw records to ranked neighbours in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.operators import dedup as D
from vectorloom.operators import embed as E
from vectorloom.operators import search as S
from vectorloom.plans import tables as B


def neighbours_of_unique_records(spark: SparkSession, sf_dir: str, k: int = 10) -> DataFrame:
    """Unique prepared documents, embedded, and the ``k`` nearest of each benchmark text."""
    unique = D.unique_rows(B.hashed(spark, sf_dir)).select("bibcode", "text")
    corpus = E.embed_texts(unique, B.MODEL).select("bibcode", "embedding")
    texts = B.table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), F.lower("text").alias("text"))
    queries = E.embed_texts(texts, B.MODEL).select("query_id", "embedding")
    return S.knn_join(corpus, queries, k)
