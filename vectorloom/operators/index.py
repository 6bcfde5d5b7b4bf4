"""Stored search indexes behind one interface.

An index is built from stored vectors, lives in a folder and answers query vectors.
Any class with ``build`` and ``search`` can stand in for the ones here.
"""

from __future__ import annotations

from typing import Protocol

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.functions import vectors as V
from vectorloom.operators import ann as N
from vectorloom.operators import search as S


class SearchIndex(Protocol):
    def build(self, vectors: DataFrame) -> None:
        """Store the index of ``bibcode, embedding`` rows, replacing an earlier one."""

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        """``query_id, rank, bibcode, score`` for ``query_id, embedding`` rows."""


class FlatIndex:
    """Unit vectors as they are: exact search."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def build(self, vectors: DataFrame) -> None:
        unit = V.unit("embedding").cast("array<float>").alias("embedding")
        vectors.select("bibcode", unit).write.mode("overwrite").parquet(f"{self.path}/vectors")

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        return S.knn_join(self.spark.read.parquet(f"{self.path}/vectors"), queries, k)


class CellIndex:
    """Vectors partitioned by cell: a search reads the cells nearest to its queries."""

    def __init__(self, spark: SparkSession, path: str, probes: int = 8):
        self.spark, self.path, self.probes = spark, path, probes

    def fit(self, vectors: DataFrame) -> N.Quantizer:
        raise NotImplementedError

    def build(self, vectors: DataFrame) -> None:
        quantizer = self.fit(vectors)
        kind, matrix = N.quantizer_state(quantizer)
        rows = [(kind, i, [float(x) for x in row]) for i, row in enumerate(matrix)]
        state = self.spark.createDataFrame(rows, "kind string, position int, row array<double>")
        unit = vectors.select("bibcode", V.unit("embedding").cast("array<float>").alias("embedding"))
        N.write_index(N.assign_cells(unit, quantizer), f"{self.path}/vectors")
        state.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/cells")

    def search(self, queries: DataFrame, k: int = 10) -> DataFrame:
        # one row per cell or plane: bounded by the settings of the build
        state = self.spark.read.parquet(f"{self.path}/cells").orderBy("position").collect()
        quantizer = N.quantizer_from(state[0]["kind"], np.array([r["row"] for r in state]))
        filed = N.read_index(self.spark, f"{self.path}/vectors")
        return N.approximate_knn(filed, quantizer, queries, k, self.probes)


class InvertedLists(CellIndex):
    """Cells around k-means centres."""

    def __init__(self, spark: SparkSession, path: str, cells: int = 256, probes: int = 8, seed: int = 0):
        super().__init__(spark, path, probes)
        self.cells, self.seed = cells, seed

    def fit(self, vectors: DataFrame) -> N.Quantizer:
        return N.Centroids.fit(vectors, self.cells, self.seed)


class HashedBuckets(CellIndex):
    """Cells by the sides of random planes; stands where a graph index would."""

    def __init__(self, spark: SparkSession, path: str, bits: int = 8, probes: int = 16, seed: int = 0):
        super().__init__(spark, path, probes)
        self.bits, self.seed = bits, seed

    def fit(self, vectors: DataFrame) -> N.Quantizer:
        dim = vectors.where(F.size("embedding") > 0).select(F.size("embedding")).first()[0]
        return N.Hyperplanes(dim, self.bits, self.seed)


# The index types a user may ask for.
INDEX_TYPES = {"flat": FlatIndex, "ivf": InvertedLists, "hnsw": HashedBuckets}


def open_index(spark: SparkSession, path: str, index_type: str = "flat", **options) -> SearchIndex:
    if index_type not in INDEX_TYPES:
        raise ValueError(f"unsupported index type: {index_type}")
    return INDEX_TYPES[index_type](spark, path, **options)
