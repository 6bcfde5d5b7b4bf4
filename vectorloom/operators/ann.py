"""Approximate search: vectors are filed under cells and a query looks into a few.

Two ways to choose the cells: the nearest k-means centroid (inverted lists), or the
sign pattern of a few random projections (locality-sensitive hashing with multi-probe).
Both store the unit vectors partitioned by cell, so a search prunes to the probed
cells. A cell is only a folder: one that holds most vectors is many files and tasks.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.functions import vectors as V
from vectorloom.operators import search as S
from vectorloom.operators.passes import nearest_in_cells
from vectorloom.operators.positions import top_per_group

# cells are 64-bit numbers
MAX_BITS = 62


class Centroids:
    """Cells around k-means centres of the unit vectors."""

    def __init__(self, centres: np.ndarray):
        self.centres = V.unit_rows(np.asarray(centres, dtype=np.float64))

    @classmethod
    def fit(
        cls, vectors: DataFrame, cells: int, seed: int = 0, max_iter: int = 10, points_per_cell: int | None = None
    ) -> Centroids:
        """Centres of all vectors; with ``points_per_cell`` of a sample of about so many for each cell.

        The centres only decide where a vector is filed: every vector is filed, and all
        of them are found when every cell is probed.
        """
        points = vectors
        if points_per_cell is not None:
            share = cells * points_per_cell / max(vectors.count(), 1)
            points = vectors.sample(share, seed) if share < 1 else vectors
        unit = points.select(V.unit("embedding").alias("unit")).where("unit IS NOT NULL")
        data = unit.select(array_to_vector("unit").alias("features"))
        model = KMeans(k=cells, seed=seed, maxIter=max_iter).fit(data)
        return cls(np.array(model.clusterCenters()))

    def cell_of(self, matrix: np.ndarray) -> np.ndarray:
        scores = np.nan_to_num(V.unit_rows(matrix) @ self.centres.T, nan=-np.inf)
        return scores.argmax(axis=1)

    def probes(self, matrix: np.ndarray, count: int) -> np.ndarray:
        scores = V.unit_rows(matrix) @ self.centres.T
        return np.argsort(-scores, axis=1, kind="stable")[:, :count]

    @property
    def dim(self) -> int:
        return self.centres.shape[1]


class Hyperplanes:
    """Cells named by the sides of ``bits`` random planes a vector lies on."""

    def __init__(self, dim: int, bits: int = 6, seed: int = 0):
        if not 1 <= bits <= MAX_BITS:
            raise ValueError(f"bits must be between 1 and {MAX_BITS}")
        self.planes = np.random.default_rng(seed).standard_normal((bits, dim))

    def cell_of(self, matrix: np.ndarray) -> np.ndarray:
        sides = np.nan_to_num(V.unit_rows(matrix) @ self.planes.T, nan=-1.0) > 0
        return sides.astype(np.int64) @ (np.int64(1) << np.arange(len(self.planes), dtype=np.int64))

    def probes(self, matrix: np.ndarray, count: int) -> np.ndarray:
        """Own cell first, then the cells behind the nearest planes."""
        margins = np.abs(V.unit_rows(matrix) @ self.planes.T)
        count = min(count, 1 << len(self.planes))
        flips = np.array([nearest_flips(row, count) for row in margins], np.int64).reshape(len(matrix), count)
        return self.cell_of(matrix)[:, None] ^ flips

    @property
    def dim(self) -> int:
        return self.planes.shape[1]


def nearest_flips(margins: np.ndarray, count: int) -> list[int]:
    """The ``count`` cheapest sets of planes to cross, as bit masks, by rising sum of margins.

    Sets grow from a heap: from a set whose farthest plane is the i-th nearest come the set
    with the next plane added and the one with it in place of the i-th. Each set is reached
    once and after a cheaper one, so 2 * ``count`` of them are looked at, not all 2**bits.
    """
    order = np.argsort(margins, kind="stable").tolist()
    cost = margins[order].tolist()
    flips, heap = [0], [(cost[0], 0, 1 << order[0])]
    while len(flips) < count and heap:
        total, last, mask = heapq.heappop(heap)
        flips.append(mask)
        if last + 1 < len(order):
            following = 1 << order[last + 1]
            heapq.heappush(heap, (total + cost[last + 1], last + 1, mask | following))
            heapq.heappush(heap, (total - cost[last] + cost[last + 1], last + 1, mask ^ (1 << order[last]) | following))
    return flips


Quantizer = Centroids | Hyperplanes


def quantizer_state(quantizer: Quantizer) -> tuple[str, np.ndarray]:
    if isinstance(quantizer, Centroids):
        return "centroids", quantizer.centres
    return "planes", quantizer.planes


def quantizer_from(kind: str, matrix: np.ndarray) -> Quantizer:
    if kind == "centroids":
        return Centroids(matrix)
    planes = Hyperplanes(matrix.shape[1], 1)
    planes.planes = matrix
    return planes


def assign_cells(vectors: DataFrame, quantizer: Quantizer) -> DataFrame:
    """Add ``cell``; vectors that cannot be scored leave."""

    @F.arrow_udf(T.LongType())
    def cell(column: pa.Array) -> pa.Array:
        matrix = V.to_matrix(column, quantizer.dim)
        missing = ~np.isfinite(V.unit_rows(matrix)).all(axis=1)
        return pa.array(quantizer.cell_of(matrix).astype(np.int64), mask=missing)

    # declared nondeterministic so that filters on the cell do not compute it again
    filed = vectors.withColumn("cell", cell.asNondeterministic()("embedding"))
    return filed.where(F.col("cell").isNotNull())


def write_index(filed: DataFrame, path: str) -> None:
    """Store the index by cell; large cells are split over several files."""
    filed.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def approximate_knn(
    filed: DataFrame,
    quantizer: Quantizer,
    queries: DataFrame,
    k: int = 10,
    probes: int = 4,
    key: str = "bibcode",
    query_key: str = "query_id",
    force_routes: bool = False,
) -> DataFrame:
    """The best ``k`` rows of each query among its probed cells; only those are read.

    A query table that fits one block is sent to the tasks that scan the cells; a larger
    one is routed to them. Each query sees the same cells either way. Queries of another
    length than the index find nothing.
    """
    block = None if force_routes else S.read_queries(queries, query_key)
    if block is None:
        return nearest_in_cells(
            filed, queries, lambda matrix: quantizer.probes(matrix, probes), quantizer.dim, k, key, query_key
        )
    if block.ids and block.matrix.shape[1] == quantizer.dim:
        block.cells = quantizer.probes(block.matrix, probes)
        wanted: Sequence[int] = sorted({int(c) for c in block.cells.ravel()})
        filed = filed.where(F.col("cell").isin(list(wanted)))
    else:
        block = S.QueryBlock([], block.matrix)
    found = S.nearest_in_tasks(filed, block, k, key, query_key, queries.schema[query_key].dataType, "cell")
    ranked = top_per_group(found, [query_key], [F.desc("score"), F.asc(key)], k)
    return ranked.select(query_key, "rank", key, "score")


def recall(approximate: DataFrame, exact: DataFrame, key: str = "bibcode", query_key: str = "query_id") -> DataFrame:
    """Share of the exact hits that the approximate search also found."""
    found = approximate.select(query_key, key).withColumn("_found", F.lit(1))
    joined = exact.select(query_key, key).join(found, [query_key, key], "left")
    return joined.agg(
        F.count("*").alias("expected"),
        F.coalesce(F.sum("_found"), F.lit(0)).alias("found"),
        F.coalesce(F.sum("_found") / F.count("*"), F.lit(0.0)).alias("recall"),
    )
