"""Nearest vectors by cosine: one query, many queries, and their similarity matrix.

One query is a scan with a per-task top-k. Many queries are scored with matrix products
inside the tasks that scan the corpus, and each task keeps only its best ``k`` rows
per query, so what is shuffled does not depend on the number of pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.functions import vectors as V
from vectorloom.functions.batches import released
from vectorloom.operators.positions import top_per_group

# A query block travels to every task: at most this many vectors and bytes.
BLOCK_QUERIES = 2048
BLOCK_BYTES = 32 << 20
SCORES_AT_ONCE = 1 << 20


def topk(
    corpus: DataFrame,
    query: Sequence[float],
    k: int = 10,
    metric: str = "cosine",
    key: str = "bibcode",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` best rows for one query: ``rank, key, score``; ties go to the lower key."""
    scored = corpus.select(key, V.score_against(list(query), metric)(vector).alias("score"))
    best = F.asc_nulls_last("score") if metric == "l2" else F.desc_nulls_last("score")
    hits = scored.orderBy(best, F.asc(key)).limit(k)
    rank = F.row_number().over(W.orderBy(best, F.asc(key)))
    # rows without a score come last; filtered before the limit, the predicate would be
    # pushed below the projection and the score computed twice
    return hits.select(rank.alias("rank"), key, "score").where(F.col("score").isNotNull())


def topk_per_year(corpus: DataFrame, query: Sequence[float], k: int = 10, key: str = "bibcode") -> DataFrame:
    """The ``k`` best rows of every year."""
    scored = corpus.select("year", key, V.score_against(list(query))("embedding").alias("score"))
    best = top_per_group(scored, ["year"], [F.desc_nulls_last("score"), F.asc(key)], k)
    return best.where(F.col("score").isNotNull())


# ---------------------------------------------------------------- many queries


class QueryBlock:
    """Queries held in memory by each task, with the cells each may look into."""

    def __init__(self, ids: list, matrix: np.ndarray, cells: np.ndarray | None = None):
        self.ids = ids
        self.matrix = V.unit_rows(matrix)
        self.cells = cells


def read_queries(queries: DataFrame, key: str, vector: str = "embedding") -> QueryBlock | None:
    """The whole query table if it fits one block, else None; also if its vectors differ in length.

    At most ``BLOCK_QUERIES + 1`` rows are fetched to find out.
    """
    table = queries.select(key, vector).where(F.size(vector) > 0).limit(BLOCK_QUERIES + 1).toArrow()
    vectors = table.column(1).combine_chunks()
    if len(vectors) == 0:
        return QueryBlock([], np.zeros((0, 0)))
    if isinstance(vectors, pa.ChunkedArray):
        vectors = pa.concat_arrays(vectors.chunks)
    lengths = V.as_rows(vectors)[2]
    dim = int(lengths.max())
    if lengths.min() < dim or len(vectors) > BLOCK_QUERIES or len(vectors) * dim * 8 > BLOCK_BYTES:
        return None
    return QueryBlock(table.column(0).to_pylist(), V.to_matrix(vectors, dim))


def _best_of(ids: np.ndarray, scores: np.ndarray, block: QueryBlock, k: int) -> pd.DataFrame:
    """Candidates of one sub-block: for each query every row not below its k-th score."""
    scores = np.where(np.isfinite(scores), np.round(scores, V.SCORE_DECIMALS), -np.inf)
    if len(ids) > k:
        floor = np.partition(scores, len(ids) - k, axis=0)[len(ids) - k]
        at, query = np.nonzero((scores >= floor) & (scores > -np.inf))
    else:
        at, query = np.nonzero(scores > -np.inf)
    return pd.DataFrame({"query": query, "id": ids[at], "score": scores[at, query]})


def keep_best(frames: list[pd.DataFrame], k: int) -> pd.DataFrame:
    merged = pd.concat(frames, ignore_index=True)
    merged = merged.sort_values(["query", "score", "id"], ascending=[True, False, True], kind="stable")
    return merged[merged.groupby("query").cumcount() < k]


def score_block(
    ids: np.ndarray, matrix: np.ndarray, block: QueryBlock, k: int, cells: np.ndarray | None = None
) -> pd.DataFrame:
    """Best ``k`` rows per query among these rows, as ``query`` (position), ``id, score``."""
    best: list[pd.DataFrame] = []
    step = max(SCORES_AT_ONCE // max(len(block.ids), 1), 1)
    for start in range(0, len(ids), step):
        part = slice(start, start + step)
        scores = V.unit_rows(matrix[part]) @ block.matrix.T
        if cells is not None:
            allowed = np.zeros(scores.shape, dtype=bool)
            for probe in block.cells.T:
                allowed |= cells[part][:, None] == probe[None, :]
            scores = np.where(allowed, scores, np.nan)
        best = [keep_best([*best, _best_of(ids[part], scores, block, k)], k)]
    return best[0] if best else pd.DataFrame({"query": [], "id": [], "score": []})


def nearest_in_tasks(
    corpus: DataFrame, block: QueryBlock, k: int, key: str, query_key: str, query_type: T.DataType, cell: str | None = None
) -> DataFrame:
    """Per task, the best ``k`` rows of every query: ``query_key, key, score``."""
    schema = T.StructType().add(query_key, query_type).add(key, corpus.schema[key].dataType).add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pd.DataFrame] = []
        for batch in batches:
            ids = np.asarray(batch.column(key).to_pylist(), dtype=object)
            matrix = V.to_matrix(batch.column("embedding"), block.matrix.shape[1])
            cells = batch.column(cell).to_numpy(zero_copy_only=False) if cell else None
            best = [keep_best([*best, score_block(ids, matrix, block, k, cells)], k)]
        for frame in best:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([block.ids[int(q)] for q in frame["query"]], arrow_type(query_type)),
                    pa.array(frame["id"].tolist(), arrow_type(schema[key].dataType)),
                    pa.array(frame["score"].astype(float)),
                ],
                names=[query_key, key, "score"],
            )

    columns = [key, "embedding"] + ([cell] if cell else [])
    if not block.ids:
        return corpus.sparkSession.createDataFrame([], schema)
    return corpus.select(*columns).mapInArrow(lambda batches: released(run(batches)), schema)


def arrow_type(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)


def knn_join(
    corpus: DataFrame,
    queries: DataFrame,
    k: int = 10,
    key: str = "bibcode",
    query_key: str = "query_id",
    force_passes: bool = False,
) -> DataFrame:
    """The exact ``k`` nearest rows of each query: ``query_key, rank, key, score``.

    Both tables carry ``embedding``; queries meet vectors of their own length. A query
    table that fits one block is sent to the tasks that scan the corpus within this
    query's plan; a larger one goes there pass by pass, and the corpus, which every pass
    scans, should be a stored table.
    """
    from vectorloom.operators.passes import nearest_by_passes

    block = None if force_passes else read_queries(queries, query_key)
    if block is None:
        return nearest_by_passes(corpus, queries, k, key, query_key)
    kind = queries.schema[query_key].dataType
    found = nearest_in_tasks(corpus, block, k, key, query_key, kind)
    ranked = top_per_group(found, [query_key], [F.desc("score"), F.asc(key)], k)
    return ranked.select(query_key, "rank", key, "score")


# ---------------------------------------------------------------- matrix


def similarity_matrix(vectors: DataFrame, key: str = "bibcode", columns_per_block: int = BLOCK_QUERIES) -> DataFrame:
    """Cosine of every vector with every other, as matrix rows.

    One row per vector and block of columns at every size: ``key, block, columns, cosines``
    with the column keys in ascending order and the cosines aligned to them. Every row is
    a column too; a cosine is null with a null, empty or zero vector and between vectors
    of different lengths. A set that fits one block has only block 0. The result is as large
    as the square of the set by nature; ``knn_join`` is the operator for a corpus.
    """
    id_type = vectors.schema[key].dataType
    schema = T.StructType([vectors.schema[key]]).add("block", T.IntegerType())
    schema = schema.add("columns", T.ArrayType(id_type)).add("cosines", T.ArrayType(T.DoubleType()))
    arrow = [arrow_type(id_type), pa.int32(), pa.list_(arrow_type(id_type)), pa.list_(pa.float64())]
    names = [key, "block", "columns", "cosines"]

    other = f"other_{key}"
    sides = vectors.select(key, "embedding")
    # both columns get names of their own: a cogroup of a frame with itself loses shared ones
    others = sides.select(F.col(key).alias(other), F.col("embedding").alias("other_embedding"))
    blocks = max(-(-vectors.count() // columns_per_block), 1)

    def cut(frame: DataFrame, mine: str, facing: str) -> DataFrame:
        placed = frame.withColumn(mine, (F.monotonically_increasing_id() % blocks).cast("int"))
        return placed.select("*", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias(facing))

    left, right = cut(sides, "_row", "_col"), cut(others, "_col", "_row")

    def cell(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return pa.Table.from_batches([], pa.schema(list(zip(names, arrow))))
        columns = theirs.column(other).to_pylist()
        order = sorted(range(len(columns)), key=lambda i: (False,) if columns[i] is None else (True, columns[i]))
        columns = [columns[i] for i in order]
        here = pa.concat_arrays(mine.column("embedding").chunks)
        there = pa.concat_arrays(theirs.column("other_embedding").chunks).take(pa.array(order))
        scores = np.full((mine.num_rows, len(columns)), np.nan)
        lengths = V.as_rows(there)[2]
        for dim in np.unique(lengths[lengths > 0]):
            at = np.flatnonzero(lengths == dim)
            facing = V.unit_rows(V.to_matrix(there.take(pa.array(at)), int(dim)))
            scores[:, at] = np.round(V.unit_rows(V.to_matrix(here, int(dim))) @ facing.T, V.SCORE_DECIMALS)
        cosines = [[None if np.isnan(x) else float(x) for x in row] for row in scores]
        block = theirs.column("_col")[0].as_py()
        data = [mine.column(key).to_pylist(), [block] * mine.num_rows, [columns] * mine.num_rows, cosines]
        return pa.Table.from_arrays([pa.array(d, a) for d, a in zip(data, arrow)], names=names)

    return left.groupBy("_row", "_col").cogroup(right.groupBy("_row", "_col")).applyInArrow(cell, schema)
