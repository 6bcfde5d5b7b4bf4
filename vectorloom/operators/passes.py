"""Nearest vectors for query tables of any size.

``nearest_by_passes``: query blocks travel to the tasks that scan the corpus in place, a
bounded group of blocks per pass. A task keeps the best ``k`` rows of every query; the
passes' results are written one by one, so a lost pass is repeated alone.

``nearest_in_cells``: with vectors filed under cells, each query goes to its probed cells
and meets only their rows. Cells with many rows or queries are cut into parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.functions import vectors as V
from vectorloom.functions.batches import released
from vectorloom.operators import search as S
from vectorloom.operators.positions import top_per_group
from vectorloom.session import shared_folder, ship_package

# Queries of one pass; they travel to every task.
PASS_QUERIES = 8192
PASS_BYTES = 64 << 20
# Rows and queries that meet in one part of a cell.
PART_ROWS = 32_768
PART_QUERIES = 8192


def blocks_by_length(ids: np.ndarray, vectors: pa.Array) -> list[S.QueryBlock]:
    """Queries in memory as one block per vector length; empty vectors are left out."""
    lengths = V.as_rows(vectors)[2]
    blocks = []
    for dim in np.unique(lengths[lengths > 0]):
        at = np.flatnonzero(lengths == dim)
        blocks.append(S.QueryBlock(ids[at].tolist(), V.to_matrix(vectors.take(pa.array(at)), int(dim))))
    return blocks


def _one(table: pa.Table | pa.RecordBatch, column: str) -> pa.Array:
    found = table.column(column)
    return pa.concat_arrays(found.chunks) if isinstance(found, pa.ChunkedArray) else found


def _objects(table: pa.Table | pa.RecordBatch, column: str) -> np.ndarray:
    return np.asarray([*table.column(column).to_pylist(), None], dtype=object)[:-1]


def _hits(found: pd.DataFrame, schema: T.StructType, query_key: str, key: str) -> pa.Table:
    types = [S.arrow_type(schema[c].dataType) for c in (query_key, key)]
    columns = [pa.array(found["query"].tolist(), types[0]), pa.array(found["id"].tolist(), types[1])]
    return pa.table([*columns, pa.array(found["score"].astype(float), pa.float64())], names=[query_key, key, "score"])


def query_passes(queries: DataFrame, query_key: str, most_rows: int, most_bytes: int) -> Iterator[pa.Table]:
    """The query table in pieces of bounded size, read one after the other from its stored copy."""
    spark = queries.sparkSession
    folder = shared_folder(spark, "queries")
    rows = queries.select(query_key, "embedding").where(F.size("embedding") > 0)
    rows.write.option("maxRecordsPerFile", most_rows).parquet(folder)
    files = spark.read.parquet(folder)
    counts = files.groupBy(F.input_file_name().alias("file")).agg(F.count("*").alias("n"), F.sum(F.size("embedding")).alias("size"))
    group, held, size = [], 0, 0
    for file, n, components in counts.orderBy("file").collect():  # one row per file
        if group and (held + n > most_rows or size + 8 * components > most_bytes):
            yield spark.read.schema(files.schema).parquet(*group).toArrow()
            group, held, size = [], 0, 0
        group.append(file)
        held, size = held + n, size + 8 * components
    if group:
        yield spark.read.schema(files.schema).parquet(*group).toArrow()


def nearest_in_place(corpus: DataFrame, blocks: list[S.QueryBlock], k: int, key: str, query_key: str, schema: T.StructType) -> DataFrame:
    """Per task the best ``k`` rows of every query of the blocks."""
    ship_package(corpus.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[pd.DataFrame | None] = [None] * len(blocks)
        for batch in batches:
            ids, vectors = _objects(batch, key), batch.column("embedding")
            for at, block in enumerate(blocks):
                found = S.score_block(ids, V.to_matrix(vectors, block.matrix.shape[1]), block, k)
                best[at] = found if best[at] is None else S.keep_best([best[at], found], k)
        for block, found in zip(blocks, best):
            if found is not None and len(found):
                found = found.assign(query=[block.ids[int(q)] for q in found["query"]])
                yield from _hits(found, schema, query_key, key).to_batches()

    return corpus.select(key, "embedding").mapInArrow(lambda batches: released(run(batches)), schema)


def nearest_by_passes(
    corpus: DataFrame,
    queries: DataFrame,
    k: int,
    key: str,
    query_key: str,
    pass_queries: int = PASS_QUERIES,
    pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """The best ``k`` rows of every query: ``query_key, rank, key, score``.

    Each pass scans the corpus, so give a stored table. Nothing of the corpus moves but
    a task's best rows. Repeated query keys are one query's name for several vectors and
    share its ``k`` places; repeated corpus keys are rows of their own.
    """
    spark = corpus.sparkSession
    schema = hit_schema(corpus, queries, key, query_key)
    folder = shared_folder(spark, "passes")
    number = 0
    for table in query_passes(queries, query_key, pass_queries, pass_bytes):
        blocks = blocks_by_length(_objects(table, query_key), _one(table, "embedding"))
        found = nearest_in_place(corpus, blocks, k, key, query_key, schema)
        top_per_group(found, [query_key], _order(key), k).write.parquet(f"{folder}/pass={number}")
        number += 1
    if not number:
        return spark.createDataFrame([], T.StructType([schema[query_key]]).add("rank", T.IntegerType()).add(schema[key]).add("score", "double"))
    # a query's name may be in several passes: their best rows are merged
    states = spark.read.parquet(folder).drop("rank", "pass")
    return top_per_group(states, [query_key], _order(key), k).select(query_key, "rank", key, "score")


def hit_schema(corpus: DataFrame, queries: DataFrame, key: str, query_key: str) -> T.StructType:
    return T.StructType([queries.schema[query_key], corpus.schema[key]]).add("score", "double")


def _order(key: str) -> list:
    return [F.desc("score"), F.asc(key)]


# ---------------------------------------------------------------- cells


def routed(queries: DataFrame, query_key: str, probes: Callable[[np.ndarray], np.ndarray], dim: int) -> DataFrame:
    """``query_key, embedding, cell``: a row per query and probed cell; other lengths have none."""
    kind = queries.schema[query_key].dataType
    schema = T.StructType().add(query_key, kind).add("embedding", queries.schema["embedding"].dataType).add("cell", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("embedding")
            matrix = V.to_matrix(vectors, dim)
            usable = np.flatnonzero(np.isfinite(V.unit_rows(matrix)).all(axis=1))
            if not len(usable):
                continue
            cells = probes(matrix[usable])
            at = pa.array(np.repeat(usable, cells.shape[1]))
            columns = [batch.column(query_key).take(at), vectors.take(at), pa.array(cells.ravel().astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, [query_key, "embedding", "cell"])

    ship_package(queries.sparkSession)
    return queries.select(query_key, "embedding").mapInArrow(lambda batches: released(run(batches)), schema)


def nearest_in_cells(
    filed: DataFrame,
    queries: DataFrame,
    probes: Callable[[np.ndarray], np.ndarray],
    dim: int,
    k: int,
    key: str,
    query_key: str,
    part_rows: int = PART_ROWS,
    part_queries: int = PART_QUERIES,
) -> DataFrame:
    """The best ``k`` rows of every query within its probed cells: ``query_key, rank, key, score``.

    Only probed cells are read. A cell is cut into parts of about ``part_rows`` rows and
    ``part_queries`` queries, by counts per cell; rows and queries are dealt by their place
    in the input, so repeated keys don't meet. A row is copied once per part of queries of
    its cell, a query once per part of rows, and only in cells that are cut.
    """
    schema = hit_schema(filed, queries, key, query_key)
    asked = routed(queries, query_key, probes, dim)
    folder = shared_folder(filed.sparkSession, "routed")
    asked.write.parquet(folder)
    asked = filed.sparkSession.read.schema(asked.schema).parquet(folder)
    wanted = asked.groupBy("cell").agg(F.count("*").alias("queries"))
    # one value per cell: at most as many as the index has folders
    cells = [row["cell"] for row in wanted.select("cell").collect()]
    rows = filed.where(F.col("cell").isin(cells)).select(key, "embedding", F.col("cell").cast("bigint").alias("cell"))
    parts = rows.groupBy("cell").agg(F.count("*").alias("rows")).join(wanted, "cell")
    parts = parts.select(
        "cell",
        F.ceil(F.col("rows") / part_rows).cast("int").alias("down"),
        F.ceil(F.col("queries") / part_queries).cast("int").alias("across"),
    )

    def dealt(frame: DataFrame, mine: str, other: str, own: str, facing: str) -> DataFrame:
        placed = frame.join(F.broadcast(parts), "cell")
        place = F.monotonically_increasing_id() % F.col(own)
        placed = placed.withColumn(mine, place.cast("int"))
        placed = placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.col(facing) - 1)))
        return placed.drop("down", "across")

    left = dealt(rows, "row_part", "query_part", "down", "across")
    right = dealt(asked, "query_part", "row_part", "across", "down")

    def meet(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        if not mine.num_rows or not theirs.num_rows:
            return _hits(pd.DataFrame({"query": [], "id": [], "score": []}), schema, query_key, key)
        block = S.QueryBlock(_objects(theirs, query_key).tolist(), V.to_matrix(_one(theirs, "embedding"), dim))
        found = S.score_block(_objects(mine, key), V.to_matrix(_one(mine, "embedding"), dim), block, k)
        return _hits(found.assign(query=[block.ids[int(q)] for q in found["query"]]), schema, query_key, key)

    names = ["cell", "row_part", "query_part"]
    found = left.groupBy(*names).cogroup(right.groupBy(*names)).applyInArrow(meet, schema)
    return top_per_group(found, [query_key], _order(key), k).select(query_key, "rank", key, "score")
