"""Exports: numbered chunks of records, their metadata, and the file formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.functions import text as X
from vectorloom.functions import vectors as V
from vectorloom.operators import embed as E
from vectorloom.operators.positions import rows_before

CHUNK_ROWS = 10_000


def assign_chunks(rows: DataFrame, size: int = CHUNK_ROWS, order: str = "arrival") -> DataFrame:
    """Add ``chunk`` and ``index_in_chunk``: consecutive runs of exactly ``size`` rows."""
    numbered = rows_before(rows, [], order, "_position")
    return (
        numbered.withColumn("chunk", F.expr(f"_position div {size}"))
        .withColumn("index_in_chunk", F.expr(f"cast(_position % {size} as int)"))
        .drop("_position")
    )


def chunk_metadata(chunked: DataFrame) -> DataFrame:
    """Per chunk: size, first and last record, dimension and the record-to-place map.

    A chunk never has more rows than the chunk size, so its map is bounded.
    """
    # a record that occurs twice in a chunk keeps its last place
    places = chunked.groupBy("chunk", "bibcode").agg(
        F.max("index_in_chunk").alias("index"),
        F.min("index_in_chunk").alias("first_index"),
        F.count("*").alias("rows"),
        F.max(F.size("embedding")).alias("dim"),
    )
    entries = F.array_sort(F.collect_list(F.struct("index", "bibcode")))
    return places.groupBy("chunk").agg(
        F.sum("rows").alias("papers_in_chunk"),
        F.min_by("bibcode", "first_index").alias("first_bibcode"),
        F.max_by("bibcode", "index").alias("last_bibcode"),
        F.max("dim").alias("embedding_dimension"),
        F.map_from_entries(F.transform(entries, lambda e: F.struct(e["bibcode"], e["index"]))).alias("bibcode_to_index"),
    )


def chunk_documents(
    chunked: DataFrame,
    model: str,
    model_type: str,
    fields: Sequence[str],
    years: Sequence[int],
    prefix: str = "",
    suffix: str = "",
    delimiter: str = "\n\n",
    truncate: int = 0,
    subset_limit: int | None = None,
    batch_size: int = 256,
    device: str = "auto",
) -> DataFrame:
    """The metadata document of each chunk as nested columns."""
    subset = f"{subset_limit}_papers" if subset_limit else "full_corpus"
    texts = F.array(*[F.lit(f) for f in fields])
    return chunk_metadata(chunked).select(
        "chunk",
        F.struct(
            F.date_format(F.current_timestamp(), "yyyyMMdd_HHmmss").alias("timestamp"),
            F.unix_timestamp(F.current_timestamp()).cast("double").alias("processing_time_unix"),
            F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss 'UTC'").alias("processing_time_iso"),
            F.col("chunk").alias("chunk_number"),
            F.lit(subset).alias("subset_description"),
            F.lit(subset_limit).cast("bigint").alias("subset_limit"),
            "embedding_dimension",
            "papers_in_chunk",
            texts.alias("fields_used"),
            F.lit("|".join(fields)).alias("field_combination"),
            F.struct(
                F.lit(prefix).alias("prefix"),
                F.lit(suffix).alias("suffix"),
                F.lit(delimiter).alias("delimiter"),
                F.lit(truncate).alias("truncate_length"),
            ).alias("preprocessing"),
            F.array(*[F.lit(y) for y in years]).cast("array<int>").alias("years_processed"),
        ).alias("processing_info"),
        F.struct(
            F.lit(model).alias("model_name"),
            F.lit(model_type).alias("model_type"),
            F.col("embedding_dimension").alias("embedding_dim"),
            F.lit(batch_size).alias("batch_size"),
            F.lit(device).alias("device"),
        ).alias("model_info"),
        F.struct(
            "bibcode_to_index",
            F.col("papers_in_chunk").alias("total_papers_in_chunk"),
            "first_bibcode",
            "last_bibcode",
        ).alias("data_mapping"),
    )


def search_documents(vectors: DataFrame, model: str, fields: Sequence[str], with_text: bool = False) -> DataFrame:
    """Rows in the shape a search server ingests."""
    columns = [
        F.col("bibcode"),
        F.col("embedding").alias("embedding_vector"),
        F.lit(model).alias("embedding_model"),
        F.size("embedding").alias("embedding_dim"),
        F.array(*[F.lit(f) for f in fields]).alias("fields_used"),
    ]
    if with_text:
        columns.append(F.col("text").alias("embedded_text"))
    return vectors.select(*columns)


def adhoc_documents(texts: DataFrame, model: str, prefix: str = "", suffix: str = "", key: str = "bibcode") -> DataFrame:
    """Loose texts with what the model was given and the vector it returned."""
    given = texts.select(key, "text", X.affix("text", prefix, suffix).alias("given"))
    embedded = E.embed_texts(given.withColumn("processed_text", F.col("given")), model, "given")
    return embedded.where(F.col("status") == E.OK).select(key, "text", "processed_text", "embedding")


def wide_rows(vectors: DataFrame, dim: int, with_text: bool = False) -> DataFrame:
    """``bibcode, dim_0 ...[, text]``."""
    return vectors.select("bibcode", *V.wide("embedding", dim), *(["text"] if with_text else []))


# ---------------------------------------------------------------- sinks


def _by_chunk(chunked: DataFrame) -> DataFrame:
    # chunks are of equal size, so hashing them spreads the rows evenly
    return chunked.repartition("chunk").sortWithinPartitions("chunk", "index_in_chunk")


def write_json(chunked: DataFrame, path: str, documents: DataFrame | None = None, with_text: bool = False) -> None:
    """``embeddings/chunk=N`` with one JSON row per record; metadata beside it."""
    columns = ["chunk", "bibcode", "embedding", *(["text"] if with_text else [])]
    _by_chunk(chunked).select(*columns).write.mode("overwrite").partitionBy("chunk").json(f"{path}/embeddings")
    if documents is not None:
        documents.write.mode("overwrite").json(f"{path}/metadata")


def write_csv(chunked: DataFrame, path: str, dim: int, with_text: bool = False) -> None:
    columns = ["chunk", "bibcode", *V.wide("embedding", dim), *(["text"] if with_text else [])]
    rows = _by_chunk(chunked).select(*columns)
    writer = rows.write.mode("overwrite").partitionBy("chunk").option("header", True)
    writer.option("quote", '"').option("escape", '"').csv(path)


def write_search_documents(documents: DataFrame, path: str, rows_per_file: int = CHUNK_ROWS) -> None:
    documents.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).json(path)


def write_id_list(entries: DataFrame, path: str, blocks: Sequence[str] = ("year", "model"), order: str = "row_id") -> None:
    """One id per line, a folder per block; within it files in name order give the row order."""
    named = entries.withColumn("model", X.model_safe_name("model")) if "model" in blocks else entries
    ordered = named.repartitionByRange(*blocks, order).sortWithinPartitions(*blocks, order)
    ordered.select("bibcode", *blocks).write.mode("overwrite").partitionBy(*blocks).text(path)


def write_rejects(rejected: DataFrame, path: str) -> None:
    """``bibcode<TAB>reason``; a missing id is written as ``unknown``."""
    named = rejected.select(F.coalesce("bibcode", F.lit("unknown")).alias("bibcode"), "reason")
    named.write.mode("overwrite").option("sep", "\t").csv(path)


def write_summary(summary: DataFrame, path: str) -> None:
    summary.write.mode("overwrite").json(path)


def write_prepared(prepared: DataFrame, path: str) -> None:
    """Prepared texts as Parquet, to be looked at before any model runs."""
    prepared.write.mode("overwrite").parquet(path)
