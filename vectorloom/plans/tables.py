"""The given tables in the roles the operators expect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.operators import dedup as D
from vectorloom.operators import prepare as P
from vectorloom.operators.store import VectorStore
from vectorloom.operators.term_index import TermIndex
from vectorloom.session import apply_runtime_conf, path_exists, shared_folder

MODEL = "hash://64"
TABLE_MODEL = "table://embeddings"
SETTINGS = P.PrepareSettings(fields=("title", "abstract"))
TEXT_ONLY = P.PrepareSettings(fields=("abstract",))
TERM_FIELDS = ("title", "abstract")
QUERY = "the observation of stars and galaxies in the early universe"
# a query vector given from outside: component i is sin(i + 1)
QUERY_DIM = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_runtime_conf(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def year_of(key: str) -> Column:
    return (F.lit(2000) + F.col(key) % 10).cast("int")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as paper records: source as title, text as abstract."""
    docs = table(spark, sf_dir, "documents")
    year = year_of("doc_id")
    return docs.select(
        F.col("doc_id").cast("string").alias("bibcode"),
        F.col("source").alias("title"),
        F.col("text").alias("abstract"),
        "lang",
        year.alias("year"),
        (year - 2000).alias("source_pos"),
        F.col("doc_id").alias("seq"),
    )


def prepared(spark: SparkSession, sf_dir: str, settings: P.PrepareSettings = TEXT_ONLY) -> DataFrame:
    return P.prepare(records(spark, sf_dir), settings)


def hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.with_hash(prepared(spark, sf_dir))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings`` as a vector store of ten years."""
    stored = table(spark, sf_dir, "embeddings")
    year = year_of("vec_id")
    return stored.select(
        F.col("vec_id").cast("string").alias("bibcode"),
        year.alias("year"),
        F.lit(TABLE_MODEL).alias("model"),
        P.arrival(year - 2000, F.col("vec_id")).alias("arrival"),
        "embedding",
        "label",
    )


def catalog_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows of two runs: all documents, then all stored vectors, under one model."""
    from vectorloom.operators import catalog as C

    first = records(spark, sf_dir).select("bibcode", "year", F.col("seq").alias("arrival"))
    first = first.withColumn("model", F.lit(TABLE_MODEL))
    second = vectors(spark, sf_dir).select("bibcode", (F.col("year") + 10).alias("year"), "model", "arrival")
    runs = [(1, first), (2, second)]
    parts = [C.catalog_entries(rows, "f", "p").withColumn("version", F.lit(v).cast("bigint")) for v, rows in runs]
    return parts[0].unionByName(parts[1])


_kept: dict[tuple, str] = {}


def kept_folder(spark: SparkSession, sf_dir: str, name: str, build: Callable[[str], None]) -> str:
    """A stored table that searches share: built once per application and input folder."""
    wanted = (spark.sparkContext.applicationId, spark.conf.get("spark.checkpoint.dir", None), sf_dir, name)
    folder = _kept.get(wanted)
    if folder is None or not path_exists(spark, f"{folder}/_DONE"):
        folder = shared_folder(spark, name)
        build(folder)
        spark.range(1).coalesce(1).write.parquet(f"{folder}/_DONE")
        _kept[wanted] = folder
    return folder


def document_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bibcode, year, arrival, embedding`` of all documents, embedded once and stored."""
    from vectorloom.operators import embed as E

    def build(folder: str) -> None:
        docs = records(spark, sf_dir).withColumns({"text": F.lower("abstract"), "arrival": P.arrival()})
        embedded = E.embed_texts(docs.select("bibcode", "year", "arrival", "text"), MODEL)
        embedded.select("bibcode", "year", "arrival", "embedding").write.parquet(f"{folder}/vectors")

    return spark.read.parquet(f"{kept_folder(spark, sf_dir, 'document-vectors', build)}/vectors")


def ingested_store(spark: SparkSession, sf_dir: str) -> VectorStore:
    """A store of all documents, ingested once in two runs: those of even numbers, then the others."""
    from vectorloom.plans import pipeline as L

    def build(folder: str) -> None:
        docs, store = records(spark, sf_dir), VectorStore(spark, f"{folder}/store", half_precision=False)
        for run, half in ((1, "seq % 2 = 0"), (2, "seq % 2 = 1")):
            L.ingest(docs.where(half), TEXT_ONLY, MODEL, store, run=run)

    return VectorStore(spark, f"{kept_folder(spark, sf_dir, 'ingested', build)}/store", half_precision=False)


def term_index(spark: SparkSession, sf_dir: str) -> TermIndex:
    """Titles and texts of all documents, indexed once in two runs."""

    def build(folder: str) -> None:
        docs, index = records(spark, sf_dir), TermIndex(spark, folder, TERM_FIELDS)
        for run, half in ((1, "seq % 2 = 0"), (2, "seq % 2 = 1")):
            index.append(docs.where(half), run)

    return TermIndex(spark, kept_folder(spark, sf_dir, "term-index", build), TERM_FIELDS)


def query_vector() -> list[float]:
    import math

    return [math.sin(i + 1) for i in range(QUERY_DIM)]
