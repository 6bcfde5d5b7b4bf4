"""The record catalog: which vector belongs to which record, year and model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.functions import text as X
from vectorloom.operators.positions import rows_before

CATALOG_KEY = ("bibcode", "model")
ENTRY_COLUMNS = ("bibcode", "year", "row_id", "model", "vector_file")


def vector_file(model: Column | str = "model", year: Column | str = "year") -> Column:
    year = F.col(year) if isinstance(year, str) else year
    return F.concat(F.lit("embeddings_"), X.model_safe_name(model), F.lit("_"), year.cast("string"))


def assign_row_ids(vectors: DataFrame, order: str = "arrival") -> DataFrame:
    """Add ``row_id``: the 0-based place inside the (year, model) block."""
    return rows_before(vectors, ["year", "model"], order, "row_id")


def catalog_entries(vectors: DataFrame, fields_hash: str, prompt_hash: str, order: str = "arrival") -> DataFrame:
    rows = assign_row_ids(vectors.select("bibcode", "year", "model", order), order)
    return rows.select(
        "bibcode",
        "year",
        "row_id",
        "model",
        vector_file().alias("vector_file"),
        F.lit(fields_hash).alias("fields_hash"),
        F.lit(prompt_hash).alias("prompt_hash"),
    )


def append_entries(entries: DataFrame, counts: DataFrame) -> DataFrame:
    """Number new entries on from blocks that already have rows (``year, model, count``)."""
    # one row per year and model, so it fits every task
    earlier = F.broadcast(counts.groupBy("year", "model").agg(F.sum("count").alias("_before")))
    placed = entries.join(earlier, ["year", "model"], "left")
    row_id = F.col("row_id") + F.coalesce("_before", F.lit(0))
    return placed.withColumn("row_id", row_id).select(*entries.columns)


def upsert(entries: DataFrame, key: Sequence[str] = CATALOG_KEY, version: Sequence[str] = ("version", "row_id")) -> DataFrame:
    """One row per key, the latest wins; ``replaced`` counts the older ones.

    A maximum over a struct combines inside the tasks, so a key with any number of
    versions sends one row per task.
    """
    rest = [c for c in entries.columns if c not in key and c not in version]
    latest = F.max(F.struct(*version, *rest)).alias("_latest")
    merged = entries.groupBy(*key).agg(latest, F.count("*").alias("_n"))
    return merged.select(*key, "_latest.*", (F.col("_n") - 1).alias("replaced"))


def merge_catalogs(catalogs: Sequence[DataFrame]) -> DataFrame:
    """Catalogs of several workers in one; later ones in the list win."""
    out = None
    for number, catalog in enumerate(catalogs):
        part = catalog.drop("version").withColumn("version", F.lit(number))
        out = part if out is None else out.unionByName(part)
    return upsert(out)


def manifests(vectors: DataFrame) -> DataFrame:
    """Dimension and count per (year, model)."""
    return vectors.groupBy("year", "model").agg(
        F.max(F.size("embedding")).alias("dim"), F.count("*").alias("count")
    )


def resume_filter(records: DataFrame, done: DataFrame) -> DataFrame:
    """Records of (year, model) blocks that are not finished yet."""
    finished = F.broadcast(done.select("year", "model").distinct())  # one row per year and model
    return records.join(finished, ["year", "model"], "left_anti")


def remove_year_model(catalog: DataFrame, year: int, model: str) -> DataFrame:
    gone = (F.col("year") == year) & (F.col("model") == model)
    return catalog.where(~F.coalesce(gone, F.lit(False)))


def index_stats(catalog: DataFrame) -> DataFrame:
    """Total rows, distinct records and number of (year, model) blocks."""
    # counting by (record, year, model) first keeps one aggregation instead of an expand
    blocks = catalog.select("year", "model").distinct().agg(F.count("*").alias("n"))
    rows = catalog.groupBy("bibcode").agg(F.count("*").alias("n"))
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_embeddings"), F.count("*").alias("unique_bibcodes")).select(
        "total_embeddings", "unique_bibcodes", blocks.scalar().alias("total_manifests")
    )


def year_model_counts(catalog: DataFrame) -> DataFrame:
    counts = catalog.groupBy("year", "model").agg(F.count("*").alias("embeddings"))
    label = F.concat_ws("_", F.col("year").cast("string"), "model")
    return counts.select("year", "model", label.alias("label"), "embeddings").orderBy("year", "model")


def list_years(catalog: DataFrame) -> DataFrame:
    return catalog.select("year").distinct().orderBy("year")


def list_models(catalog: DataFrame) -> DataFrame:
    return catalog.select("model").distinct()


def lookup_records(catalog: DataFrame, wanted: DataFrame, model: str | None = None) -> DataFrame:
    """Catalog entries of the wanted ``bibcode`` values."""
    if model is not None:
        catalog = catalog.where(F.col("model") == model)
    return catalog.select(*ENTRY_COLUMNS).join(wanted.select("bibcode").distinct(), "bibcode", "left_semi")


def embeddings_of(catalog: DataFrame, vectors: DataFrame, wanted: DataFrame, model: str | None = None) -> DataFrame:
    """The stored vectors of the wanted records.

    Where both sides carry it (``version`` in the catalog, ``run`` with the vectors), the
    run must agree too, so that an older vector of a record does not come along.
    """
    keys = ["bibcode", "model"]
    entries = catalog if model is None else catalog.where(F.col("model") == model)
    entries = entries.join(wanted.select("bibcode").distinct(), "bibcode", "left_semi")
    if "version" in catalog.columns and "run" in vectors.columns:
        keys, entries = [*keys, "run"], entries.withColumn("run", F.col("version"))
    found = entries.select(*keys, "year", "row_id")
    return found.join(vectors.select(*keys, "embedding"), keys)


def sample_entries(catalog: DataFrame, n: int = 10, seed: int = 0) -> DataFrame:
    """``n`` entries drawn at random."""
    return catalog.orderBy(F.rand(seed)).limit(n)
