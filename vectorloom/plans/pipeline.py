"""The ingest of a corpus and the searches on what it stored."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.operators import catalog as C
from vectorloom.operators import dedup as D
from vectorloom.operators import embed as E
from vectorloom.operators import prepare as P
from vectorloom.operators import search as S
from vectorloom.operators.index import SearchIndex, open_index
from vectorloom.operators.store import VectorStore


# fixed values: the counters of a run
COUNTERS = (
    "loaded_records", "total_records", "processed_records", "skipped_records", "failed_records", "duplicate_records",
    "total_batches",
)


@dataclass(frozen=True)
class IngestOptions:
    dedup: bool = True
    cross_year: bool = True
    resume: bool = False
    kind: str = "gpu"
    batch_limit: int = 256
    max_tokens: int = 8192


def ingest(
    records: DataFrame,
    settings: P.PrepareSettings,
    model: str,
    store: VectorStore,
    options: IngestOptions = IngestOptions(),
    run: int | None = None,
) -> DataFrame:
    """Prepare, deduplicate, embed and store; returns the run's counters.

    ``records`` need ``bibcode``, the fields as text, ``year``, ``source_pos`` and
    ``seq``. The prepared texts are written first: the costly model stage then starts
    from a table and not from the whole lineage. The order of the other writes is
    vectors, catalog, hashes, so a run that breaks off is repeated in full under the
    same number.
    """
    started = time.time()
    run = store.next_run() if run is None else run
    E.factory_for(model)
    if options.resume:
        named = records.withColumn("model", F.lit(model))
        records = C.resume_filter(named, store.manifests()).drop("model")

    tagged = P.tag_prepared(records, settings)
    staged = D.with_hash(tagged.withColumn("arrival", P.arrival())).select(
        "bibcode", "year", "arrival", "text", "text_hash", "reason",
        F.lit(model).alias("model"), F.lit(settings.fields_hash).alias("fields_hash"),
    )
    folder = store.path(f"prepared/run={run}")
    staged.write.mode("overwrite").parquet(folder)
    staged = store.spark.read.parquet(folder)
    prepared = staged.where(F.col("reason").isNull()).drop("reason", "model", "fields_hash")

    known = store.hash_rows(run, model, settings.fields_hash, prepared)
    fresh = _fresh(prepared, known, options)
    embedded = E.embed_texts(
        fresh, model, kind=options.kind, limit=options.batch_limit, max_tokens=options.max_tokens
    )
    store.write_vectors(embedded, run)
    store.append_catalog(run, settings.fields_hash, settings.prompt_hash)
    store.append_hashes(run, settings.fields_hash)
    store.write_run_log(run, model, settings.fields_hash, started, time.time(), counters(store, run))
    return store.run_log().where(F.col("run") == run).select(*COUNTERS)


def _fresh(prepared: DataFrame, known: DataFrame, options: IngestOptions) -> DataFrame:
    if not options.dedup:
        return prepared
    if options.cross_year:
        return D.unique_rows(prepared, known)
    # texts of other years do not count, so the stored texts are told apart by year too
    known_year = D.among(known, prepared).select("text_hash", F.col("first_seen_year").alias("year"))
    firsts = D.first_arrivals(prepared, cross_year=False).join(known_year, ["text_hash", "year"], "left_anti")
    return prepared.join(firsts.select("arrival"), "arrival", "left_semi")


def run_duplicates(store: VectorStore, run: int, cross_year: bool = True) -> DataFrame:
    """The duplicate report of a stored run."""
    staged = store.spark.read.parquet(store.path(f"prepared/run={run}"))
    prepared = staged.where(F.col("reason").isNull()).drop("reason")
    one = prepared.select("model", "fields_hash").first()  # the same in all rows of a run
    model, fields_hash = one or ("", "")
    return D.duplicates(prepared, store.hashes(run, prepared, model, fields_hash), cross_year)


def run_rejects(store: VectorStore, run: int) -> DataFrame:
    staged = store.spark.read.parquet(store.path(f"prepared/run={run}"))
    return staged.where(F.col("reason").isNotNull()).select("bibcode", "reason", "year")


def counters(store: VectorStore, run: int) -> DataFrame:
    """Counters of a stored run: two scans of narrow columns, nothing is joined."""
    staged = store.spark.read.parquet(store.path(f"prepared/run={run}"))
    results = store.results(run)
    made = results.agg(
        F.struct(
            F.count_if(F.col("status") == E.OK).alias("ok"),
            F.count_if(F.col("status") == E.FAILED).alias("failed"),
            F.count("batch_no").alias("calls"),
        ).alias("made")
    ).scalar()
    loaded, usable = F.count("*").alias("loaded"), F.count_if(F.col("reason").isNull()).alias("usable")
    counted = staged.agg(loaded, usable).select("*", made.alias("made"))
    return counted.select(
        F.col("loaded").alias("loaded_records"),
        F.col("usable").alias("total_records"),
        F.col("made.ok").alias("processed_records"),
        (F.col("loaded") - F.col("usable")).alias("skipped_records"),
        F.col("made.failed").alias("failed_records"),
        (F.col("usable") - F.col("made.ok") - F.col("made.failed")).alias("duplicate_records"),
        F.col("made.calls").alias("total_batches"),
    )


def search_similar(store: VectorStore, query: str, model: str, year: int | None = None, k: int = 10) -> DataFrame:
    """The ``k`` stored records nearest to a text, in one year or in all."""
    return S.topk(store.vectors(year, model), E.embed_one(query, model), k)


def index_of(store: VectorStore, model: str, year: int, index_type: str = "flat", **options) -> SearchIndex:
    """The search index of one year and model, stored beside its vectors."""
    safe = model.replace("/", "_").replace(":", "_")
    return open_index(store.spark, store.path(f"indexes/index_{safe}_{year}_{index_type}"), index_type, **options)


def build_index(store: VectorStore, model: str, year: int, index_type: str = "flat", **options) -> SearchIndex:
    index = index_of(store, model, year, index_type, **options)
    index.build(store.vectors(year, model))
    return index


def search_index(index: SearchIndex, query: str, model: str, k: int = 10) -> DataFrame:
    """A text looked up in a stored index."""
    spark = index.spark
    asked = spark.createDataFrame([(0, E.embed_one(query, model))], "query_id int, embedding array<float>")
    return index.search(asked, k).select("rank", "bibcode", "score")


def get_embedding(store: VectorStore, bibcode: str, model: str) -> DataFrame:
    """The stored vector of one record under a model, through its catalog entry."""
    entry = store.catalog().where(F.col("bibcode") == bibcode)
    rows = store.vectors(model=model).where(F.col("bibcode") == bibcode)
    return C.embeddings_of(entry, rows, entry, model)
