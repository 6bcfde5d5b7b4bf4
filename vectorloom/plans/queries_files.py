"""Queries that write the given tables as files and read them back, in batch and as a stream.

The files go to the shared folder the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.functions import vectors as V
from vectorloom.operators import ann as N
from vectorloom.operators import catalog as C
from vectorloom.operators import dedup as D
from vectorloom.operators import export as X
from vectorloom.operators import prepare as P
from vectorloom.operators import stats as A
from vectorloom.operators.index import open_index
from vectorloom.operators.store import VectorStore
from vectorloom.plans import pipeline as L
from vectorloom.plans import tables as B
from vectorloom.plans.oracle_parts import DOCS, HASHED, STRIP, VECS, hashed_vectors
from vectorloom.plans.queries_vectors import _KNN, DOC_VECTORS, _benchmark_vectors, _checksum, _embedded, _six
from vectorloom.plans.registry import query
from vectorloom.session import shared_folder
from vectorloom.sources import files as R
from vectorloom.streaming.ingest import ingest_stream, stream_lines

FIELDS = ["title", "abstract"]
YEARS = list(range(2000, 2010))


def _write_lines(spark, sf_dir, compression="none"):
    """Documents as JSON lines; one folder per year, the German ones broken."""
    folder = shared_folder(spark, "lines")
    docs = B.records(spark, sf_dir)
    value = F.to_json(F.struct("bibcode", "title", "abstract", F.col("seq").alias("doc")))
    value = F.when(F.col("lang") == "de", F.substring(value, 1, F.length(value) - 1)).otherwise(value)
    docs.select(value.alias("value")).write.option("compression", compression).text(folder)
    return folder


def _rename(spark, folder, target):
    """Move the one data file a writer left in a folder to its final name."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    part = [s.getPath() for s in fs.listStatus(path(folder)) if s.getPath().getName().startswith("part-")]
    fs.rename(part[0], path(target))


def _year_folder(spark, sf_dir, suffix):
    """A folder with one JSONL file per year, named like ``2003.jsonl.gz``."""
    folder = shared_folder(spark, "years")
    rows = B.records(spark, sf_dir)
    value = F.to_json(F.struct("bibcode", "title", "abstract"))
    lines = rows.select("year", "seq", value.alias("value")).repartition("year").sortWithinPartitions("year", "seq")
    compression = "gzip" if "gz" in suffix else "none"
    lines.select("year", "value").write.partitionBy("year").option("compression", compression).text(f"{folder}/parts")
    for year in YEARS:
        _rename(spark, f"{folder}/parts/year={year}", f"{folder}/{year}{suffix}")
    return folder


@query("scan_jsonl", f"WITH {DOCS} SELECT bibcode, title, abstract FROM docs WHERE lang <> 'de'")
def scan_jsonl(spark, sf_dir):
    parsed = R.parse_lines(R.scan_lines(spark, _write_lines(spark, sf_dir)))
    return R.project_fields(R.valid_records(parsed), FIELDS).select("bibcode", "title", "abstract")


@query("scan_gzip", f"WITH {DOCS} SELECT bibcode, title, abstract FROM docs WHERE lang <> 'de'")
def scan_gzip(spark, sf_dir):
    parsed = R.parse_lines(R.scan_lines(spark, _write_lines(spark, sf_dir, "gzip")))
    return R.project_fields(R.valid_records(parsed), FIELDS).select("bibcode", "title", "abstract")


_ORDERED = f"""WITH {DOCS} SELECT bibcode, year, abstract,
  CAST(row_number() OVER (PARTITION BY year ORDER BY seq) - 1 AS BIGINT) AS line FROM docs"""


def _in_order(records):
    rows = R.project_fields(records, FIELDS)
    numbered = C.rows_before(rows.withColumn("arrival", P.arrival()), ["year"], "arrival", "line")
    return numbered.select("bibcode", "year", "abstract", "line")


@query("scan_years", _ORDERED)
def scan_years(spark, sf_dir):
    """All years of a folder, with the line order of each file."""
    records, _ = R.load_years(spark, _year_folder(spark, sf_dir, ".jsonl"), YEARS, FIELDS + ["bibcode"])
    return _in_order(records)


@query("scan_magic_gzip", _ORDERED)
def scan_magic_gzip(spark, sf_dir):
    """Gzip files that only their first bytes give away."""
    folder = _year_folder(spark, sf_dir, ".jsonl.gz")
    for year in YEARS:
        _move(spark, f"{folder}/{year}.jsonl.gz", f"{folder}/{year}.json")
    records, _ = R.load_years(spark, folder, YEARS, FIELDS + ["bibcode"])
    return _in_order(records)


def _move(spark, source, target):
    path = spark._jvm.org.apache.hadoop.fs.Path
    path(source).getFileSystem(spark._jsc.hadoopConfiguration()).rename(path(source), path(target))


@query("discover_years", f"WITH {DOCS} SELECT DISTINCT year FROM docs")
def discover_years(spark, sf_dir):
    return R.discover_years(R.list_files(spark, _year_folder(spark, sf_dir, ".jsonl")))


@query("resolve_year_files", f"WITH {DOCS} SELECT DISTINCT year, year || '.json.gz' AS name FROM docs")
def resolve_year_files(spark, sf_dir):
    """``.json.gz`` goes before ``.jsonl`` where a year has both."""
    folder = _year_folder(spark, sf_dir, ".jsonl")
    other = _year_folder(spark, sf_dir, ".json.gz")
    for year in YEARS:
        _move(spark, f"{other}/{year}.json.gz", f"{folder}/{year}.json.gz")
    found = R.resolve_year_files(R.list_files(spark, folder))
    return found.select("year", F.substring_index("path", "/", -1).alias("name"))


@query("sniff_jsonl", f"WITH {DOCS} SELECT DISTINCT year, 'lines' AS format FROM docs")
def sniff_jsonl(spark, sf_dir):
    """The format of each year file."""
    folder = _year_folder(spark, sf_dir, ".jsonl")
    files = R.resolve_year_files(R.list_files(spark, folder))
    return files.join(R.detect_formats(spark, folder), "path").select("year", "format")


@query("scan_json_array", f"WITH {DOCS} SELECT bibcode, title, abstract FROM docs")
def scan_json_array(spark, sf_dir):
    """Files that hold one JSON array each."""
    folder = shared_folder(spark, "arrays")
    docs = B.records(spark, sf_dir)
    # one array per hundred records: files of bounded size
    item = F.struct(F.col("seq").alias("at"), "bibcode", "title", "abstract")
    arrays = docs.groupBy(F.expr("seq div 100").alias("part")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    text = F.to_json(F.transform("items", lambda i: F.struct(i["bibcode"], i["title"], i["abstract"])))
    arrays.select("part", text.alias("value")).repartition("part").write.partitionBy("part").text(folder)
    records = R.scan_documents(spark, f"{folder}/part=*", ["bibcode", *FIELDS])
    return R.project_fields(records, FIELDS).select("bibcode", "title", "abstract")


# ---------------------------------------------------------------- store and exports

_STORED = f"""{HASHED}, kept AS (SELECT * FROM hashed SEMI JOIN firsts USING (arrival))"""


def _ingested(spark, sf_dir):
    store = VectorStore(spark, shared_folder(spark, "store"), half_precision=False)
    made = L.ingest(B.records(spark, sf_dir), B.TEXT_ONLY, B.MODEL, store, run=1)
    return store, made


@query(
    "ingest_counters",
    f"""WITH {_STORED} SELECT (SELECT count(*) FROM docs) AS loaded_records, (SELECT count(*) FROM hashed) AS total_records,
        (SELECT count(*) FROM kept) AS processed_records, 0::BIGINT AS skipped_records, 0::BIGINT AS failed_records,
        (SELECT count(*) FROM hashed) - (SELECT count(*) FROM kept) AS duplicate_records, true AS calls_cover""",
)
def ingest_counters(spark, sf_dir):
    """How many calls a run makes follows the tasks; each holds 1 to 256 of its texts."""
    made = _ingested(spark, sf_dir)[1]
    calls, texts = F.col("total_batches"), F.col("processed_records")
    return made.withColumn("calls_cover", (calls <= texts) & (calls * 256 >= texts)).drop("total_batches")


@query(
    "ingest_catalog",
    f"""WITH {_STORED} SELECT bibcode, year, row_number() OVER (PARTITION BY year ORDER BY arrival) - 1 AS row_id,
        'embeddings_hash___64_' || year AS vector_file FROM kept""",
)
def ingest_catalog(spark, sf_dir):
    store, _ = _ingested(spark, sf_dir)
    return store.catalog().select("bibcode", "year", "row_id", "vector_file")


@query(
    "ingest_stream",
    f"WITH {_STORED} SELECT text_hash, true AS known_pair FROM kept",
)
def ingest_stream_query(spark, sf_dir):
    """The year files arriving one by one; each text is stored once over all batches."""
    folder = _year_folder(spark, sf_dir, ".jsonl")
    store = VectorStore(spark, shared_folder(spark, "store"))
    lines = stream_lines(spark, f"{folder}/*.jsonl", files_per_trigger=4)
    writer = ingest_stream(lines, B.TEXT_ONLY, "hash://16", store, shared_folder(spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    # which of the equal texts came first is up to the batches; it must be one that has the text
    given = B.hashed(spark, sf_dir).select("bibcode", "year", "text_hash", F.lit(True).alias("known_pair"))
    kept = store.vectors().select("bibcode", "year", "text_hash").join(given, ["bibcode", "year", "text_hash"], "left")
    return kept.select("text_hash", F.coalesce("known_pair", F.lit(False)).alias("known_pair"))


# documents ingested in two runs: even numbers first
_TWO_RUNS = f"""{DOCS}, hashed AS (
  SELECT bibcode, year, seq, arrival, lower(abstract) AS text, 1 + seq % 2 AS run,
         sha256(lower(trim(lower(abstract), {STRIP}))) AS text_hash FROM docs WHERE abstract <> ''),
prep AS (SELECT * FROM hashed QUALIFY row_number() OVER (PARTITION BY text_hash ORDER BY run, arrival) = 1)"""
_TWO_RUNS_VECTORS = f"{_TWO_RUNS}, {hashed_vectors('dv', 'prep', 'bibcode', 'text', 64)}"


@query(
    "stored_vectors",
    f"""WITH {_TWO_RUNS_VECTORS}, sums AS (SELECT bibcode, sum(stored) AS s, sum((d + 1) * stored) AS w FROM dv GROUP BY 1)
        SELECT bibcode, year, '{B.MODEL}' AS model, run, round(coalesce(s, 0), 5) AS checksum, round(coalesce(w, 0), 4) AS weighed
        FROM prep LEFT JOIN sums USING (bibcode)""",
)
def stored_vectors(spark, sf_dir):
    """Every vector of a store; the weighed sum tells components in another order apart."""
    rows = B.ingested_store(spark, sf_dir).vectors()
    weighed = F.aggregate(
        F.transform("embedding", lambda x, i: x.cast("double") * (i + 1)), F.lit(0.0), lambda total, x: total + x
    )
    checksum = F.round(V.component_sums("embedding")[0], 5)
    return rows.select("bibcode", "year", "model", "run", checksum.alias("checksum"), F.round(weighed, 4).alias("weighed"))


@query(
    "stored_lookup",
    f"""WITH {_TWO_RUNS}, placed AS (SELECT *, row_number() OVER (PARTITION BY year ORDER BY run, arrival) - 1 AS row_id FROM prep)
        SELECT bibcode, year, row_id FROM placed WHERE bibcode IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
)
def stored_lookup(spark, sf_dir):
    """The stored vectors of all labelled records, through the catalog."""
    store = B.ingested_store(spark, sf_dir)
    wanted = B.table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("bibcode"))
    found = C.embeddings_of(store.catalog(), store.vectors(model=B.MODEL), wanted, B.MODEL)
    return found.where(F.size("embedding") == 64).select("bibcode", "year", "row_id")


@query(
    "stored_manifests",
    f"WITH {_TWO_RUNS} SELECT year, '{B.MODEL}' AS model, 64::INTEGER AS dim, count(*) AS \"count\" FROM prep GROUP BY year",
)
def stored_manifests(spark, sf_dir):
    return B.ingested_store(spark, sf_dir).manifests().select("year", "model", "dim", "count")


@query(
    "seen_texts_snapshot",
    f"WITH {_TWO_RUNS} SELECT text_hash, bibcode AS first_seen_bibcode, year AS first_seen_year FROM prep",
)
def seen_texts_snapshot(spark, sf_dir):
    """Seen texts read from a snapshot of the first run and the run after it, for the documents' own hashes."""
    store = B.ingested_store(spark, sf_dir)
    if not store.exists("hash_base/upto=1/_SUCCESS"):
        store.compact_hashes(1)
    folder = shared_folder(spark, "wanted")
    B.hashed(spark, sf_dir).select("text_hash").write.parquet(folder)
    return store.hashes(wanted=spark.read.parquet(folder))


@query(
    "dedup_store_estimate",
    f"WITH {_TWO_RUNS} SELECT count(*) AS unique_hashes, true AS within_two_percent FROM prep",
)
def dedup_store_estimate(spark, sf_dir):
    """The estimate from the runs' sketches against the exact count."""
    store = B.ingested_store(spark, sf_dir)
    exact = D.store_stats(store.hash_rows())
    error = F.abs(F.col("estimated_unique_hashes") - F.col("unique_hashes")) / F.greatest(F.col("unique_hashes"), F.lit(1))
    both = store.hash_estimate().join(F.broadcast(exact))
    return both.select("unique_hashes", (error <= 0.02).alias("within_two_percent"))


@query(
    "run_throughput",
    f"""WITH {_TWO_RUNS}, n AS (SELECT run, count(*) AS processed_records FROM prep GROUP BY run)
        SELECT run, processed_records, CAST(sum(processed_records) OVER (ORDER BY run) AS BIGINT) AS records_done,
        true AS rate_fits, true AS time_left_fits FROM n""",
)
def run_throughput(spark, sf_dir):
    """Figures of the stored runs; times differ from run to run, so what they must satisfy is compared."""
    store = B.ingested_store(spark, sf_dir)
    planned = B.records(spark, sf_dir).count() * 2
    rows = A.run_throughput(store.run_log(), planned)
    rate = F.abs(F.col("records_per_second") * F.col("seconds") - F.col("processed_records")) < 1e-6
    left = F.abs(F.col("hours_left") * 3600 * F.col("records_per_second") - (F.lit(planned) - F.col("records_done"))) < 1e-3
    return rows.select("run", "processed_records", "records_done", rate.alias("rate_fits"), left.alias("time_left_fits"))


_ALL_VECTORS = f"WITH {VECS} SELECT bibcode, round(list_sum(v), 6) AS checksum FROM vecs"


def _chunked(spark, sf_dir):
    return X.assign_chunks(B.vectors(spark, sf_dir), 250)


@query("export_csv", _ALL_VECTORS)
def export_csv(spark, sf_dir):
    folder = shared_folder(spark, "csv")
    X.write_csv(_chunked(spark, sf_dir), folder, 64)
    back = spark.read.option("header", True).csv(folder)
    vector = F.array(*[F.col(f"dim_{i}").cast("float") for i in range(64)])
    return back.select("bibcode", vector.alias("embedding")).select("bibcode", _checksum())


@query("export_json", _ALL_VECTORS)
def export_json(spark, sf_dir):
    folder = shared_folder(spark, "json")
    chunked = _chunked(spark, sf_dir)
    documents = X.chunk_documents(chunked, B.TABLE_MODEL, "unknown", FIELDS, YEARS)
    X.write_json(chunked, folder, documents)
    back = spark.read.schema("bibcode string, embedding array<float>").json(f"{folder}/embeddings")
    return back.select("bibcode", _checksum())


@query("export_search_docs", _ALL_VECTORS)
def export_search_docs(spark, sf_dir):
    folder = shared_folder(spark, "docs")
    X.write_search_documents(X.search_documents(B.vectors(spark, sf_dir), B.TABLE_MODEL, FIELDS), folder, 100)
    back = spark.read.schema("bibcode string, embedding_vector array<float>").json(folder)
    return back.select("bibcode", _checksum("embedding_vector"))


@query(
    "id_list",
    f"""WITH {VECS} SELECT bibcode, year, row_number() OVER (PARTITION BY year ORDER BY arrival) - 1 AS line FROM vecs""",
)
def id_list(spark, sf_dir):
    """One list per block, in row order."""
    folder = shared_folder(spark, "ids")
    X.write_id_list(C.catalog_entries(B.vectors(spark, sf_dir), "f", "p"), folder)
    lines = R.scan_lines(spark, f"{folder}/year=*/model=*")
    year = F.regexp_extract("path", "year=([0-9]+)/", 1).cast("int")
    placed = lines.select(F.col("value").alias("bibcode"), year.alias("year"), "path", "seq")
    line = F.row_number().over(W.partitionBy("year").orderBy("path", "seq")) - 1
    return placed.select("bibcode", "year", line.cast("bigint").alias("line"))


@query(
    "adhoc_export",
    "SELECT item_id, 'query: ' || text AS processed_text, 16::INTEGER AS dim FROM benchmark",
)
def adhoc_export(spark, sf_dir):
    folder = shared_folder(spark, "adhoc")
    texts = B.table(spark, sf_dir, "benchmark").select("item_id", "text")
    X.adhoc_documents(texts, "hash://16", "query: ", key="item_id").write.json(folder)
    back = spark.read.schema("item_id bigint, processed_text string, embedding array<float>").json(folder)
    return back.select("item_id", "processed_text", F.size("embedding").alias("dim"))


@query(
    "search_index",
    f"""WITH {DOCS}, {DOC_VECTORS}, {_KNN}""",
)
def search_index(spark, sf_dir):
    """A flat index written, opened again and searched."""
    folder = shared_folder(spark, "flat")
    open_index(spark, folder, "flat").build(_embedded(spark, sf_dir))
    hits = open_index(spark, folder, "flat").search(_benchmark_vectors(spark, sf_dir), 10)
    return hits.withColumn("score", _six("score"))


@query("stored_index", f"WITH {DOCS}, {DOC_VECTORS}, {_KNN}")
def stored_index(spark, sf_dir):
    """An index written by cell and read back; every cell is probed, so it is exact."""
    planes = N.Hyperplanes(64, 3, seed=5)
    folder = shared_folder(spark, "index")
    N.write_index(N.assign_cells(_embedded(spark, sf_dir), planes), folder)
    hits = N.approximate_knn(N.read_index(spark, folder), planes, _benchmark_vectors(spark, sf_dir), 10, 8)
    return hits.withColumn("score", _six("score"))
