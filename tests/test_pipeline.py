"""Ingest end to end, the store, exports and the stream."""

import json
import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorloom.operators import catalog as C
from vectorloom.operators import embed as E
from vectorloom.operators import export as X
from vectorloom.operators import stats as A
from vectorloom.operators.prepare import PrepareSettings
from vectorloom.operators.store import VectorStore
from vectorloom.plans import pipeline as L
from vectorloom.sources import files as R
from vectorloom.streaming.ingest import distinct_texts, ingest_stream, stream_lines
from vectorloom.streaming.progress import ProgressTable, progress_by_query, progress_rows

SETTINGS = PrepareSettings(fields=("title", "abstract"))
Y2020 = [
    {"bibcode": "2020A", "title": "Stars", "abstract": "On the formation of stars", "author": ["x", "y"], "year": 2020},
    {"bibcode": "2020B", "title": "Planets", "abstract": "On planets", "author": ["z"], "year": 2020},
    {"bibcode": "2020C", "title": "Dust", "abstract": "On cosmic dust", "author": [], "year": 2020},
]
Y2021 = [
    {"bibcode": "2021A", "title": "stars ", "abstract": "On the formation of STARS", "author": ["x"], "year": 2021},
    {"bibcode": "2021B", "title": "Galaxies", "abstract": "On galaxies", "author": ["y"], "year": 2021},
]
Y2021[0]["title"] = "STARS"


def jsonl(records):
    return "".join(json.dumps(r) + "\n" for r in records)


@pytest.fixture
def folder(write):
    write("in/2020.json", jsonl(Y2020))
    return write("in/2021.json", jsonl(Y2021)).rsplit("/", 1)[0]


def load(spark, folder, years=(2020, 2021)):
    records, _ = R.load_years(spark, folder, list(years), ["bibcode", *SETTINGS.fields])
    return R.project_fields(records, SETTINGS.fields, blank_falsy=True)


def store_at(spark, tmp_path, **options):
    return VectorStore(spark, str(tmp_path / "store"), **options)


def entries(store):
    rows = store.catalog().orderBy("year", "row_id").collect()
    return [(r["bibcode"], r["year"], r["row_id"]) for r in rows]


def test_two_years_with_one_repeat(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    counted = L.ingest(load(spark, folder), SETTINGS, "hash://8", store).first().asDict()
    assert counted["total_records"] == 5 and counted["duplicate_records"] == 1
    assert counted["processed_records"] == 4 and counted["failed_records"] == 0 and counted["total_batches"] >= 1
    assert entries(store) == [("2020A", 2020, 0), ("2020B", 2020, 1), ("2020C", 2020, 2), ("2021B", 2021, 0)]
    report = L.run_duplicates(store, 1).first()
    assert (report["bibcode"], report["first_seen_bibcode"], report["first_seen_year"]) == ("2021A", "2020A", 2020)
    manifest = {(r["year"], r["model"]): (r["dim"], r["count"]) for r in store.manifests().collect()}
    assert manifest == {(2020, "hash://8"): (8, 3), (2021, "hash://8"): (8, 1)}
    names = set(store.manifests().columns)
    assert names == {"year", "model", "dim", "count", "fields_hash", "prompt_hash", "created_at", "vector_file"}


def test_year_order_decides_who_is_first(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder, (2021, 2020)), SETTINGS, "hash://8", store)
    assert {e[0] for e in entries(store)} == {"2021A", "2021B", "2020B", "2020C"}


def test_without_dedup_and_within_years(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    off = L.ingest(load(spark, folder), SETTINGS, "hash://8", store, L.IngestOptions(dedup=False)).first()
    assert off["processed_records"] == 5 and off["duplicate_records"] == 0
    other = VectorStore(spark, str(tmp_path / "other"))
    options = L.IngestOptions(cross_year=False)
    for expected in (5, 0):
        assert L.ingest(load(spark, folder), SETTINGS, "hash://8", other, options).first()["processed_records"] == expected


def test_affixes_reach_every_text(spark, folder, tmp_path):
    settings = PrepareSettings(fields=("title",), prefix="Paper: ", suffix=" [END]", delimiter="")
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder), settings, "hash://8", store, L.IngestOptions(dedup=False))
    texts = [r["text"] for r in spark.read.parquet(store.path("prepared/run=1")).collect()]
    assert len(texts) == 5 and all(t.startswith("Paper: ") and t.endswith(" [END]") for t in texts)


def test_second_run_finds_everything_seen(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder), SETTINGS, "hash://8", store)
    again = L.ingest(load(spark, folder), SETTINGS, "hash://8", store).first()
    assert again["processed_records"] == 0 and again["duplicate_records"] == 5
    assert len(entries(store)) == 4


def test_resume_skips_finished_years(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder, [2020]), SETTINGS, "hash://8", store)
    more = L.ingest(load(spark, folder), SETTINGS, "hash://8", store, L.IngestOptions(resume=True)).first()
    assert more["loaded_records"] == 2 and more["processed_records"] == 1


def test_repeating_a_run_changes_nothing(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    for _ in range(2):
        L.ingest(load(spark, folder), SETTINGS, "hash://8", store, run=1)
    assert len(entries(store)) == 4 and store.vectors().count() == 4 and store.hashes().count() == 4


def test_repeating_a_run_leaves_nothing_of_the_first_attempt(spark, folder, tmp_path):
    calls = tmp_path / "down"
    calls.write_text("")

    class Recovering:
        name, dim = "recovering://1", 1

        def embed(self, texts):
            if os.path.exists(name_of_flag):
                raise RuntimeError("down")
            return np.ones((len(texts), 1))

    name_of_flag = str(calls)
    E.register_provider("recovering", lambda name: Recovering())
    store = store_at(spark, tmp_path)
    assert L.ingest(load(spark, folder), SETTINGS, "recovering://1", store, run=1).first()["failed_records"] == 4
    calls.rename(tmp_path / "up")
    second = L.ingest(load(spark, folder), SETTINGS, "recovering://1", store, run=1).first()
    assert (second["failed_records"], second["processed_records"]) == (0, 4)
    assert store.results(1).count() == 4


def test_stream_and_batch_runs_keep_apart(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder, [2020]), SETTINGS, "hash://8", store)
    assert store.run_of_batch("a", 0) == 2 and store.run_of_batch("b", 0) == 3
    assert store.run_of_batch("a", 0) == 2 and store.next_run() == 4


def test_failing_model(spark, folder, tmp_path):
    class Broken:
        name, dim = "broken://1", 1

        def embed(self, texts):
            raise RuntimeError("no")

    E.register_provider("broken", lambda name: Broken())
    store = store_at(spark, tmp_path)
    counted = L.ingest(load(spark, folder), SETTINGS, "broken://1", store).first()
    assert counted["failed_records"] == 4 and counted["processed_records"] == 0
    assert store.vectors().count() == 0 and store.hashes().count() == 0
    # texts of failed records are not marked as seen
    assert L.ingest(load(spark, folder), SETTINGS, "hash://8", store).first()["processed_records"] == 4


def test_unusable_records_are_reported(spark, write, tmp_path):
    bad = [{"title": "no key"}, {"bibcode": "e", "title": ""}, {"bibcode": "g", "title": "Good"}]
    folder = write("in/2020.json", jsonl(bad)).rsplit("/", 1)[0]
    store = store_at(spark, tmp_path)
    counted = L.ingest(load(spark, folder, [2020]), SETTINGS, "hash://8", store).first()
    assert (counted["loaded_records"], counted["skipped_records"], counted["processed_records"]) == (3, 2, 1)
    X.write_rejects(L.run_rejects(store, 1), str(tmp_path / "rejects"))
    lines = sorted(r["value"] for r in spark.read.text(str(tmp_path / "rejects")).collect())
    assert lines == ["e\tno content", "unknown\tmissing bibcode"]


def test_search_and_lookup(spark, folder, tmp_path):
    store = store_at(spark, tmp_path, half_precision=False)
    L.ingest(load(spark, folder), SETTINGS, "hash://64", store)
    best = L.search_similar(store, "stars on the formation of stars", "hash://64", k=2).collect()
    assert best[0]["bibcode"] == "2020A" and best[0]["rank"] == 1 and best[0]["score"] > 0.9
    in_year = L.search_similar(store, "stars", "hash://64", year=2021, k=5)
    assert [r["bibcode"] for r in in_year.collect()] == ["2021B"]
    assert L.search_similar(store, "stars", "hash://64", year=1999).count() == 0
    row = L.get_embedding(store, "2020B", "hash://64").first()
    assert row["embedding"] == E.embed_one("planets\n\non planets", "hash://64")
    assert L.get_embedding(store, "missing", "hash://64").count() == 0
    plan = store.vectors(2020, "hash://64")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(status" in plan.replace("\n", "") and "year" in plan.split("PartitionFilters")[1]


@pytest.mark.parametrize("kind, options", [("flat", {}), ("ivf", {"cells": 2, "probes": 2}), ("hnsw", {"bits": 2, "probes": 4})])
def test_stored_indexes(spark, folder, tmp_path, kind, options):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder), SETTINGS, "hash://64", store)
    L.build_index(store, "hash://64", 2020, kind, **options)
    again = L.index_of(store, "hash://64", 2020, kind, **options)
    assert os.path.isdir(store.path(f"indexes/index_hash___64_2020_{kind}"))
    found = L.search_index(again, "stars on the formation of stars", "hash://64", k=5).collect()
    expected = L.search_similar(store, "stars on the formation of stars", "hash://64", 2020, k=5).collect()
    assert [(r["rank"], r["bibcode"]) for r in found] == [(r["rank"], r["bibcode"]) for r in expected]
    assert len(found) == 3


def test_unknown_index_type(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported index type"):
        L.index_of(store_at(spark, tmp_path), "hash://8", 2020, "pq")


def test_half_precision_storage(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder), SETTINGS, "hash://8", store)
    row = store.vectors().where("bibcode = '2020B'").first()
    exact = np.array(E.embed_one("planets\n\non planets", "hash://8"), np.float32)
    assert row["embedding"] == [float(x) for x in exact.astype(np.float16).astype(np.float32)]
    A.storage_footprint(store.vectors()).first()["bytes_per_vector"] == 16


def test_new_versions_replace_and_blocks_are_removed(spark, write, tmp_path):
    store = store_at(spark, tmp_path)
    for run, year in ((1, 2020), (2, 2021)):
        name = f"in{run}/{year}.json"
        folder = write(name, jsonl([{"bibcode": "same", "title": f"text {year}"}, {"bibcode": f"own{year}", "title": f"x {year}"}]))
        L.ingest(load(spark, folder.rsplit("/", 1)[0], [year]), SETTINGS, "hash://8", store, run=run)
    assert entries(store) == [("own2020", 2020, 1), ("same", 2021, 0), ("own2021", 2021, 1)]
    assert L.get_embedding(store, "same", "hash://8").select("year").collect() == [(2021,)]
    store.compact_catalog(1)
    assert os.path.isdir(store.path("catalog_base/upto=1"))
    assert entries(store) == [("own2020", 2020, 1), ("same", 2021, 0), ("own2021", 2021, 1)]
    assert store.remove_year_model(2021, "hash://8", run=2)
    assert entries(store) == [("same", 2020, 0), ("own2020", 2020, 1)]
    assert not store.remove_year_model(1999, "hash://8", run=2)
    assert store.vectors(2021).count() == 0 and store.manifests().count() == 1
    assert store.next_run() == 3


def test_only_the_latest_vector_of_a_record_is_found(spark, write, tmp_path):
    store = store_at(spark, tmp_path)
    for run, title in ((1, "old words"), (2, "new words")):
        folder = write(f"in{run}/2020.json", jsonl([{"bibcode": "a", "title": title}, {"bibcode": f"b{run}", "title": f"b {run}"}]))
        L.ingest(load(spark, folder.rsplit("/", 1)[0], [2020]), SETTINGS, "hash://8", store, run=run)
    found = {(r["bibcode"], r["run"]) for r in store.vectors().collect()}
    assert found == {("a", 2), ("b1", 1), ("b2", 2)}
    assert store.results().count() == 4


def test_a_replaced_vector_is_back_when_the_newer_block_is_removed(spark, write, tmp_path):
    store = store_at(spark, tmp_path)
    for run, year in ((1, 2020), (2, 2021)):
        folder = write(f"in{run}/{year}.json", jsonl([{"bibcode": "same", "title": f"text {year}"}]))
        L.ingest(load(spark, folder.rsplit("/", 1)[0], [year]), SETTINGS, "hash://8", store, run=run)
    assert [r["year"] for r in store.vectors().collect()] == [2021]
    store.remove_year_model(2021, "hash://8", run=2)
    assert [r["year"] for r in store.vectors().collect()] == [2020]


def test_seen_texts_count_per_model_and_fields(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    titles = PrepareSettings(fields=("title",))
    for settings, model in ((SETTINGS, "hash://8"), (SETTINGS, "hash://16"), (titles, "hash://8")):
        made = L.ingest(load(spark, folder), settings, model, store).first()
        assert made["processed_records"] == 4
    again = L.ingest(load(spark, folder), SETTINGS, "hash://16", store).first()
    assert again["processed_records"] == 0 and again["duplicate_records"] == 5
    assert {r["first_seen_bibcode"] for r in L.run_duplicates(store, 4).collect()} >= {"2020A", "2021B"}


def test_a_removed_block_can_be_stored_again(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder), SETTINGS, "hash://8", store)
    store.remove_year_model(2020, "hash://8", run=1)
    again = L.ingest(load(spark, folder), SETTINGS, "hash://8", store).first()
    # 2021A repeats a text of 2020, 2021B is still stored
    assert again["processed_records"] == 3 and again["duplicate_records"] == 2
    assert {r["bibcode"] for r in store.vectors().collect()} == {"2020A", "2020B", "2020C", "2021B"}


def test_append_continues_row_ids(spark, write, tmp_path):
    store = store_at(spark, tmp_path)
    for run in (1, 2):
        folder = write(f"in{run}/2020.json", jsonl([{"bibcode": f"r{run}-{i}", "title": f"t {run} {i}"} for i in range(3)]))
        L.ingest(load(spark, folder.rsplit("/", 1)[0], [2020]), SETTINGS, "hash://8", store, run=run)
    assert [e[0] for e in entries(store)] == ["r1-0", "r1-1", "r1-2", "r2-0", "r2-1", "r2-2"]
    assert [e[2] for e in entries(store)] == list(range(6))
    assert store.manifests().first()["count"] == 6


def test_catalog_figures(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    L.ingest(load(spark, folder), SETTINGS, "hash://8", store)
    catalog = store.catalog()
    assert tuple(C.index_stats(catalog).first()) == (4, 4, 2)
    assert [r["label"] for r in C.year_model_counts(catalog).collect()] == ["2020_hash://8", "2021_hash://8"]
    assert [r["year"] for r in C.list_years(catalog).collect()] == [2020, 2021]
    assert [r["model"] for r in C.list_models(catalog).collect()] == ["hash://8"]
    assert C.sample_entries(catalog, 3).count() == 3
    assert C.remove_year_model(catalog, 2020, "hash://8").count() == 1


# ---------------------------------------------------------------- exports


def vectors(spark, count=25, dim=3):
    rows = [(f"b{i:03d}", i * 10, [float(i), i / 2, -1.0], f'say "{i}",\nplease') for i in range(count)]
    return spark.createDataFrame(rows, "bibcode string, arrival bigint, embedding array<float>, text string").repartition(3)


def test_chunks(spark):
    chunked = X.assign_chunks(vectors(spark), 10)
    rows = {r["chunk"]: r for r in X.chunk_metadata(chunked).collect()}
    assert [rows[c]["papers_in_chunk"] for c in range(3)] == [10, 10, 5]
    assert (rows[1]["first_bibcode"], rows[1]["last_bibcode"], rows[1]["embedding_dimension"]) == ("b010", "b019", 3)
    assert rows[2]["bibcode_to_index"] == {f"b{20 + i:03d}": i for i in range(5)}
    repeated = vectors(spark, 4).withColumn("bibcode", F.lit("same"))
    assert X.chunk_metadata(X.assign_chunks(repeated, 10)).first()["bibcode_to_index"] == {"same": 3}


def test_json_export(spark, tmp_path):
    chunked = X.assign_chunks(vectors(spark), 10)
    documents = X.chunk_documents(chunked, "org/m", "huggingface", ["title"], [2020], subset_limit=25)
    X.write_json(chunked, str(tmp_path / "out"), documents, with_text=True)
    back = spark.read.json(str(tmp_path / "out" / "embeddings"))
    assert back.count() == 25 and back.where("chunk = 1").count() == 10
    assert back.where("bibcode = 'b003'").first()["text"] == 'say "3",\nplease'
    info = spark.read.json(str(tmp_path / "out" / "metadata")).where("chunk = 2").first()
    assert info["processing_info"]["papers_in_chunk"] == 5 and info["processing_info"]["subset_description"] == "25_papers"
    assert info["model_info"]["model_name"] == "org/m" and info["data_mapping"]["first_bibcode"] == "b020"


def test_csv_export(spark, tmp_path):
    X.write_csv(X.assign_chunks(vectors(spark), 10), str(tmp_path / "csv"), 3, with_text=True)
    back = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "csv"))
    row = back.where("bibcode = 'b004'").first()
    assert [float(row[f"dim_{i}"]) for i in range(3)] == [4.0, 2.0, -1.0] and row["text"] == 'say "4",\nplease'


def test_search_documents_in_files_of_bounded_size(spark, tmp_path):
    documents = X.search_documents(vectors(spark).coalesce(1), "m", ["title", "abstract"], with_text=True)
    X.write_search_documents(documents, str(tmp_path / "docs"), rows_per_file=10)
    parts = [f for f in os.listdir(tmp_path / "docs") if f.startswith("part-")]
    assert len(parts) == 3
    with open(tmp_path / "docs" / sorted(parts)[0]) as file:
        first = json.loads(file.readline())
    assert set(first) == {"bibcode", "embedding_vector", "embedding_model", "embedding_dim", "fields_used", "embedded_text"}
    assert first["embedding_dim"] == 3 and first["fields_used"] == ["title", "abstract"]


def test_id_lists_keep_blocks_apart(spark, tmp_path):
    rows = [(f"b{i:03d}", 2020 + i % 2, "org/m", i // 2) for i in range(25)]
    ids = spark.createDataFrame(rows, "bibcode string, year int, model string, row_id bigint").repartition(3)
    X.write_id_list(ids, str(tmp_path / "ids"))
    for year in (2020, 2021):
        folder = tmp_path / "ids" / f"year={year}" / "model=org_m"
        parts = sorted(f for f in os.listdir(folder) if f.startswith("part-"))
        lines = [line for p in parts for line in open(folder / p).read().split()]
        assert lines == [f"b{i:03d}" for i in range(25) if 2020 + i % 2 == year]


def test_summary_and_prepared_texts(spark, tmp_path):
    statuses = spark.createDataFrame([("ok", 2020)] * 2 + [("rejected", 2022)], "status string, year int")
    X.write_summary(A.processing_summary(statuses), str(tmp_path / "summary"))
    summary = spark.read.json(str(tmp_path / "summary")).first()
    assert (summary["success_rate"], summary["year_range"], summary["chunks_created"]) == ("66.67%", "2020-2022", 1)
    nothing = A.processing_summary(statuses.where("1 = 0")).first()
    assert nothing["success_rate"] == "N/A" and nothing["year_range"] == "None"
    X.write_prepared(vectors(spark), str(tmp_path / "prepared"))
    assert spark.read.parquet(str(tmp_path / "prepared")).count() == 25


def test_whole_run_summary(spark, tmp_path):
    statuses = spark.createDataFrame([("ok", 2020)] * 2 + [("rejected", 2022)], "status string, year int")
    row = A.run_summary(
        statuses, "20260102", "2026-01-02 03:04:05 UTC", "org/m", "huggingface", 384, ["title", "abstract"], 32, export_format="JSON + CSV"
    )
    X.write_summary(row, str(tmp_path / "run"))
    [file] = [f for f in os.listdir(tmp_path / "run") if f.startswith("part-")]
    assert json.loads((tmp_path / "run" / file).read_text()) == {
        "processing_summary": {
            "run_id": "20260102", "completion_time": "2026-01-02 03:04:05 UTC", "total_papers_processed": 2,
            "total_papers_skipped": 1, "success_rate": "66.67%", "chunks_created": 1, "subset_description": "all",
        },
        "model_configuration": {
            "model_name": "org/m", "model_type": "huggingface", "embedding_dimension": 384, "batch_size": 32, "device": "cpu",
        },
        "text_processing": {
            "fields_used": ["title", "abstract"], "field_combination": "title + abstract", "preprocessing_applied": True,
        },
        "data_sources": {"years_processed": [2020, 2022], "year_range": "2020-2022"},
        "output_format": {
            "export_format": "JSON + CSV", "files_created": "Multiple chunk files in json_csv_format",
            "bibcode_mapping": "Included in each file", "metadata_included": "Full metadata in each chunk",
        },
        "file_description": {
            "embeddings_chunks": "embeddings_chunk_XXXX.json", "skipped_papers": "skipped_bibcodes.txt (if any)",
            "this_summary": "processing_summary.json",
        },
    }


def test_run_log_and_throughput(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    for years in ([2020], [2020, 2021]):
        L.ingest(load(spark, folder, years), SETTINGS, "hash://8", store)
    log = {r["run"]: r for r in store.run_log().collect()}
    assert [log[n]["processed_records"] for n in (1, 2)] == [3, 1] and log[2]["loaded_records"] == 5
    assert all(r["seconds"] > 0 and r["ended_at"] > r["started_at"] for r in log.values())
    rows = {r["run"]: r for r in A.run_throughput(store.run_log(), planned=10).collect()}
    assert rows[1]["records_per_second"] == pytest.approx(3 / log[1]["seconds"])
    assert [rows[n]["records_done"] for n in (1, 2)] == [3, 4]
    assert rows[2]["hours_left"] == pytest.approx(6 / rows[2]["records_per_second"] / 3600)
    figures = spark.createDataFrame([(1, 100, 4.0), (2, 0, 0.0)], "run bigint, processed_records bigint, seconds double")
    found = {r["run"]: r for r in A.run_throughput(figures, 200).collect()}
    assert found[1]["records_per_second"] == 25 and found[1]["hours_left"] == pytest.approx(4 / 3600)
    assert found[2]["records_per_second"] == 0 and found[2]["hours_left"] is None


def test_estimate_of_seen_texts_from_sketches(spark, folder, tmp_path):
    store = store_at(spark, tmp_path)
    assert store.hash_estimate().first()[0] == 0
    L.ingest(load(spark, folder, [2020]), SETTINGS, "hash://8", store)
    L.ingest(load(spark, folder), SETTINGS, "hash://8", store)
    L.ingest(load(spark, folder), SETTINGS, "hash://16", store)
    assert store.hash_estimate("hash://8").first()[0] == 4
    assert store.hash_estimate().first()[0] == 4  # the same texts under both models
    assert all("hash_sketches" in file for file in store.hash_estimate().inputFiles())


# ---------------------------------------------------------------- stream


def run_stream(spark, folder, store, checkpoint, files=1):
    lines = stream_lines(spark, f"{folder}/*.json", files)
    writer = ingest_stream(lines, SETTINGS, "hash://8", store, str(checkpoint))
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def test_stream_equals_batch_and_restarts_without_rework(spark, folder, write, tmp_path):
    store, checkpoint = store_at(spark, tmp_path), tmp_path / "checkpoint"
    query = run_stream(spark, folder, store, checkpoint)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 5
    batch = VectorStore(spark, str(tmp_path / "batch"))
    L.ingest(load(spark, folder), SETTINGS, "hash://8", batch)
    assert entries(store) == entries(batch)
    before = store.results().count()
    run_stream(spark, folder, store, checkpoint)
    assert store.results().count() == before
    write("in/2022.json", jsonl([{"bibcode": "2022A", "title": "Stars", "abstract": "On the formation of stars"},
                                 {"bibcode": "2022B", "title": "New", "abstract": "Something else"}]))
    run_stream(spark, folder, store, checkpoint)
    assert entries(store)[-1] == ("2022B", 2022, 0) and len(entries(store)) == 5


def test_stream_keeps_unread_lines(spark, write, tmp_path):
    store = store_at(spark, tmp_path)
    write("in/2020-part2.json", jsonl(Y2020) + "{broken\n")
    folder = write("in/part-00012-x.json", jsonl(Y2021)).rsplit("/", 1)[0]
    run_stream(spark, folder, store, tmp_path / "checkpoint", files=10)
    assert {e[1] for e in entries(store)} == {2020} and len(entries(store)) == 3
    reasons = [r["reason"] for r in store.bad_lines().orderBy("reason").collect()]
    assert reasons == ["no year in the file name"] * 2 + ["not a JSON object"]


def test_distinct_texts_of_a_stream(spark, folder, tmp_path):
    texts = distinct_texts(stream_lines(spark, f"{folder}/*.json", 1).select("value"), SETTINGS)
    query = texts.writeStream.format("parquet").option("path", str(tmp_path / "out"))
    query = query.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_progress_rows(spark, folder, tmp_path):
    listener = ProgressTable(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        run_stream(spark, folder, store_at(spark, tmp_path), str(tmp_path / "progress-checkpoint"))
        for _ in range(100):  # the listener is told a little later
            if (tmp_path / "progress").exists() and progress_rows(spark, str(tmp_path / "progress")).count() >= 2:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    rows = progress_rows(spark, str(tmp_path / "progress"))
    found = progress_by_query(rows).first()
    # rows are counted again by each action of a batch, so at least once a line
    assert found["batches"] == 2 and found["rows"] >= 5 and found["rows_per_second"] > 0
    assert rows.where("batch_millis > 0 AND time IS NOT NULL AND durations LIKE '%addBatch%'").count() == rows.count()
