"""How the store lies on disk: look-ups that prune, two-byte vectors, snapshots of seen texts."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectorloom.operators import embed as E
from vectorloom.operators.prepare import PrepareSettings
from vectorloom.operators.store import VectorStore
from vectorloom.plans import pipeline as L

MODEL = "hash://8"
RESULT = (
    "bibcode string, arrival bigint, text_hash string, embedding array<float>, error string, batch_no int, "
    "status string, year int, model string"
)


def results(spark, count, dim=8, year=2020, first=0):
    pick = np.random.default_rng(count + first)
    vectors = pick.standard_normal((count, dim)).astype(np.float32)
    rows = [
        (f"b{n:06d}", n, hashlib.sha256(str(n).encode()).hexdigest(), [float(x) for x in v], None, 0, "ok", year, MODEL)
        for n, v in zip(range(first, first + count), vectors)
    ]
    return spark.createDataFrame(rows, RESULT)


def scanned(frame):
    """Rows that the file scans of a query gave, after their filters on row groups."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan()
    todo, total = [plan], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif name == "FileSourceScanExec":
            total += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.fixture
def small_groups(spark):
    """Row groups of a few kilobytes, as if the files were large."""
    hadoop = spark._jsc.hadoopConfiguration()
    settings = {"parquet.block.size": "16384", "parquet.page.size": "4096", "parquet.block.size.row.check.min": "50",
                "parquet.page.size.row.check.min": "50"}
    for name, value in settings.items():
        hadoop.set(name, value)
    yield
    for name in settings:
        hadoop.unset(name)


def test_a_look_up_opens_few_row_groups(spark, tmp_path, small_groups):
    store = VectorStore(spark, str(tmp_path / "store"))
    store.write_vectors(results(spark, 6000), 1)
    store.append_catalog(1, "f", "p")
    store.append_hashes(1, "f")
    row = L.get_embedding(store, "b003210", MODEL)
    assert [r["bibcode"] for r in row.collect()] == ["b003210"]
    everything = scanned(store.vectors(model=MODEL))
    assert everything == 6000
    assert scanned(store.vectors(model=MODEL).where("bibcode = 'b003210'")) < 600
    assert scanned(store.catalog().where("bibcode = 'b003210'")) < 1500
    assert L.get_embedding(store, "nowhere", MODEL).collect() == []


def test_seen_texts_are_read_by_prefix_and_row_group(spark, tmp_path, small_groups):
    store = VectorStore(spark, str(tmp_path / "store"))
    for run in (1, 2, 3):
        store.write_vectors(results(spark, 1500, first=1000 * run), run)
        store.append_catalog(run, "f", "p")
        store.append_hashes(run, "f")
    wanted = results(spark, 40, first=1480)
    before = {tuple(r) for r in store.hashes(wanted=wanted).collect()}
    whole = {tuple(r) for r in store.hashes().collect()}
    assert len(whole) == 3500 and len(before) == 40 and before <= whole
    assert scanned(store.hash_rows()) == 4500
    narrow = scanned(store.hash_rows(wanted=wanted))
    assert narrow < 3000

    store.compact_hashes(2)
    assert {tuple(r) for r in store.hashes().collect()} == whole
    assert {tuple(r) for r in store.hashes(wanted=wanted).collect()} == before
    assert {r["text_hash"] for r in store.hashes(before=2).collect()} < {r[0] for r in whole}
    assert store.hashes(before=2).count() == 1500
    base = store.path("hash_base/upto=2")
    opened = store.hash_rows(wanted=wanted).select(F.input_file_name().alias("file")).distinct().collect()
    prefixes = {r["file"].split("prefix=")[1][:2] for r in opened if base in r["file"].replace("file://", "")}
    asked = {r["text_hash"][:2] for r in wanted.collect()}
    assert prefixes <= asked and len(prefixes) < 41


def test_texts_of_a_large_batch_need_no_names(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    store.write_vectors(results(spark, 500), 1)
    store.append_catalog(1, "f", "p")
    store.append_hashes(1, "f")
    store.compact_hashes(1)
    wanted = results(spark, 450, first=300)
    found = store.hashes(wanted=wanted)
    assert found.count() == 200
    assert store.hashes(wanted=wanted.where("1 = 0")).count() == 0


def test_a_snapshot_that_is_not_complete_is_not_read(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    for run in (1, 2):
        store.write_vectors(results(spark, 20, first=15 * run), run)
        store.append_catalog(run, "f", "p")
        store.append_hashes(run, "f")
    store.compact_hashes(1)
    (tmp_path / "store" / "hash_base" / "upto=2").mkdir()
    assert store.hashes().count() == 35


@pytest.mark.parametrize("dim", [64, 384])
def test_two_bytes_a_component(spark, tmp_path, dim):
    store = VectorStore(spark, str(tmp_path / "half"))
    given = results(spark, 3000, dim)
    store.write_vectors(given, 1)
    store.append_catalog(1, "f", "p")
    row = store.footprint().first()
    assert (row["vectors"], row["components"]) == (3000, 3000 * dim)
    assert 2 * row["components"] <= row["bytes"] <= 1.05 * 2 * row["components"]
    kept = {r["bibcode"]: r["embedding"] for r in store.vectors().collect()}
    for r in given.limit(20).collect():
        half = np.array(r["embedding"], np.float32).astype(np.float16).astype(np.float32)
        assert kept[r["bibcode"]] == [float(x) for x in half]
    whole = VectorStore(spark, str(tmp_path / "whole"), half_precision=False)
    whole.write_vectors(given, 1)
    assert {r["bibcode"]: r["embedding"] for r in whole.results().collect()} == {r["bibcode"]: r["embedding"] for r in given.collect()}


def test_null_and_empty_vectors_are_kept(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    rows = results(spark, 2).withColumn("embedding", F.expr("if(arrival = 0, null, array())").cast("array<float>"))
    store.write_vectors(rows, 1)
    assert {r["bibcode"]: r["embedding"] for r in store.results(1).collect()} == {"b000000": None, "b000001": []}


def test_a_run_that_broke_off_does_not_count(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    store.write_vectors(results(spark, 3), 1)
    store.append_catalog(1, "f", "p")
    store.write_vectors(results(spark, 5, first=2), 2)  # and no catalog
    assert store.vectors().count() == 3 and store.results().count() == 8
    assert L.search_similar(store, "any words", MODEL, k=10).count() == 3
    store.append_catalog(2, "f", "p")
    assert store.vectors().count() == 7


def test_ingest_after_compaction_finds_everything_seen(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    settings = PrepareSettings(fields=("title",))
    schema = "bibcode string, title string, year int, source_pos int, seq bigint"
    docs = lambda first, count: spark.createDataFrame([(f"r{n}", f"text {n}", 2020, 0, n) for n in range(first, first + count)], schema)
    made = L.ingest(docs(0, 30), settings, MODEL, store).first()
    assert made["processed_records"] == 30
    store.compact_hashes(1)
    made = L.ingest(docs(20, 30), settings, MODEL, store).first()
    assert (made["processed_records"], made["duplicate_records"]) == (20, 10)
    assert E.embed_one("text 3", MODEL)


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_a_snapshot_of_vectors_spares_the_join(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    for run, first in ((1, 0), (2, 30), (3, 50)):  # each run replaces rows of the one before
        store.write_vectors(results(spark, 60, year=2020 + run % 2, first=first), run)
        store.append_catalog(run, "f", "p")
    live = lambda: {(r["bibcode"], r["run"], r["year"], tuple(r["embedding"])) for r in store.vectors().collect()}
    before = live()
    assert len(before) == 110 and "Join" in plan_of(store.vectors())
    store.compact_vectors(3)
    assert live() == before
    assert "Join" not in plan_of(store.vectors()) and "Join" not in plan_of(store.vectors(2021, MODEL))
    assert store.vectors(2021, MODEL).count() == len([row for row in before if row[2] == 2021])
    assert scanned(store.vectors(2020, MODEL).where("bibcode = 'b000035'")) <= 110
    # a run after the snapshot
    store.write_vectors(results(spark, 20, year=2020, first=100), 4)
    store.append_catalog(4, "f", "p")
    newer = {row[:2] for row in live()}
    assert len(newer) == 120 and ("b000105", 4) in newer and ("b000105", 3) not in newer
    # an incomplete snapshot is not read, a complete one is
    (tmp_path / "store" / "vector_base_info" / "upto=9").mkdir()
    assert {row[:2] for row in live()} == newer
    store.compact_vectors(4)
    assert {row[:2] for row in live()} == newer and "Join" not in plan_of(store.vectors())


def test_a_removed_block_brings_back_what_a_snapshot_left_out(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path / "store"))
    for run in (1, 2):
        store.write_vectors(results(spark, 10, year=2020 + run), run)
        store.append_catalog(run, "f", "p")
    store.compact_vectors(2)
    assert {r["run"] for r in store.vectors().collect()} == {2}
    store.remove_year_model(2022, MODEL, run=2)
    assert {(r["run"], r["year"]) for r in store.vectors().collect()} == {(1, 2021)}
    store.compact_vectors(2)
    assert store.vectors().count() == 10 and "left_anti" not in plan_of(store.vectors()).lower()
