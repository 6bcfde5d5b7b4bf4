"""The stored term index against scoring in the row."""

import random

import pyarrow as pa
import pytest

from vectorloom.functions.batches import slices
from vectorloom.operators import hybrid as H
from vectorloom.operators.term_index import TermIndex, count_terms

SCHEMA = "bibcode string, title string, text string"


def corpus(size=120, seed=4):
    pick = random.Random(seed)
    words = ["dark", "matter", "star", "Halo", "über", "x1", *[f"w{n}" for n in range(40)]]
    shares = [20, 9, 5, 4, 3, 2, *[1] * 40]
    return [
        (f"b{n:03d}", " ".join(pick.choices(words, shares, k=pick.randint(0, 4))), ", ".join(pick.choices(words, shares, k=pick.randint(0, 30))))
        for n in range(size)
    ]


@pytest.fixture
def indexed(spark, tmp_path):
    def make(rows, runs=1, **settings):
        index = TermIndex(spark, str(tmp_path / f"index-{runs}"), ("title", "text"), **settings)
        for run in range(runs):
            index.append(spark.createDataFrame(rows[run::runs], SCHEMA), run)
        return index

    return make


def scores(frame, name="keyword"):
    return {r["bibcode"]: r[name] for r in frame.collect() if r[name] > 0}


@pytest.mark.parametrize("query", ["dark", "Dark HALO, über x1!", "w1 w2 absent", "absent", "", "dark dark"])
@pytest.mark.parametrize("fields", [["text"], ["title"], ["title", "text"]])
def test_scores_are_those_of_a_scan(spark, indexed, query, fields):
    rows = corpus()
    index = indexed(rows)
    scanned = scores(H.with_bm25(spark.createDataFrame(rows, SCHEMA), query, fields))
    assert scores(index.scores(query, fields)) == pytest.approx(scanned, abs=1e-8)


def test_appending_runs_is_building_anew(indexed):
    rows = corpus()
    whole, parts = indexed(rows), indexed(rows, runs=3)
    for query in ("dark star", "w3 w4 w5 über"):
        assert scores(parts.scores(query)) == pytest.approx(scores(whole.scores(query)), abs=1e-9)
        assert parts.search(query, 7).collect() == whole.search(query, 7).collect()


def test_a_repeated_run_replaces_itself(spark, indexed):
    rows = corpus()
    index = indexed(rows)
    before = scores(index.scores("dark star"))
    index.append(spark.createDataFrame(rows, SCHEMA), 0)
    assert scores(index.scores("dark star")) == before


def test_a_search_reads_only_folders_of_its_terms(indexed):
    index = indexed(corpus())
    found = index.scores("dark star", ["text"])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [bucket" in plan and "In(term, [dark,star])" in plan
    assert "split(" not in plan
    files = {f.split("bucket=")[1].split("/")[0] for f in index._of(index.postings, ["dark"], ["text"]).inputFiles()}
    assert len(files) > 1  # listed before pruning
    read = index._of(index.postings, ["dark"], ["text"]).selectExpr("input_file_name() f").distinct().collect()
    assert len({r["f"].split("bucket=")[1].split("/")[0] for r in read}) == 1


def test_a_term_of_all_documents_fills_several_files(spark, tmp_path):
    rows = [(f"b{n:05d}", None, "the") for n in range(4000)] + [(f"c{n}", None, f"w{n}") for n in range(400)]
    index = TermIndex(spark, str(tmp_path / "hot"), ("text",))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with more rows
    try:
        index.append(spark.createDataFrame(rows, SCHEMA).repartition(4), 1)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    read = index._of(index.postings, ["the"], ["text"]).selectExpr("input_file_name() f").distinct().count()
    assert read > 1
    assert index.scores("the").count() == 4000


def test_awkward_rows(spark, indexed):
    rows = [("a", None, "dark"), ("b", "", ""), ("c", "dark", None), (None, "dark", "dark"), ("d", " ... ", "dark " * 5000), ("e", "dark", "star")]
    index = indexed(rows)
    kept = [r for r in rows if r[0] is not None]
    for fields in (["text"], ["title", "text"]):
        scanned = scores(H.with_bm25(spark.createDataFrame(kept, SCHEMA), "dark", fields))
        assert scores(index.scores("dark", fields)) == pytest.approx(scanned, abs=1e-8)
    with pytest.raises(ValueError, match="not indexed"):
        index.scores("dark", ["abstract"])


def test_empty_folder_and_empty_table(spark, tmp_path):
    index = TermIndex(spark, str(tmp_path / "none"))
    assert index.search("dark").collect() == []
    index.append(spark.createDataFrame([], SCHEMA), 1)
    assert index.search("dark").collect() == []


def test_counts_of_terms(spark):
    rows = [("a", None, "One two, one"), ("b", None, None), ("c", None, "two")]
    counted = count_terms(spark.createDataFrame(rows, SCHEMA), "bibcode", "text").collect()
    assert sorted(map(tuple, counted)) == [("a", "one", 2, 3), ("a", "two", 1, 3), ("c", "two", 1, 1)]


def test_hybrid_ranking_from_the_index(spark, indexed):
    rows = corpus(60)
    index = indexed(rows)
    pick = random.Random(1)
    vectors = [(r[0], [pick.random(), pick.random()] if n % 3 else None) for n, r in enumerate(rows)]
    docs = spark.createDataFrame(rows, SCHEMA).join(spark.createDataFrame(vectors, "bibcode string, embedding array<float>"), "bibcode")
    probe = {"embedding": [1.0, 0.2]}
    scanned = H.hybrid_topk(docs, "dark star", probe, (0.6, 0.4), 15, ["text", "title"]).collect()
    assert H.hybrid_topk(docs, "dark star", probe, (0.6, 0.4), 15, ["text", "title"], index=index).collect() == scanned
    swept = H.weight_sweep(docs, "dark star", probe, k=5, keyword_fields=["text"], index=index)
    assert sorted(swept.collect()) == sorted(H.weight_sweep(docs, "dark star", probe, k=5).collect())


def test_lists_of_words_are_cut_by_bytes():
    lists = pa.array([[f"word{n}"] * 500 for n in range(2000)])
    batch = pa.record_batch([pa.array(range(2000)), lists], ["key", "words"])
    assert batch.nbytes > 8 << 20
    cut = list(slices([batch]))
    assert max(part.nbytes for part in cut) < 9 << 20 and len(cut) > 1
    assert pa.Table.from_batches(cut).equals(pa.Table.from_batches([batch]))
    assert [part.num_rows for part in slices([batch], 1)] == [1] * 2000 and list(slices([batch.slice(0, 0)])) == []
