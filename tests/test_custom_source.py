"""Record sources by one interface."""

import json

import pytest

from vectorloom.operators.prepare import PrepareSettings
from vectorloom.operators.store import VectorStore
from vectorloom.plans import pipeline as L
from vectorloom.sources.custom import PLACE, load_records, open_source, register_source


class Made:
    """A source of the user's own: no file at all."""

    def __init__(self, path, count="3"):
        self.path, self.count = path, int(count)

    def load(self, spark, fields):
        rows = [(f"{self.path}-{n}", f"title {n % 2}", 7.5, 2020 + n % 2, n) for n in range(self.count)]
        made = spark.createDataFrame(rows, "bibcode string, title string, size double, year int, seq bigint")
        return made.selectExpr("*", "0 AS source_pos", "'x' AS more")


def test_a_source_of_ones_own(spark, tmp_path):
    register_source("made", Made)
    records = load_records(spark, "made:paper?count=4", ["title", "size"])
    assert records.columns == [*PLACE, "title", "size"] and dict(records.dtypes)["size"] == "string"
    assert records.count() == 4
    store = VectorStore(spark, str(tmp_path / "store"))
    made = L.ingest(records, PrepareSettings(fields=("title", "size")), "hash://8", store).first()
    assert (made["processed_records"], made["duplicate_records"]) == (2, 2)
    assert {r["bibcode"] for r in store.catalog().collect()} == {"paper-0", "paper-1"}


def test_missing_columns_and_unknown_schemes_are_errors(spark):
    class Bare:
        def load(self, spark, fields):
            return spark.createDataFrame([("a",)], "bibcode string")

    with pytest.raises(ValueError, match="Bare gave no column year, source_pos, seq, title"):
        load_records(spark, Bare(), ["title"])
    with pytest.raises(ValueError, match="unsupported source"):
        open_source("nowhere:/x")
    with pytest.raises(ValueError, match="named like the place"):
        load_records(spark, Made("x"), ["seq"])


def test_year_files(spark, write):
    for year in (2020, 2021, 2022):
        folder = write(f"in/{year}.jsonl", json.dumps({"bibcode": f"b{year}", "title": f"t{year}"}) + "\n").rsplit("/", 1)[0]
    found = load_records(spark, f"years:{folder}?years=2020,2022", ["title"])
    assert sorted(tuple(r)[:2] + (r["title"],) for r in found.collect()) == [("b2020", 2020, "t2020"), ("b2022", 2022, "t2022")]
    assert load_records(spark, f"years:{folder}", ["title"]).count() == 3


def test_tables(spark, tmp_path):
    rows = [(5, "five", 2001), (3, "three", 2000), (4, None, 2000)]
    spark.createDataFrame(rows, "doc_id bigint, text string, y int").write.parquet(str(tmp_path / "docs"))
    found = load_records(spark, f"table:{tmp_path}/docs?key=doc_id&order=doc_id&year=y", ["text"])
    assert sorted(map(tuple, found.collect())) == [("3", 2000, 2000, 3, "three"), ("4", 2000, 2000, 4, None), ("5", 2001, 2001, 5, "five")]
    one = load_records(spark, f"table:{tmp_path}/docs?key=doc_id&order=doc_id&year=1999", ["text"])
    assert {r["year"] for r in one.collect()} == {1999}
