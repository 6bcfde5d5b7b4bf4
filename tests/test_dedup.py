"""First-seen deduplication, frequent texts, numbering and top-k in groups."""

import random

import pytest
from pyspark.sql import functions as F

from vectorloom.operators import dedup as D
from vectorloom.operators.lookup import lookup
from vectorloom.operators.positions import rows_before, top_per_group

SCHEMA = "bibcode string, text string, year int, arrival bigint"


def hashed(spark, rows):
    return D.with_hash(spark.createDataFrame(rows, SCHEMA))


BATCH = [
    ("2020A", "First paper", 2020, 0),
    ("2020B", "Second paper", 2020, 1),
    ("2021A", " FIRST paper\n", 2021, 2),
    ("2021B", "Third paper", 2021, 3),
    ("2021C", "Second paper", 2021, 4),
]


def brute_force(rows, cross_year=True):
    seen, out = {}, {}
    for bibcode, text, year, arrival in sorted(rows, key=lambda r: r[3]):
        key = (text.strip().lower(), None if cross_year else year)
        first = seen.setdefault(key, (bibcode, year))
        out[arrival] = (first, first != (bibcode, year) or out.get(arrival) is not None)
    return {a: (first, first != own) for a, (first, _) in out.items() for own in [_own(rows, a)]}


def _own(rows, arrival):
    return next((b, y) for b, _, y, a in rows if a == arrival)


def test_batch_of_five(spark):
    rows = hashed(spark, BATCH)
    assert sorted(r["bibcode"] for r in D.unique_rows(rows).collect()) == ["2020A", "2020B", "2021B"]
    report = {r["bibcode"]: (r["first_seen_bibcode"], r["first_seen_year"]) for r in D.duplicates(rows).collect()}
    assert report == {"2021A": ("2020A", 2020), "2021C": ("2020B", 2020)}
    assert D.store_stats(D.first_seen(rows)).first()[0] == 3


def test_empty_and_blank_texts_are_one_text(spark):
    rows = hashed(spark, [("a", "", 2020, 0), ("b", "   \n\t  ", 2020, 1)])
    assert [r["bibcode"] for r in D.unique_rows(rows).collect()] == ["a"]


def test_same_id_in_two_years(spark):
    rows = hashed(spark, [("a", "one", 2020, 0), ("a", "one", 2021, 1), ("a", "two", 2021, 2)])
    assert [(r["year"], r["text"]) for r in D.unique_rows(rows).orderBy("arrival").collect()] == [(2020, "one"), (2021, "two")]


def test_no_rows(spark):
    rows = hashed(spark, [])
    assert D.unique_rows(rows).count() == 0 and D.duplicates(rows).count() == 0


def test_store_from_earlier_runs(spark):
    store = D.first_seen(hashed(spark, [("old", "second PAPER", 2019, 0)]))
    rows = hashed(spark, BATCH)
    assert sorted(r["bibcode"] for r in D.unique_rows(rows, store).collect()) == ["2020A", "2021B"]
    report = {r["bibcode"]: r["first_seen_bibcode"] for r in D.duplicates(rows, store).collect()}
    assert report == {"2020B": "old", "2021A": "2020A", "2021C": "old"}
    found = {r["bibcode"]: r["first_seen_bibcode"] for r in D.find_in_store(rows, store).collect()}
    assert found["2021C"] == "old" and found["2021B"] is None


@pytest.mark.parametrize("cross_year", [True, False])
@pytest.mark.parametrize("hot_rows", [5, 1_000_000])
def test_one_text_on_a_third_of_all_rows(spark, cross_year, hot_rows):
    pick = random.Random(3)
    rows = [
        (f"b{i}", "hot text" if i % 3 == 0 else f"text {pick.randrange(120)}", 2000 + pick.randrange(4), i)
        for i in range(600)
    ]
    pick.shuffle(rows)
    expected = brute_force(rows, cross_year)
    frame = hashed(spark, rows)
    tagged = D.annotate(frame, cross_year=cross_year, hot_rows=hot_rows).collect()
    got = {r["arrival"]: ((r["first_seen_bibcode"], r["first_seen_year"]), r["is_duplicate"]) for r in tagged}
    assert got == expected and len(tagged) == 600
    unique = {r["arrival"] for r in D.unique_rows(frame, cross_year=cross_year).collect()}
    assert unique == {a for a, (_, repeated) in expected.items() if not repeated}
    again = D.unique_rows(D.unique_rows(frame, cross_year=cross_year), cross_year=cross_year)
    assert again.count() == len(unique)


def test_lookup_keeps_every_row(spark):
    rows = spark.createDataFrame([("k", i) for i in range(50)] + [(None, 99), ("x", 100), ("z", 101)], "key string, n int")
    table = spark.createDataFrame([("k", 1), ("x", 2), ("y", 3)], "key string, value int")
    for hot in (10, 1000):
        got = sorted((r["n"], r["value"]) for r in lookup(rows, table, "key", hot).collect())
        assert got == [(i, 1) for i in range(50)] + [(99, None), (100, 2), (101, None)]


@pytest.mark.parametrize("width", [1, 3, 1 << 20])
def test_rows_before(spark, width):
    pick = random.Random(1)
    values = pick.sample(range(100_000), 300)
    data = [("big" if i % 3 else None, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(data, "g string, v bigint")
    got = {(r["g"], r["v"]): r["at"] for r in rows_before(frame, ["g"], "v", "at", width).collect()}
    expected = {}
    for group in ("big", None):
        for at, value in enumerate(sorted(v for g, v in data if g == group)):
            expected[(group, value)] = at
    assert got == expected
    overall = {r["v"]: r["at"] for r in rows_before(frame, [], "v", "at", width).collect()}
    assert overall == {v: i for i, v in enumerate(sorted(values))}


def test_top_per_group(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v")).repartition(7)
    got = top_per_group(frame, ["g"], [F.desc("v")], 4, salts=3)
    assert sorted((r["g"], r["rank"], r["v"]) for r in got.collect()) == [
        (g, i + 1, v) for g in range(3) for i, v in enumerate([x for x in range(999, -1, -1) if x % 3 == g][:4])
    ]


def test_no_shuffle_of_texts_by_hash(spark):
    """Only narrow columns meet by text; whole rows are joined on their own arrival."""
    plan = D.unique_rows(hashed(spark, BATCH))._jdf.queryExecution().executedPlan().toString()
    hashes = [line for line in plan.split("\n") if "hashpartitioning(text_hash" in line]
    assert hashes and "CartesianProduct" not in plan and "NestedLoop" not in plan
