"""Text preparation, hashes and small text functions."""

import hashlib

import pytest
from pyspark.sql import functions as F

from vectorloom.functions import text as X
from vectorloom.operators import prepare as P

SCHEMA = "bibcode string, title string, abstract string, year int, source_pos int, seq bigint"
PAPER = ("2023ApJ...123..456S", "Test Title", "This is a TEST abstract.", 2023, 0, 0)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def text(spark, row=PAPER, **options):
    settings = P.PrepareSettings(**{"fields": ("title", "abstract"), **options})
    found = P.prepare(frame(spark, row), settings).collect()
    return found[0]["text"] if found else None


def test_joined_fields(spark):
    assert text(spark) == "test title\n\nthis is a test abstract."
    assert text(spark, lowercase=False) == "Test Title\n\nThis is a TEST abstract."
    assert text(spark, delimiter=" | ") == "test title | this is a test abstract."


def test_affixes_keep_their_case(spark):
    assert text(spark, prefix="Paper:", suffix="[END]") == "Paper:\n\ntest title\n\nthis is a test abstract.\n\n[END]"


def test_truncation_cuts_the_joined_text(spark):
    whole = text(spark, suffix="[END]")
    assert text(spark, suffix="[END]", truncate=20) == whole[:20]
    assert text(spark, suffix="[END]", truncate=0) == whole
    emoji = ("b", "\U0001f600" * 5, None, 2020, 0, 0)
    assert text(spark, emoji, truncate=3) == "\U0001f600" * 3


def test_long_text(spark):
    long = ("b", "Title", "word " * 5000, 2020, 0, 0)
    assert len(text(spark, long, truncate=5000)) == 5000
    assert len(text(spark, long)) == len("title\n\n") + 25000


def test_missing_and_empty_fields(spark):
    assert text(spark, ("b", "Test Title", None, 2020, 0, 0)) == "test title"
    assert text(spark, ("b", "Test Title", "", 2020, 0, 0)) == "test title"


def test_rejects(spark):
    rows = [
        (None, "t", "a", 2020, 0, 0),
        ("b1", None, "", 2020, 0, 1),
        ("b2", "same", None, 2020, 0, 2),
        ("b3", "good", None, 2020, 0, 3),
    ]
    settings = P.PrepareSettings(fields=("title", "abstract"), prefix="same")
    reasons = {r["seq"]: r["reason"] for r in P.rejects(frame(spark, *rows), settings).collect()}
    assert reasons == {0: P.MISSING_KEY, 1: P.NO_CONTENT, 2: P.NO_CONTENT}
    assert [r["bibcode"] for r in P.prepare(frame(spark, *rows), settings).collect()] == ["b3"]


def test_fingerprint():
    one, two = P.PrepareSettings(fields=("title",)), P.PrepareSettings(fields=("title",), prefix="x")
    assert len(one.fields_hash) == 16 and one.fields_hash != two.fields_hash
    text_form = "['title']" + "\n\n" + "True" + "0"
    assert one.fields_hash == hashlib.sha256(text_form.encode()).hexdigest()[:16]
    other_fields = P.PrepareSettings(fields=("abstract",))
    assert one.prompt_hash == other_fields.prompt_hash != two.prompt_hash


@pytest.mark.parametrize("value", ["", "   \n\t  ", " Text ", "\x1c a 　", "日本語 Élan", "A" * 1_000_000, "İSTANBUL Σας"])
def test_normalised_hash_matches_python(spark, value):
    got = spark.createDataFrame([(value,)], "t string").select(
        X.normalised_text_hash("t").alias("n"), X.raw_text_hash("t").alias("r")
    )
    row = got.first()
    assert row["n"] == hashlib.sha256(value.strip().lower().encode()).hexdigest()
    assert row["r"] == hashlib.sha256(value.encode()).hexdigest()


def test_model_uris(spark):
    uris = ["openai://text-embedding-3", "hf://org/model", "gguf:///models/x.gguf", "plain-model", "other://m"]
    rows = spark.createDataFrame([(u,) for u in uris], "u string").select(
        X.model_type("u"), X.model_name("u"), X.model_safe_name("u"), X.model_short_name("u")
    )
    got = [tuple(r) for r in rows.collect()]
    assert [r[0] for r in got] == ["openai", "huggingface", "llamacpp", "unknown", "unknown"]
    assert [r[1] for r in got] == ["text-embedding-3", "org/model", "/models/x.gguf", "plain-model", "m"]
    assert got[1][2] == "hf___org_model" and got[1][3] == "model"


def test_small_functions(spark):
    row = spark.createDataFrame([("  one \n\n two\n \t\n", "abcdefgh")], "m string, s string").select(
        X.non_blank_lines("m"), X.token_estimate("s"), X.affix("s", "<", ">"), X.ellipsis("s", 3), X.ellipsis("s", 8)
    ).first()
    assert tuple(row) == (["one", "two"], 2, "<abcdefgh>", "abc...", "abcdefgh")


def test_arrival_order_and_limit(spark):
    rows = [(f"b{p}-{s}", "t", "a", 2020 - p, p, s) for p in range(3) for s in range(5)]
    prepared = P.prepare(frame(spark, *reversed(rows)), P.PrepareSettings(fields=("title",)))
    expected = [r[0] for r in rows][:7]
    assert sorted(r["bibcode"] for r in P.limit_records(prepared, 7).collect()) == sorted(expected)
    for n in (0, 1, 5, 14, 15, 16, 1000):
        kept = sorted(r["bibcode"] for r in P.limit_records(prepared, n).collect())
        assert kept == sorted([r[0] for r in rows][:n])


def test_limit_over_many_buckets_and_equal_arrivals(spark):
    arrivals = [*range(0, 5000, 7), 3_000_000, 3_000_000, 3_000_000, 9 << 40, (9 << 40) + 5, 2_000_000]
    prepared = spark.createDataFrame([(f"b{n:04d}", a) for n, a in enumerate(arrivals)], "bibcode string, arrival bigint").repartition(3)
    ordered = sorted((a, f"b{n:04d}") for n, a in enumerate(arrivals))
    for n in (3, 714, 715, 716, 717, 718, 719, 720, 721):
        kept = [(r["arrival"], r["bibcode"]) for r in P.limit_records(prepared, n).collect()]
        assert sorted(kept) == ordered[:n]


def test_seq_out_of_range_is_an_error(spark):
    bad = frame(spark, ("b", "t", "a", 2020, 0, 1 << 47))
    with pytest.raises(Exception, match="out of range"):
        P.prepare(bad, P.PrepareSettings(fields=("title",))).select(F.max("arrival")).collect()
