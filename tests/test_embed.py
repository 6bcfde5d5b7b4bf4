"""Providers, batch sizes, failing calls."""

import hashlib
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vectorloom.operators import embed as E
from vectorloom.plans import tables as B

# the workers cannot import this file
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Recorder:
    """Gives each text its length and the size of the call it came in."""

    name, dim = "recorder://2", 2

    def embed(self, texts):
        if any("fail" in text for text in texts):
            raise RuntimeError("model is down")
        return np.array([[len(text), len(texts)] for text in texts], dtype=np.float32)


class WrongShape(Recorder):
    def embed(self, texts):
        return np.zeros((1, 2))


def no_model(name):
    raise OSError("cannot load")


E.register_provider("recorder", lambda name: Recorder())
E.register_provider("wrong", lambda name: WrongShape())
E.register_provider("absent", no_model)


def texts(spark, *values):
    rows = [(f"b{i}", v, 2020) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "bibcode string, text string, year int").coalesce(1)


def test_batch_sizes():
    assert E.batch_size("api", 100, 50, 1000) == 40
    assert E.batch_size("api", 2000, 50, 1000) == 2
    assert [E.batch_size("cpu", n, 16) for n in (5000, 3000, 1000)] == [2, 4, 8]
    assert [E.batch_size("gpu", n, 256) for n in (2100, 1100, 100)] == [8, 16, 256]
    assert E.batch_size("gpu", 4000, 4) == 4
    with pytest.raises(ValueError):
        E.batch_size("tpu", 1, 1)


def test_batch_size_column_agrees(spark):
    lengths = [0, 3, 100, 1000, 1027, 2000, 2048, 2052, 5000, 50_000]
    data = spark.createDataFrame([(n,) for n in lengths], "n bigint")
    for kind, limit in (("api", 50), ("gpu", 256), ("cpu", 16), ("cpu", 1)):
        got = [r[0] for r in data.select(E.batch_size_column(kind, F.col("n"), limit, 1000)).collect()]
        assert got == [E.batch_size(kind, n, limit, 1000) for n in lengths]


def test_calls_are_cut_and_other_columns_stay(spark):
    frame = E.embed_texts(texts(spark, *["x" * i for i in range(1, 101)]), "recorder://2", limit=10)
    rows = {r["bibcode"]: r for r in frame.collect()}
    assert len(rows) == 100 and rows["b4"]["embedding"] == [5.0, 10.0] and rows["b4"]["year"] == 2020
    assert frame.agg(F.count("batch_no")).first()[0] == 10
    assert "text" not in frame.columns


def test_failing_calls_are_marked(spark):
    frame = E.embed_texts(texts(spark, "good", "this will fail", "fine"), "recorder://2", limit=1)
    rows = {r["bibcode"]: (r["status"], r["error"], r["embedding"] is None) for r in frame.collect()}
    assert rows == {
        "b0": ("ok", None, False),
        "b1": ("failed", "RuntimeError: model is down", True),
        "b2": ("ok", None, False),
    }
    for model, reason in (("wrong://2", "ValueError"), ("absent://x", "OSError")):
        found = E.embed_texts(texts(spark, "a", "b"), model).collect()
        assert all(r["status"] == "failed" and r["error"].startswith(reason) for r in found)


def test_unknown_models():
    for model in ("plain-model", "nowhere://x"):
        with pytest.raises(ValueError, match="unsupported model"):
            E.factory_for(model)


def test_hashing_provider():
    provider = E.HashingProvider("16")
    out = provider.embed(["alpha beta beta", "alpha  beta\tbeta\n", "", "   "])
    assert out.dtype == np.float32 and out.shape == (4, 16)
    assert np.array_equal(out[0], out[1]) and np.linalg.norm(out[0]) == pytest.approx(1, abs=1e-6)
    assert not out[2:].any()
    assert provider.embed([]).shape == (0, 16)
    assert E.embed_one("alpha beta beta", "hash://16") == [float(x) for x in out[0]]


def test_empty_input(spark):
    assert E.embed_texts(texts(spark, "a").where("1 = 0"), "hash://4").count() == 0


def test_vectors_from_a_table(spark):
    vectors = spark.createDataFrame([("b0", [1.0, 2.0])], "bibcode string, embedding array<float>")
    rows = {r["bibcode"]: (r["status"], r["embedding"]) for r in E.embed_from_table(texts(spark, "a", "b"), vectors, "table://t").collect()}
    assert rows == {"b0": ("ok", [1.0, 2.0]), "b1": ("failed", None)}


def test_a_comparison_goes_on_without_a_model_that_fails(spark, caplog):
    class Half:
        name, dim = "half://2", 2

        def embed(self, texts):
            raise RuntimeError("out of order")

    E.register_provider("half", lambda name: Half())
    texts = spark.createDataFrame([("a", "one two"), ("b", "three")], "bibcode string, text string")
    found = E.embed_with_models(texts, ["nowhere://1", "hash://8", "half://2"])
    assert {(r["bibcode"], r["model"]) for r in found.collect()} == {("a", "hash://8"), ("b", "hash://8")}
    assert "model left out" in caplog.text
    assert E.embed_with_models(texts, ["nowhere://1"]).count() == 0


def test_md5_words_agree_with_the_library():
    tokens = [b"x" * n for n in range(130)] + ["träum".encode(), "星".encode() * 18, b"\xff\x00\x80"]
    lengths = np.array([len(t) for t in tokens])
    data = np.frombuffer(b" ".join(tokens) + b" " * 5, np.uint8)
    first, second = E.md5_words(data, np.cumsum(lengths + 1) - lengths - 1, lengths)
    assert [a.tobytes() + b.tobytes() for a, b in zip(first, second)] == [hashlib.md5(t).digest()[:8] for t in tokens]


def test_hashing_blanks_are_those_of_ascii():
    provider = E.HashingProvider("64")
    one = provider.embed(["\x0b a\tb\r\n\x0cc ", "a b c", " \t", "", "a\x1cb\xa0c"])
    assert (one[0] == one[1]).all() and not one[2].any() and not one[3].any()
    assert (one[4] != 0).sum() == 1


def test_hashing_keeps_no_tokens():
    provider = E.HashingProvider("16")
    provider.embed(["warm up"])
    tracemalloc.start()
    for n in range(20):
        provider.embed([" ".join(f"word{n}x{i}" for i in range(5000))])
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 1 << 20  # a cache of 100,000 tokens held more than 10 MB


def test_python_workers_get_bounded_batches(spark, tmp_path):
    """A task's batch is bounded in bytes, whatever its rows hold."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    spark.range(3000, numPartitions=1).write.parquet(f"{tmp_path}/rows.parquet")
    rows = B.table(spark, str(tmp_path), "rows").select(F.repeat(F.lit("0123456789"), 1000).alias("text"))
    seen = [row["size"] for row in rows.mapInArrow(run, "size bigint").collect()]
    assert sum(seen) > 30_000_000 and max(seen) < 10 << 20
