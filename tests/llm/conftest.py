import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import pytest  # noqa: E402

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, hash string, `range` int, token string"


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) pairs, with more columns whose names operators use inside."""

    def make(pairs):
        rows = [(i, t, None, "s", None if t is None else len(t), "x", 1, None) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make


@pytest.fixture
def awkward():
    """Nulls, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
    near = " ".join(long.split()[:-40])
    return [
        (5, None), (4, ""), (7, "same text of five words or more here"), (3, "same  text of five words\tor more here"),
        (3, "same  text of five words\tor more here"), (None, "no identifier at all in this row"), (9, long), (8, near),
        (10, "one two"), (11, "One TWO"), (12, " \n\t "), (13, "Ünïcödé 漢字 😀 text's end"), (14, "x" * 5000),
    ]
