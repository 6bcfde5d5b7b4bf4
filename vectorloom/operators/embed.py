"""Applying embedding models to texts on the executors.

A provider turns texts into vectors. It is built by a factory registered under a URI
scheme, once per Python worker, and gets batches sized by the average text length.
"""

from __future__ import annotations

import hashlib
import logging
import math
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vectorloom.functions.batches import released, slices
from vectorloom.operators.lookup import lookup
from vectorloom.session import spread_small

log = logging.getLogger(__name__)

OK, FAILED = "ok", "failed"


class Provider(Protocol):
    """What a model must offer. ``embed`` returns an array of shape (texts, dim)."""

    name: str
    dim: int

    def embed(self, texts: Sequence[str]) -> np.ndarray: ...


Factory = Callable[[str], Provider]
_factories: dict[str, Factory] = {}


def register_provider(scheme: str, factory: Factory) -> None:
    """Use ``factory(name)`` for models called ``scheme://name``."""
    _factories[scheme] = factory


def factory_for(model: str) -> tuple[Factory, str]:
    scheme, found, name = model.partition("://")
    if not found or scheme not in _factories:
        known = ", ".join(sorted(_factories))
        raise ValueError(f"unsupported model: {model}; known schemes: {known}")
    return _factories[scheme], name


class HashingProvider:
    """``hash://<dim>``: signed feature hashing of blank-separated tokens, unit length.

    Deterministic and free of downloads; a text without tokens gives the zero vector.
    Tokens are hashed by array operations and none is kept, so a worker's memory does not
    grow with the vocabulary.
    """

    def __init__(self, name: str):
        self.dim = int(name)
        self.name = f"hash://{self.dim}"

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        coded = [text.encode("utf-8", "replace") for text in texts]
        data = np.frombuffer(b" ".join(coded) + b" " * 5, np.uint8)
        edges = np.flatnonzero(np.diff(_BLANK[data], prepend=np.int8(1)))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        owner = np.searchsorted(np.cumsum([len(text) + 1 for text in coded]), starts, side="right")
        out = np.zeros(len(coded) * self.dim)
        for at in range(0, len(starts), _TOKENS_AT_ONCE):
            part = slice(at, at + _TOKENS_AT_ONCE)
            first, second = md5_words(data, starts[part], lengths[part])
            # the first eight hex digits choose the slot, the ninth the sign
            place = owner[part] * self.dim + (first.byteswap() % np.uint64(self.dim)).astype(np.int64)
            low = int(owner[at]) * self.dim
            sums = np.bincount(place - low, weights=np.where(second & 0x80, -1.0, 1.0))
            out[low : low + len(sums)] += sums
        out = out.reshape(len(coded), self.dim)
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.divide(out, norms, out=np.zeros_like(out), where=norms > 0).astype(np.float32)


# fixed values: blanks in ASCII, and the constants of MD5 (RFC 1321)
_BLANK = np.zeros(256, np.int8)
_BLANK[list(b" \t\n\r\f\v")] = 1
_TOKENS_AT_ONCE = 8192
_ONE_BLOCK = 55  # bytes that fit one block of MD5
_SINES = [np.uint32(int(abs(math.sin(i + 1)) * 2**32)) for i in range(64)]
_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_STEPS = [(1, 0), (5, 1), (3, 5), (7, 0)]
_BEGIN = [np.uint32(x) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]


def md5_words(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first two little-endian words of the MD5 of each piece of ``data``, which has four bytes more than the last.

    A few thousand pieces share each step; pieces beyond one block go to ``hashlib``.
    """
    words = np.ndarray(len(data) - 3, "<u4", data, strides=(1,))
    size = lengths.astype(np.int64)
    message: list[np.ndarray | None] = [None] * 16
    for j in range(min(int(size.max(initial=0)), _ONE_BLOCK) // 4 + 1):
        # few pieces are long: a later word is made for those that reach it
        at = np.flatnonzero(size >= 4 * j) if j else slice(None)
        rest = size[at] - 4 * j
        word = words[np.minimum(starts[at] + 4 * j, len(words) - 1)]
        ends = rest < 4
        bits = (rest[ends] * 8).astype(np.uint32)
        word[ends] = word[ends] & ((np.uint32(1) << bits) - np.uint32(1)) | np.uint32(0x80) << bits
        message[j] = np.zeros(len(size), np.uint32)
        message[j][at] = word
    message[14] = (size * 8).astype(np.uint32)
    a, b, c, d = (np.full(len(size), x) for x in _BEGIN)
    for i in range(64):
        kind = i // 16
        if kind == 0:
            mixed = d ^ (b & (c ^ d))
        elif kind == 1:
            mixed = c ^ (d & (b ^ c))
        elif kind == 2:
            mixed = b ^ c ^ d
        else:
            mixed = c ^ (b | ~d)
        mixed += a
        mixed += _SINES[i]
        by, plus = _STEPS[kind]
        part = message[(by * i + plus) % 16]
        if part is not None:
            mixed += part
        turn = _TURNS[kind][i % 4]
        turned = mixed << np.uint32(turn)
        turned |= mixed >> np.uint32(32 - turn)
        turned += b
        a, b, c, d = d, turned, b, c
    first, second = a + _BEGIN[0], b + _BEGIN[1]
    for i in np.flatnonzero(size > _ONE_BLOCK):
        digest = hashlib.md5(data[starts[i] : starts[i] + size[i]].tobytes()).digest()
        first[i], second[i] = np.frombuffer(digest, "<u4", 2)
    return first, second


register_provider("hash", HashingProvider)


# ---------------------------------------------------------------- batch size


def batch_size(kind: str, text_length: int, limit: int, max_tokens: int = 8192) -> int:
    """Texts per model call, from the average text length (four characters a token)."""
    tokens = text_length // 4
    if kind == "api":
        return min(max_tokens // max(tokens, 1), limit)
    if kind == "gpu":
        return min(8 if tokens > 512 else 16 if tokens > 256 else limit, limit)
    if kind == "cpu":
        return min(2 if tokens > 1024 else 4 if tokens > 512 else 8, limit)
    raise ValueError(f"unknown kind of model: {kind}")


def batch_size_column(kind: str, text_length: Column, limit: int, max_tokens: int = 8192) -> Column:
    """The same rule as a column expression."""
    tokens = F.floor(text_length / 4)
    if kind == "api":
        size = F.floor(F.lit(max_tokens) / F.greatest(tokens, F.lit(1)))
    elif kind == "gpu":
        size = F.when(tokens > 512, 8).when(tokens > 256, 16).otherwise(limit)
    elif kind == "cpu":
        size = F.when(tokens > 1024, 2).when(tokens > 512, 4).otherwise(8)
    else:
        raise ValueError(f"unknown kind of model: {kind}")
    return F.least(size.cast("bigint"), F.lit(limit).cast("bigint"))


def batch_plan(prepared: DataFrame, api_limit: int = 50, gpu_limit: int = 256, cpu_limit: int = 16) -> DataFrame:
    """Average text length per year and the batch size it leads to."""
    total, count = F.sum(F.length("text")), F.count("*")
    lengths = prepared.groupBy("year").agg(count.alias("records"), F.floor(total / count).alias("avg_length"))
    return lengths.select(
        "year",
        "records",
        "avg_length",
        batch_size_column("api", F.col("avg_length"), api_limit).alias("api_batch"),
        batch_size_column("gpu", F.col("avg_length"), gpu_limit).alias("gpu_batch"),
        batch_size_column("cpu", F.col("avg_length"), cpu_limit).alias("cpu_batch"),
    )


# ---------------------------------------------------------------- inference


def embed_texts(
    texts: DataFrame,
    model: str,
    text: str = "text",
    out: str = "embedding",
    kind: str = "gpu",
    limit: int = 256,
    max_tokens: int = 8192,
) -> DataFrame:
    """Add ``out`` (array<float>), ``model``, ``status``, ``error`` and ``batch_no``.

    The text column is used up. A failing model call marks the texts of that call and
    the job goes on. ``batch_no`` is set on the first text of each successful call, so
    that counting it counts calls.
    """
    factory, name = factory_for(model)
    texts = spread_small(texts)
    keep = [c for c in texts.columns if c != text]
    schema = T.StructType([texts.schema[c] for c in keep])
    schema = schema.add(out, T.ArrayType(T.FloatType())).add("model", "string").add("status", "string")
    schema = schema.add("error", "string").add("batch_no", T.IntegerType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        provider, calls = None, 0
        for batch in slices(batches):
            values = batch.column(text).to_pylist()
            mean = sum(len(v) for v in values) // max(len(values), 1)
            step = max(batch_size(kind, mean, limit, max_tokens), 1)
            for start in range(0, len(values), step):
                part = values[start : start + step]
                rows, error = None, None
                try:
                    provider = provider or factory(name)
                    rows = np.asarray(provider.embed(part), dtype=np.float32)
                    if rows.ndim != 2 or len(rows) != len(part):
                        raise ValueError(f"{len(part)} texts gave an array of shape {rows.shape}")
                except Exception as problem:
                    rows, error = None, f"{type(problem).__name__}: {problem}"
                n = len(part)
                columns = [batch.column(c).slice(start, n) for c in keep]
                columns += _result_columns(rows, error, n, model, calls)
                calls += rows is not None
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, out, "model", "status", "error", "batch_no"])

    return texts.mapInArrow(lambda batches: released(run(batches)), schema)


def _result_columns(rows: np.ndarray | None, error: str | None, n: int, model: str, call: int) -> list[pa.Array]:
    if rows is None:
        vectors = pa.nulls(n, pa.list_(pa.float32()))
    else:
        offsets = np.arange(n + 1, dtype=np.int32) * rows.shape[1]
        vectors = pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.ravel(), type=pa.float32()))
    numbers = [call if rows is not None and i == 0 else None for i in range(n)]
    return [
        vectors,
        pa.array([model] * n, pa.string()),
        pa.array([FAILED if rows is None else OK] * n, pa.string()),
        pa.array([error] * n, pa.string()),
        pa.array(numbers, pa.int32()),
    ]


def embed_one(text: str, model: str) -> list[float]:
    """The vector of a single query text, computed on the driver."""
    factory, name = factory_for(model)
    return [float(x) for x in np.asarray(factory(name).embed([text]), dtype=np.float32)[0]]


def embed_from_table(texts: DataFrame, vectors: DataFrame, model: str, key: str = "bibcode") -> DataFrame:
    """``table://``: vectors computed elsewhere, joined by key (one vector per key)."""
    found = lookup(texts, vectors.select(key, "embedding"), key)
    status = F.when(F.col("embedding").isNull(), FAILED).otherwise(OK)
    error = F.when(F.col("embedding").isNull(), F.lit("no stored vector"))
    return found.withColumn("model", F.lit(model)).withColumn("status", status).withColumn("error", error)


def embed_with_models(texts: DataFrame, models: Sequence[str], key: str = "bibcode", text: str = "text") -> DataFrame:
    """Each text through each model, one row per text and model.

    The models are a short list given by the caller; each text is repeated once per
    model and every model is built only where its rows are. A model that is not known is
    left out with a warning, one that fails gives no rows for the texts it fails on.
    """
    frames = []
    for model in models:
        try:
            frames.append(embed_texts(texts.select(key, text), model, text))
        except ValueError as problem:
            log.warning("model left out: %s", problem)
    if not frames:
        schema = T.StructType([texts.schema[key]]).add("model", "string").add("embedding", T.ArrayType(T.FloatType()))
        return texts.sparkSession.createDataFrame([], schema)
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out.where(F.col("status") == OK).select(key, "model", "embedding")
