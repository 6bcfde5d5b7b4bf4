"""Document fingerprints from content-defined chunks.

A text's UTF-8 bytes are cut where a rolling gear hash of the last 32 bytes meets a mask.
Cutting is normalised: up to ``normal`` bytes a chunk needs a rarer hash value to end,
after it a commoner one, so chunk lengths gather around ``normal``. Places of cuts depend
only on the bytes before them, so an insertion moves chunks without changing the others.
The fingerprint is the set of chunk digests, each with its chunk's length; the likeness
of two fingerprints is the share of the first's length whose digests are in the second.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, map_rows, splitmix

GEAR = np.array([splitmix(i) >> 32 for i in range(256)], np.uint32)
REACH = 32  # bytes that a 32-bit gear hash looks back


@dataclass(frozen=True)
class ChunkSettings:
    """Bytes of the shortest, usual and longest chunk; hash bits before and after the usual length."""

    least: int = REACH
    normal: int = 96
    most: int = 512
    hard_bits: int = 7
    easy_bits: int = 5

    def __post_init__(self):
        if not REACH <= self.least <= self.normal <= self.most or not self.easy_bits <= self.hard_bits:
            raise ValueError("chunk settings need 32 <= least <= normal <= most and easy_bits <= hard_bits")


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """At each byte the gear hash of it and the 31 bytes before, by five doublings."""
    hashes = GEAR[data]
    reach = 1
    while reach < REACH:
        earlier = hashes[:-reach] << np.uint32(reach)
        hashes[reach:] += earlier
        reach *= 2
    return hashes


def cut_points(data: np.ndarray, starts: list[int], settings: ChunkSettings) -> list[list[int]]:
    """Ends of the chunks of each text; ``data`` holds the texts one after the other.

    A hash that reaches into the text before is never used: the shortest chunk is as
    long as the hash looks back.
    """
    hashes = gear_hashes(data)
    top = np.uint32(32)
    easy = np.flatnonzero(hashes >> (top - np.uint32(settings.easy_bits)) == 0)
    hard = easy[hashes[easy] >> (top - np.uint32(settings.hard_bits)) == 0]
    easy, hard = (easy + 1).tolist(), (hard + 1).tolist()  # a cut is after its byte
    easy.append(1 << 62), hard.append(1 << 62)
    least, normal, most = settings.least, settings.normal, settings.most
    result = []
    for at, end in zip(starts, starts[1:]):
        cuts = []
        while end - at > least:
            cut = hard[bisect_left(hard, at + least)]
            if cut >= at + normal:
                cut = min(easy[bisect_left(easy, at + normal)], at + most)
            if cut >= end:
                break
            cuts.append(cut)
            at = cut
        if at < end:
            cuts.append(end)
        result.append(cuts)
    return result


def fingerprints(texts: list[bytes], settings: ChunkSettings) -> list[dict[int, int]]:
    """Digest and length of the distinct chunks of each text."""
    joined = b"".join(texts)
    starts = [0]
    for text in texts:
        starts.append(starts[-1] + len(text))
    digest = xxhash.xxh3_64_intdigest
    result = []
    if not joined:
        return [{} for _ in texts]
    for at, cuts in zip(starts, cut_points(np.frombuffer(joined, np.uint8), starts, settings)):
        chunks = {}
        for cut in cuts:
            chunks[digest(joined[at:cut])] = cut - at
            at = cut
        result.append(chunks)
    return result


def likeness(one: dict[int, int], other: dict[int, int]) -> float:
    """Share of the length of ``one`` that ``other`` holds; of an empty one: 1 if both are empty."""
    total = sum(one.values())
    if not total:
        return float(not other)
    return sum(length for digest, length in one.items() if digest in other) / total


def as_text(chunks: dict[int, int]) -> str:
    return " ".join(f"{digest:016x}:{length}" for digest, length in sorted(chunks.items()))


def from_text(text: str) -> dict[int, int]:
    pairs = (part.split(":") for part in text.split())
    return {int(digest, 16): int(length) for digest, length in pairs}


def _print(batches: Iterator[pa.RecordBatch], settings: ChunkSettings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [t.encode() for t in batch.column("text").to_pylist()]
        prints = fingerprints(texts, settings)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([as_text(p) for p in prints], pa.string())], ["doc_id", "fingerprint"]
        )


def fingerprint(docs: DataFrame, settings: ChunkSettings | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: ``doc_id`` and its fingerprint as text (``digest:length`` words).

    Null and empty texts have an empty fingerprint. Equal texts have equal ones. Repeated
    rows and null identifiers pass through; other columns are not read.
    """
    return map_rows(
        id_and_text(docs, id_col, text_col), _print, "doc_id bigint, fingerprint string", settings or ChunkSettings()
    )


def with_next_text(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """Add ``next_text``: the text of the next document by descending ``doc_id``; after the last, the first.

    Documents are dealt to ranges of identifiers, each ordered on its own. The largest
    document of a range also goes to the range above as its end, so only one row per
    range moves twice. Ties are ordered by the text's hash; null identifiers come last.
    """
    spark = docs.sparkSession
    ranges = ranges or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / ranges for i in range(1, ranges)]
    found = docs.select(F.percentile_approx("doc_id", shares, 10 * ranges).alias("b")).first()["b"] if shares else []
    edges = F.lit(sorted(set(found or [])) or [-(1 << 63)]).cast("array<bigint>")
    place = F.coalesce(F.size(F.filter(edges, lambda edge: edge <= F.col("doc_id"))), F.lit(-1))
    dealt = docs.select("doc_id", "text", place.alias("range"), F.xxhash64("text").alias("hash"))

    lowest = F.lit(-(1 << 63)).cast("bigint")
    tops = dealt.groupBy("range").agg(F.max(F.struct(F.coalesce("doc_id", lowest).alias("id"), "hash")).alias("top"))
    tops = sorted((r["range"], r["top"]["id"], r["top"]["hash"]) for r in tops.collect())  # one row per range
    above = [r[0] for r in tops[1:]] + [r[0] for r in tops[:1]]
    ends = spark.createDataFrame(
        [(*top, target) for top, target in zip(tops, above)], "range int, top_id bigint, top_hash bigint, target int"
    )
    same = [
        dealt["range"] == ends["range"],
        F.coalesce(dealt["doc_id"], lowest) == ends["top_id"],
        dealt["hash"] == ends["top_hash"],
    ]
    own = F.struct(dealt["range"].alias("range"), F.lit(False).alias("end"))
    other = F.struct(F.col("target").alias("range"), F.lit(True).alias("end"))
    marked = dealt.join(F.broadcast(ends), same, "left").select(
        "doc_id", "text", "hash", F.explode(F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, other))).alias("to")
    )
    order = W.partitionBy("to.range").orderBy(F.col("to.end"), F.desc_nulls_last("doc_id"), F.desc("hash"))
    return marked.withColumn("next_text", F.lead("text").over(order)).where(~F.col("to.end")).select(
        "doc_id", "text", "next_text"
    )


def _compare(batches: Iterator[pa.RecordBatch], settings: ChunkSettings) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts, nexts = (c.to_pylist() for c in batch.columns)
        edited = []
        for text, other in zip(texts, nexts):
            half = len(text) // 2
            edited.append((text[: len(text) - half] + other[:half]).encode())
        texts, nexts = [t.encode() for t in texts], [t.encode() for t in nexts]
        # the next text is mostly the next row's own
        distinct = list(dict.fromkeys([*texts, *nexts, *edited]))
        prints = dict(zip(distinct, fingerprints(distinct, settings)))
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column("doc_id"),
                "n_chars": pa.array([len(t) for t in batch.column("text").to_pylist()], pa.int64()),
                "edited_sha256": pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()),
                "fingerprint": pa.array([as_text(prints[t]) for t in texts], pa.string()),
                "edited_fingerprint": pa.array([as_text(prints[e]) for e in edited], pa.string()),
                "near_edited": pa.array([likeness(prints[t], prints[e]) for t, e in zip(texts, edited)], pa.float64()),
                "near_next": pa.array([likeness(prints[t], prints[n]) for t, n in zip(texts, nexts)], pa.float64()),
            }
        )


COMPARE_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def compare_edited(docs: DataFrame, settings: ChunkSettings | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and how alike they are.

    The edited form replaces the last half of the code points (rounded down) by as many
    from the start of the next document's text, or by all of it where it is shorter.
    """
    rows = with_next_text(id_and_text(docs, id_col, text_col))
    return map_rows(rows, _compare, COMPARE_SCHEMA, settings or ChunkSettings())
