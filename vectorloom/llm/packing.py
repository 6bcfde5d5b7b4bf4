"""Packing token sequences: bounded-space online best-fit.

A task keeps a fixed number of open bins. They are found by free space: a bit per amount
of free space that some open bin has, so the tightest bin that fits is the lowest set
bit at or above the length. When a new bin is needed and none may be opened, the fullest
one closes. What is in bins still open at the end of a task is packed again together
with that of other tasks, longest first, in rounds of fewer tasks until one is left; a
round holds at most as many bins per task as stay open.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, map_rows, stored
from vectorloom.llm.token_files import encoded

TASKS_PER_ROUND = 8
SCHEMA = (
    "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint, "
    "task int, open boolean"
)
NAMES = [part.split()[0] for part in SCHEMA.split(", ")]


class BestFit:
    """Bins of ``capacity``; at most ``most_open`` are open. Closed bins are given out as lists of items."""

    def __init__(self, capacity: int, most_open: int):
        self.capacity, self.most_open = capacity, most_open
        self.by_free: list[list[list]] = [[] for _ in range(capacity + 1)]
        self.bits, self.count = 0, 0

    def _take(self, free: int) -> list:
        bins = self.by_free[free]
        taken = bins.pop()
        self.count -= 1
        if not bins:
            self.bits ^= 1 << free
        return taken

    def add(self, item, length: int) -> list[list]:
        """Put the item into a bin; the bins that close by it."""
        closed = []
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(free)
        else:
            if self.count >= self.most_open:
                closed.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, chosen = self.capacity, []
        chosen.append(item)
        free -= length
        if free:
            self.by_free[free].append(chosen)
            self.bits |= 1 << free
            self.count += 1
        else:
            closed.append(chosen)
        return closed

    def rest(self) -> list[list]:
        return [b for bins in self.by_free for b in bins]


def pieces(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of a document; only the first may be shorter than the capacity."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    return [(0, first), *((start, capacity) for start in range(first, n_tokens, capacity))]


class _Rows:
    """Packs items (doc_id, piece, start, length, crc) of one task into rows."""

    def __init__(self, task: int, round_: int, capacity: int, most_open: int):
        self.task, self.fit, self.number = task, BestFit(capacity, most_open), (round_ << 56) | (task << 32)
        self.rows: list[tuple] = []

    def put(self, item: tuple) -> None:
        for items in self.fit.add(item, item[3]):
            self._give(items, False)

    def _give(self, items: list[tuple], is_open: bool) -> None:
        offset = 0
        for item in items:
            self.rows.append((*item, self.number, offset, self.task, is_open))
            offset += item[3]
        self.number += 1

    def finish(self) -> None:
        for items in self.fit.rest():
            self._give(items, True)

    def batch(self) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.bool_()]
        columns = zip(*self.rows) if self.rows else [[]] * len(NAMES)
        self.rows = []
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], NAMES)


def _pack_texts(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, capacity: int, most_open: int):
    rows = _Rows(TaskContext.get().partitionId(), 0, capacity, most_open)
    for ids, tokens in encoded(batches, tokenizer):
        for doc_id, own in zip(ids, tokens):
            data = own.astype("<u4").tobytes() + end_id.to_bytes(4, "little")
            for number, (start, length) in enumerate(pieces(len(data) // 4, capacity)):
                rows.put((doc_id, number, start, length, zlib.crc32(data[4 * start : 4 * (start + length)])))
        yield rows.batch()
    rows.finish()
    yield rows.batch()


def _pack_again(batches: Iterator[pa.RecordBatch], round_: int, capacity: int, most_open: int):
    rows = None
    for batch in batches:
        for *item, group in zip(*(batch.column(n).to_pylist() for n in [*NAMES[:5], "group"])):
            if rows is None or rows.task != group:
                if rows is not None:
                    rows.finish()
                    yield rows.batch()
                rows = _Rows(group, round_, capacity, most_open)
            rows.put(tuple(item))
        if rows is not None:
            yield rows.batch()
    if rows is not None:
        rows.finish()
        yield rows.batch()


def pack(
    docs: DataFrame,
    tokenizer: str,
    capacity: int = 1024,
    end_id: int = 2,
    most_open: int = 256,
    id_col="doc_id",
    text_col="text",
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every text is encoded whole and gets ``end_id`` at its end; null and empty texts are
    that one token. Longer documents than ``capacity`` are cut so that only the first
    piece is shorter. A sequence's pieces lie without gaps from 0. Null identifiers stay
    null, repeated rows are packed each, an empty table gives no rows.
    """
    rows = id_and_text(docs, id_col, text_col)
    packed = stored(map_rows(rows, _pack_texts, SCHEMA, tokenizer, end_id, capacity, most_open), "packed-0")
    done = [packed.where("not open")]
    groups = (packed.agg(F.max("task")).first()[0] or 0) + 1
    round_ = 0
    while True:
        round_ += 1
        groups = -(-groups // TASKS_PER_ROUND)
        again = packed.where("open").withColumn("group", F.expr(f"task div {TASKS_PER_ROUND}").cast("int"))
        again = again.repartition(groups, "group").sortWithinPartitions("group", F.desc("length"), "doc_id", "piece")
        packed = stored(map_rows(again, _pack_again, SCHEMA, round_, capacity, most_open), f"packed-{round_}")
        done.append(packed if groups == 1 else packed.where("not open"))
        if groups == 1:
            break
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result.select(NAMES[:7])
