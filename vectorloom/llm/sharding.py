"""Shards of nearly equal bytes that never part equal texts.

Groups of equal texts lie in the order of a 60-bit key of their text's digest. They are
cut into contiguous shards so that the largest shard is as small as possible: the least
capacity is found by binary search, and each capacity is checked greedily. The check
needs sums only, so the driver holds sums over segments of the key range, a number that
doesn't grow with the data. A segment taken as one piece gives an upper bound for the
capacity, taken as divisible a lower bound. Where the two differ, the segments that cuts
can fall into are split finer, down to single groups if need be, until both agree.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, stored, unsigned_crc32
from vectorloom.operators.positions import rows_before

KEY_BITS = 60
FIRST_BITS = 12
FINER_BITS = 8
SLOT_WIDTH = 1 << 16


@dataclass(frozen=True, order=True)
class Segment:
    """Groups with keys from ``low``, ``bits`` wide: their bytes, and whether it is one group."""

    low: int
    bits: int
    size: int
    single: bool


class Line:
    """Segments in key order, with the two greedy checks."""

    def __init__(self, segments: list[Segment]):
        self.segments = sorted(segments)
        self.ends = []
        total = 0
        for segment in self.segments:
            total += segment.size
            self.ends.append(total)
        self.total = total

    def whole(self, position: int, capacity: int) -> int:
        """Furthest end of a segment that a shard from ``position`` reaches."""
        at = bisect_right(self.ends, position + capacity)
        return self.ends[at - 1] if at and self.ends[at - 1] > position else position

    def divided(self, position: int, capacity: int) -> int:
        """The same, where segments of several groups can be cut anywhere."""
        reach = position + capacity
        if reach >= self.total:
            return self.total
        at = bisect_right(self.ends, reach)
        if not self.segments[at].single:
            return reach
        start = self.ends[at - 1] if at else 0
        return max(position, start)

    def cuts(self, capacity: int, shards: int, step: Callable[[int, int], int]) -> list[int]:
        found = [0]
        for _ in range(shards):
            found.append(step(found[-1], capacity))
        return found

    def least(self, shards: int, step: Callable[[int, int], int]) -> int:
        low, high = -(-self.total // shards), self.total
        while low < high:
            middle = (low + high) // 2
            if self.cuts(middle, shards, step)[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low


def least_capacity(shards: int, sums: Callable[[list[Segment] | None], list[Segment]]) -> tuple[int, Line]:
    """Smallest capacity of the largest shard, and a line of segments fine enough to reach it.

    ``sums(None)`` gives the first segments; ``sums(list)`` the finer ones of those.
    """
    line = Line(sums(None))
    while True:
        low, high = line.least(shards, line.divided), line.least(shards, line.whole)
        if low >= high:
            return high, line
        first, last = line.cuts(low, shards, line.whole), line.cuts(high, shards, line.divided)
        finer = set()
        for start, end in zip(first[1:], last[1:]):
            left, right = bisect_left(line.ends, start), bisect_right(line.ends, end)
            finer.update(s for s in line.segments[left : right + 1] if not s.single)
        line = Line([s for s in line.segments if s not in finer] + sums(sorted(finer)))


def even_cuts(line: Line, capacity: int, shards: int) -> list[int]:
    """Ends of all shards but the last, as positions: none over the capacity, and as even as that allows.

    A cut lies between the place from which the rest still fits (filled from the end)
    and the place that the capacity reaches; within these, next to the rest's mean.
    """
    starts = [0, *line.ends]
    latest = [line.total]
    for _ in range(shards - 1):
        latest.append(starts[bisect_left(starts, latest[-1] - capacity)])
    needed = latest[::-1]  # needed[i]: least end of shard i
    cuts, position = [], 0
    for shard in range(shards - 1):
        ideal = position + (line.total - position) / (shards - shard)
        at = bisect_left(starts, ideal)
        near = min(starts[max(0, at - 1) : at + 1], key=lambda s: abs(s - ideal))
        position = min(max(near, needed[shard], position), max(position, line.whole(position, capacity)))
        cuts.append(position)
    return cuts


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row.

    ``size`` is the text's UTF-8 bytes plus 1. Null and empty texts are one group. Rows
    with equal texts share a shard, also when they hold most of the bytes; then other
    shards stay below it. ``slot`` numbers a shard's rows from 0 by ``doc_id`` (null
    first, ties in any order). An empty table gives no rows; other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col)
    key = F.conv(F.substring(F.sha2("text", 256), 1, KEY_BITS // 4), 16, 10).cast("bigint")
    size = (F.octet_length("text") + 1).cast("bigint")
    sized = stored(rows.select("doc_id", size.alias("size"), unsigned_crc32(F.col("text")).alias("text_crc32"), key.alias("key")), "sized")

    def sums(finer: list[Segment] | None) -> list[Segment]:
        if finer is None:
            bits, chosen = KEY_BITS - FIRST_BITS, sized
            segment = F.shiftright("key", bits)
            found = [chosen.groupBy(segment.alias("part"))]
            widths = [bits]
        else:
            found, widths = [], []
            for bits in sorted({s.bits for s in finer}):
                below = max(0, bits - FINER_BITS)
                wanted = [s.low >> bits for s in finer if s.bits == bits]
                chosen = sized.where(F.shiftright("key", bits).isin(wanted))
                found.append(chosen.groupBy(F.shiftright("key", below).alias("part")))
                widths.append(below)
        segments = []
        for groups, bits in zip(found, widths):
            rows = groups.agg(F.sum("size").alias("size"), (F.min("key") == F.max("key")).alias("single")).collect()
            segments += [Segment(r["part"] << bits, bits, r["size"], r["single"] or bits == 0) for r in rows]
        return segments

    capacity, line = least_capacity(shards, sums)
    lows = []
    for cut in even_cuts(line, capacity, shards):
        at = bisect_right(line.ends, cut)  # first segment after the cut
        lows.append(line.segments[at].low if at < len(line.segments) else 1 << KEY_BITS)
    shard = sum((F.col("key") >= F.lit(low)).cast("int") for low in lows) if lows else F.lit(0)
    placed = sized.withColumn("shard", shard).withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63)).cast("bigint")))
    return rows_before(placed, ["shard"], "place", "slot", SLOT_WIDTH).select(
        "doc_id", "size", "text_crc32", "shard", "slot"
    )
