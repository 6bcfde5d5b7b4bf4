"""Numbering rows in order without sending a group through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BUCKET_WIDTH = 1 << 20
BUCKETS_PER_BLOCK = 4096


def rows_before(
    rows: DataFrame,
    groups: Sequence[str],
    order: str,
    out: str,
    width: int = BUCKET_WIDTH,
) -> DataFrame:
    """Add ``out``: how many rows of the same group have a smaller ``order``.

    ``order`` is an integer that is unique within a group. Rows are cut into buckets
    of ``width`` consecutive values, so a bucket holds at most ``width`` rows however
    large the group is. Bucket counts are summed up in two levels (buckets, and blocks
    of buckets), and each bucket is numbered on its own. The rows shuffle once.
    """
    # a struct key is never null itself, so rows with a null group value stay
    bucketed = rows.withColumn("_group", F.struct(*groups) if groups else F.lit(0))
    bucketed = bucketed.withColumn("_bucket", F.expr(f"`{order}` div {int(width)}"))
    counts = bucketed.groupBy("_group", "_bucket").agg(F.count("*").alias("_n"))
    counts = counts.withColumn("_block", F.expr(f"_bucket div {BUCKETS_PER_BLOCK}"))

    blocks = counts.groupBy("_group", "_block").agg(F.sum("_n").alias("_n"))
    blocks = blocks.select("_group", "_block", _sum_before(["_group"], "_block").alias("_above"))
    inner = counts.withColumn("_within", _sum_before(["_group", "_block"], "_bucket"))
    offsets = inner.join(blocks, ["_group", "_block"]).select(
        "_group", "_bucket", (F.col("_above") + F.col("_within")).alias("_offset")
    )

    local = F.row_number().over(W.partitionBy("_group", "_bucket").orderBy(order)) - 1
    numbered = bucketed.join(offsets, ["_group", "_bucket"])
    return numbered.withColumn(out, (F.col("_offset") + local).cast("bigint")).drop("_group", "_bucket", "_offset")


def _sum_before(groups: list[str], order: str) -> Column:
    window = W.partitionBy(*groups).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return F.coalesce(F.sum("_n").over(window), F.lit(0))


def top_per_group(
    rows: DataFrame, groups: Sequence[str], order: Sequence, k: int, rank: str = "rank", salts: int = 64
) -> DataFrame:
    """The ``k`` best rows of each group, in two rounds.

    The first round works on pieces of a group, so a group that holds most of the rows
    is cut down by many tasks before its last ``k * salts`` rows meet.
    """
    groups = list(groups)
    pieces = rows.withColumn("_piece", F.spark_partition_id() % salts)
    first = W.partitionBy(*groups, "_piece").orderBy(*order)
    cut = pieces.withColumn("_at", F.row_number().over(first)).where(F.col("_at") <= k)
    last = W.partitionBy(*groups).orderBy(*order)
    cut = cut.drop("_at", "_piece").withColumn(rank, F.row_number().over(last))
    return cut.where(F.col(rank) <= k)
