"""Joining rows to a table with one row per key when a few keys may hold most rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 1_000_000


def lookup(
    rows: DataFrame, table: DataFrame, key: str, hot_rows: int = HOT_ROWS, copies: str | None = None
) -> DataFrame:
    """Left join of ``rows`` to ``table`` on ``key``; ``table`` has each key once.

    Keys with more than ``hot_rows`` rows are found first: by counting (partial counts,
    then one narrow shuffle), or from the column ``copies`` of the table where it
    already holds the number of rows per key. There can be at most ``rows / hot_rows``
    such keys, so their table entries are broadcast and their rows never meet in one
    task. All other rows take the ordinary shuffle join; hot rows pass it with a key of
    their own that matches nothing and spreads evenly.
    """
    values = [c for c in table.columns if c not in (key, copies)]
    if copies is None:
        counts = rows.groupBy(key).agg(F.count("*").alias("_n"))
        hot_keys = counts.where((F.col("_n") > hot_rows) & F.col(key).isNotNull()).select(key)
        hot = table.join(F.broadcast(hot_keys), key, "left_semi")
    else:
        hot = table.where(F.col(copies) > hot_rows)
    hot = F.broadcast(hot.select(F.col(key).alias("_hot_key"), *[F.col(v).alias(f"_hot_{v}") for v in values]))
    cold = table.select(F.col(key).alias("_key"), *[F.col(v).alias(f"_cold_{v}") for v in values])

    marked = rows.join(hot, F.col(key) == F.col("_hot_key"), "left")
    # the task is part of it: identical copies spread too, and a repeated task gives the same
    own = F.concat_ws(" ", F.lit("row"), F.spark_partition_id(), F.xxhash64(*rows.columns))
    settled = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    marked = marked.withColumn("_probe", F.when(settled, own).otherwise(F.col(key).cast("string")))
    joined = marked.join(cold, F.col("_probe") == F.col("_key").cast("string"), "left")
    found = [
        F.when(F.col("_hot_key").isNotNull(), F.col(f"_hot_{v}"))
        .when(F.col(key).isNotNull(), F.col(f"_cold_{v}"))
        .alias(v)
        for v in values
    ]
    return joined.select(*rows.columns, *found)
