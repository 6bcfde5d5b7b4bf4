"""Removing repeated texts: the first arrival of a text stays.

Rows need ``bibcode, text, year, arrival``; ``arrival`` is unique and gives the order.
A text that repeats any number of times is safe: the first arrival comes from partial
minima, unique rows are found by joining on ``arrival`` (one row per value), and the
report of duplicates goes through a lookup that treats frequent texts apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectorloom.functions import text as X
from vectorloom.operators.lookup import HOT_ROWS, lookup

FIRST_COLUMNS = ("first_seen_bibcode", "first_seen_year")


def with_hash(prepared: DataFrame) -> DataFrame:
    # a hash that cannot be null spares every join and grouping a second evaluation of
    # it in a not-null filter; prepared texts are never null
    return prepared.withColumn("text_hash", F.coalesce(X.normalised_text_hash("text"), F.lit("")))


def _key(cross_year: bool) -> list[str]:
    return ["text_hash"] if cross_year else ["text_hash", "year"]


def first_arrivals(hashed: DataFrame, cross_year: bool = True) -> DataFrame:
    """``text_hash[, year], arrival, copies``: one row per distinct text."""
    narrow = hashed.select("text_hash", "year", "arrival")
    return narrow.groupBy(*_key(cross_year)).agg(F.min("arrival").alias("arrival"), F.count("*").alias("copies"))


def first_seen(hashed: DataFrame, cross_year: bool = True) -> DataFrame:
    """The hash store of these rows: where each text was seen first."""
    narrow = hashed.select("text_hash", "year", "arrival", "bibcode")
    first = F.min(F.struct("arrival", "bibcode", F.col("year").alias("seen_year"))).alias("first")
    return narrow.groupBy(*_key(cross_year)).agg(first, F.count("*").alias("copies")).select(
        "text_hash",
        F.col("first.bibcode").alias("first_seen_bibcode"),
        F.col("first.seen_year").alias("first_seen_year"),
        "copies",
        F.col("first.arrival").alias("arrival"),
    )


def among(store: DataFrame, rows: DataFrame) -> DataFrame:
    """The entries of a hash store that rows of a batch ask for.

    With a small batch its hashes are broadcast and the store is only scanned; without
    this step an anti join against the store would shuffle all of it.
    """
    return store.join(rows.select("text_hash"), "text_hash", "left_semi")


def unique_rows(hashed: DataFrame, store: DataFrame | None = None, cross_year: bool = True) -> DataFrame:
    """Rows whose text is seen for the first time, here and in the hash store."""
    firsts = first_arrivals(hashed, cross_year)
    if store is not None:
        firsts = firsts.join(among(store, firsts).select("text_hash"), "text_hash", "left_anti")
    return hashed.join(firsts.select("arrival"), "arrival", "left_semi")


def _compare_key(frame: DataFrame, cross_year: bool) -> DataFrame:
    if cross_year:
        return frame.withColumn("_dedup_key", F.col("text_hash"))
    return frame.withColumn("_dedup_key", F.concat_ws(":", "text_hash", F.col("year").cast("string")))


def annotate(
    hashed: DataFrame, store: DataFrame | None = None, cross_year: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every row with ``is_duplicate`` and the pair that was seen first.

    A text already in ``store`` (``text_hash, first_seen_bibcode, first_seen_year``)
    is a duplicate of the stored pair.
    """
    narrow = hashed.drop("text")
    firsts = first_seen(narrow, cross_year)
    if store is not None:
        known = among(store, firsts).select("text_hash", *[F.col(c).alias(f"_known_{c}") for c in FIRST_COLUMNS])
        firsts = firsts.join(known, "text_hash", "left")
        was_known = F.col("_known_first_seen_bibcode").isNotNull()
        firsts = firsts.select(
            "text_hash",
            "first_seen_year",
            "copies",
            *[F.when(was_known, F.col(f"_known_{c}")).otherwise(F.col(c)).alias(f"_to_{c}") for c in FIRST_COLUMNS],
            F.when(~was_known, F.col("arrival")).alias("_first_arrival"),
        )
    else:
        firsts = firsts.select(
            "text_hash",
            "first_seen_year",
            "copies",
            *[F.col(c).alias(f"_to_{c}") for c in FIRST_COLUMNS],
            F.col("arrival").alias("_first_arrival"),
        )
    firsts = _compare_key(firsts.withColumnRenamed("first_seen_year", "year"), cross_year).drop("text_hash", "year")
    found = lookup(_compare_key(narrow, cross_year), firsts, "_dedup_key", hot_rows, "copies")
    is_first = F.coalesce(F.col("arrival") == F.col("_first_arrival"), F.lit(False))
    named = [F.col(f"_to_{c}").alias(c) for c in FIRST_COLUMNS]
    return found.select(*narrow.columns, *named, (~is_first).alias("is_duplicate"))


def duplicates(
    hashed: DataFrame, store: DataFrame | None = None, cross_year: bool = True, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The duplicate report: one row per repeated record with its first-seen pair."""
    tagged = annotate(hashed, store, cross_year, hot_rows)
    return tagged.where("is_duplicate").select("bibcode", "year", "text_hash", "first_seen_year", "first_seen_bibcode")


def find_in_store(hashed: DataFrame, store: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Each row with the stored first-seen pair of its text, null where unknown."""
    return lookup(hashed, store.select("text_hash", *FIRST_COLUMNS), "text_hash", hot_rows)


def store_stats(store: DataFrame) -> DataFrame:
    return store.agg(F.count_distinct("text_hash").alias("unique_hashes"))


def store_estimate(store: DataFrame, rsd: float = 0.02) -> DataFrame:
    return store.agg(F.approx_count_distinct("text_hash", rsd).alias("estimated_unique_hashes"))


def dedup_stream(lines: DataFrame) -> DataFrame:
    """Repeated texts dropped from a stream that ends: Spark keeps the seen hashes.

    For streams without an end use the ingest job, whose seen texts are a table.
    """
    return lines.dropDuplicates(["text_hash"])
