"""Exact deduplication as a stream with disk-backed state.

Each row becomes a narrow record: digest of the normalised text, identifier, locator. The
records are a stream; keyed state in RocksDB, kept without expiry, has per digest the
first identifier with its locator and the number of rows. Records combine inside the
tasks before they reach the state, so a text that a third of all rows share costs one
state row per task. A digest with more than one row is a hit: the full bytes of its rows
are compared with the row that stays, and rows that differ form groups by text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectorloom.llm.common import fresh, id_and_text, stored
from vectorloom.operators.lookup import lookup
from vectorloom.session import shared_folder

SPACES = r"[\x20\x09-\x0D]+"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MAP_BITS = 1 << 26


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, SPACES, " ")


def text_digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _first(*columns: str) -> Column:
    """The order in which a row stays: identifiers ascending, null last, then row number."""
    return F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", *columns)


def first_seen(records: DataFrame, checkpoint: str, batch_bytes: int = 64 << 30) -> DataFrame:
    """Run the stream over stored records to its end and read its state.

    ``records`` must come from a folder. A run with the same checkpoint goes on where
    the last one ended: only new files are read, and the state still knows all digests.
    """
    spark = records.sparkSession
    folder = records.inputFiles()[0].rsplit("/", 1)[0] if records.inputFiles() else None
    if folder is None:
        return spark.createDataFrame([], "digest string, first struct<none:boolean,doc_id:bigint,row:bigint,locator:string>, group_size bigint")
    stream = spark.readStream.schema(records.schema).option("maxBytesPerTrigger", batch_bytes).parquet(folder)
    keyed = stream.groupBy("digest").agg(F.min(_first("locator")).alias("first"), F.count("*").alias("group_size"))
    settings = {
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
        # else each store, however small, reserves megabytes of disk
        "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        writer = keyed.writeStream.format("noop").outputMode("update").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start().awaitTermination()
        state = spark.read.format("statestore").load(checkpoint)
        names = state.schema["value"].dataType.names
        found = state.select(
            F.col("key.digest"), F.col(f"value.`{names[0]}`").alias("first"), F.col(f"value.`{names[1]}`").alias("group_size")
        )
        return stored(found, "dedup-state")
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def maybe_in(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``keys``, and few others: a bit map of hashed keys decides.

    The map has ``MAP_BITS`` bits whatever the number of keys, so it may be broadcast; a
    full one lets all rows pass. It saves the exact join from moving rows without a match.
    """
    place = F.pmod(F.xxhash64(key), F.lit(MAP_BITS))
    bits = keys.select(F.bitmap_bucket_number(place).alias("_part"), F.bitmap_bit_position(place).alias("_at"))
    bits = bits.groupBy("_part").agg(F.bitmap_construct_agg("_at").alias("_bits"))
    joined = rows.withColumn("_place", place).join(
        F.broadcast(bits), F.bitmap_bucket_number("_place") == F.col("_part")
    )
    byte = F.expr("conv(hex(substring(_bits, cast(bitmap_bit_position(_place) div 8 as int) + 1, 1)), 16, 10)").cast("int")
    found = F.expr("cast(bitmap_bit_position(_place) % 8 as int)")
    return joined.where(F.getbit(byte, found) == 1).select(*rows.columns)


def find_copies(
    docs: DataFrame,
    id_col="doc_id",
    text_col="text",
    digest: Callable[[Column], Column] = text_digest,
    batch_bytes: int = 64 << 30,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row.

    Texts are equal when they are after runs of white space became one space; null is
    empty. The smallest ``doc_id`` stays; null identifiers only stay if there is no
    other, and of repeated rows exactly one stays. ``digest`` may be any function of the
    text: rows of one digest whose bytes differ are parted by their text (and told apart
    by ``doc_id``). An empty table gives no rows; other columns are not read.
    """
    rows = id_and_text(docs, id_col, text_col).select("doc_id", normalised(F.col("text")).alias("text"))
    records = stored(
        rows.select(
            "doc_id",
            digest(F.col("text")).alias("digest"),
            text_digest(F.col("text")).alias("text_sha256"),
            F.monotonically_increasing_id().alias("row"),
            F.input_file_name().alias("locator"),
        ),
        "dedup-records",
    )
    state = first_seen(records, shared_folder(docs.sparkSession, "dedup-stream"), batch_bytes)

    hits = state.where("group_size > 1").select("digest", F.col("first.doc_id").alias("keep_id"))
    texts = maybe_in(rows.withColumn("digest", digest(F.col("text"))), hits, "digest").join(hits, "digest")
    is_first = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # rows that repeat the first one's identifier: the smallest text stands for it
    keepers = texts.where(is_first).groupBy("digest").agg(F.min("text").alias("kept_text"))
    differ = stored(
        texts.join(keepers, "digest").where("text != kept_text").select("doc_id", "digest", "text"), "dedup-differ"
    )
    parted = differ.groupBy("digest", "text").agg(F.min("doc_id").alias("other_id"), F.count("*").alias("other_size"))
    moved = differ.join(parted, ["digest", "text"]).select("doc_id", "digest", "other_id", "other_size").distinct()
    lost = differ.groupBy("digest").agg(F.count("*").alias("lost"))

    firsts = state.join(lost, "digest", "left").select(
        "digest",
        F.col("first.doc_id").alias("keep_id"),
        F.col("first.row").alias("keep_row"),
        (F.col("group_size") - F.coalesce("lost", F.lit(0))).alias("group_size"),
        F.col("group_size").alias("copies"),
    )
    found = lookup(records, firsts, "digest", copies="copies").join(moved, ["doc_id", "digest"], "left")
    apart = F.col("other_size").isNotNull()
    return found.select(
        "doc_id",
        F.when(apart, F.col("other_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(apart, F.col("other_size")).otherwise(F.col("group_size")).alias("group_size"),
        F.when(apart, F.col("doc_id") == F.col("other_id")).otherwise(F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, whatever these are called.

    Null texts count as empty; a null identifier stays only if its text has no other; rows
    with the same identifier and different texts are decided each by its text. Of rows that
    repeat identifier and text one stays. An empty table stays empty. Only the identifiers
    and digests of rows that go are joined; where they are few no text is moved.
    """
    copies = find_copies(docs, id_col, text_col)
    own_id, own_digest = fresh(docs, "own_id"), fresh(docs, "own_digest")
    pair = [F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_digest")]
    decided = copies.groupBy(*pair).agg(F.max("kept").alias("stays"), F.count("*").alias("rows"))
    decided = stored(decided.where("not stays or rows > 1"), "dedup-decided")
    digest = text_digest(normalised(F.coalesce(F.col(text_col), F.lit(""))))
    named = docs.withColumns({own_id: F.col(id_col).cast("bigint"), own_digest: digest})

    def matches(some: DataFrame):
        return named[own_id].eqNullSafe(some["gone_id"]) & (named[own_digest] == some["gone_digest"])

    columns = [f"`{column}`" for column in docs.columns]
    rest = named.join(decided, matches(decided), "left_anti").select(*columns)
    repeated = decided.where("stays")
    if repeated.isEmpty():
        return rest
    once = named.join(repeated, matches(repeated), "left_semi").dropDuplicates([own_id, own_digest])
    return rest.unionByName(once.select(*columns))
