"""Incremental ingest: files that arrive are prepared, deduplicated, embedded and stored.

Each micro-batch is one run of the ingest job, always under the same number. Seen texts are
a table and not streaming state, so they may grow without bound, and a batch that is
repeated after a failure replaces what its first attempt wrote.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from vectorloom.operators.prepare import PrepareSettings, prepared_text
from vectorloom.operators.store import VectorStore
from vectorloom.operators import dedup as D
from vectorloom.plans.pipeline import IngestOptions, ingest
from vectorloom.sources import files as R

# the year leads the name, as in year files; several files may share a year
YEAR_IN_NAME = r"^(?:ads_metadata_)?(\d{4})\D"


def stream_lines(spark: SparkSession, folder: str, files_per_trigger: int = 1000) -> DataFrame:
    """Lines of JSONL files as they arrive; the rate limit bounds a micro-batch."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder)
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
    )


def _parsed(lines: DataFrame) -> DataFrame:
    """Lines with their place, their record (null for a bad line) and the year of their file."""
    row = F.monotonically_increasing_id().bitwiseAND(F.lit(R.TASK_ROW_MASK))
    year = F.regexp_extract(F.substring_index("path", "/", -1), YEAR_IN_NAME, 1).try_cast("int")
    placed = lines.withColumn("seq", F.col("block") + row).drop("block")
    return R.parse_lines(placed.withColumn("year", F.when(year.between(R.FIRST_YEAR, R.LAST_YEAR), year)))


def unread_lines(lines: DataFrame) -> DataFrame:
    """``value, path, seq, reason`` of lines that give no record: bad ones, and those of files without a year."""
    reason = F.when(F.col("year").isNull(), "no year in the file name").when(F.col("record").isNull(), "not a JSON object")
    named = _parsed(lines).select("value", "path", "seq", reason.alias("reason"))
    return named.where(F.col("reason").isNotNull())


def batch_records(lines: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Records of one micro-batch; files are taken in the order of their names.

    The number of files in a batch is bounded by the rate limit. The lines are used
    twice (file names, then records), so the caller keeps the batch.
    """
    paths = sorted(r["path"] for r in lines.select("path").distinct().collect())
    pos_of = R._lookup({path: i for i, path in enumerate(paths)}, "int")
    records = R.valid_records(_parsed(lines)).where(F.col("year").isNotNull())
    records = records.withColumn("source_pos", pos_of(F.col("path"))).drop("path")
    return R.project_fields(records, fields, blank_falsy=True)


def ingest_stream(
    lines: DataFrame,
    settings: PrepareSettings,
    model: str,
    store: VectorStore,
    checkpoint: str,
    options: IngestOptions = IngestOptions(),
) -> DataStreamWriter:
    """A stream writer to start with any trigger, e.g. ``.trigger(availableNow=True).start()``."""

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        run = store.run_of_batch(checkpoint, batch_id)
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            store.write_bad_lines(unread_lines(batch), run)
            ingest(batch_records(batch, settings.fields), settings, model, store, options, run)
        finally:
            batch.unpersist()

    return lines.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)


def distinct_texts(lines: DataFrame, settings: PrepareSettings) -> DataFrame:
    """A stream of prepared texts with repeated ones dropped by Spark's own state.

    For streams that end; the state keeps every hash it has seen.
    """
    records = lines.withColumn("record", F.try_parse_json("value")).where(F.col("record").isNotNull())
    shaped = R.project_fields(records.select("record"), settings.fields, blank_falsy=True)
    prepared = shaped.select("bibcode", prepared_text(settings).alias("text")).where("text IS NOT NULL")
    return D.dedup_stream(D.with_hash(prepared))
