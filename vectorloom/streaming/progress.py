"""Progress figures of streams, kept as a table."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

PROGRESS = (
    "query_id string, run_id string, batch bigint, time timestamp, input_rows bigint, input_rows_per_second double, "
    "processed_rows_per_second double, batch_millis bigint, durations string"
)


class ProgressTable(StreamingQueryListener):
    """Appends a row per micro-batch to a folder: ``spark.streams.addListener(ProgressTable(spark, path))``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        rate_in, rate_out = progress.inputRowsPerSecond, progress.processedRowsPerSecond
        row = (
            str(progress.id), str(progress.runId), progress.batchId, progress.timestamp, progress.numInputRows,
            rate_in if rate_in == rate_in else None, rate_out if rate_out == rate_out else None,
            progress.batchDuration, json.dumps(dict(progress.durationMs)),
        )
        rows = self.spark.createDataFrame([row], PROGRESS.replace("time timestamp", "time string"))
        rows = rows.withColumn("time", F.to_timestamp("time"))
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows a ``ProgressTable`` wrote."""
    return spark.read.schema(PROGRESS).parquet(path)


def progress_by_query(rows: DataFrame) -> DataFrame:
    """Per stream its batches, rows and rows per second over the time its batches took."""
    seconds = F.sum("batch_millis") / 1000
    return rows.groupBy("query_id").agg(
        F.count_distinct("batch").alias("batches"),
        F.sum("input_rows").alias("rows"),
        (F.sum("input_rows") / F.nullif(seconds, F.lit(0.0))).alias("rows_per_second"),
    )
