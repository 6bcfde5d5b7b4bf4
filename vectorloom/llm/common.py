"""What the operators of this subpackage share: reading, stored steps, Arrow slices."""

from __future__ import annotations

import gc
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.functions.batches import released, slices, trim
from vectorloom.session import RUNTIME_CONF, shared_folder, ship_package

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MASK64 = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    ship_package(spark)
    spark.conf.set(ARROW_BYTES, RUNTIME_CONF[ARROW_BYTES])
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, so extra columns can't clash; null text is empty."""
    ship_package(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )


_made: dict[str, list[str]] = {}  # folders of steps, by application


def stored(frame: DataFrame, purpose: str, kept: bool = False) -> DataFrame:
    """Write a step to the shared folder and read it back: its lineage ends here.

    ``discard`` deletes it when the next step is written; ``release`` all that aren't ``kept``.
    """
    spark = frame.sparkSession
    path = shared_folder(spark, purpose)
    frame.write.parquet(path)
    if not kept:
        _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    result = spark.read.schema(frame.schema).parquet(path)
    result._stored_at = path
    return result


def discard(*frames: DataFrame | None) -> None:
    """Delete stored steps that nothing reads any more."""
    for frame in frames:
        if frame is not None:
            _delete(frame.sparkSession, frame._stored_at)


def let_go(spark: SparkSession) -> None:
    """Have finished shuffles removed.

    Spark removes a shuffle's files once its plan is no longer referred to, which its
    cleaner learns from a collection in the driver.
    """
    gc.collect()
    spark._jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Delete all stored steps of this application: for a caller whose results are written."""
    for path in _made.pop(spark.sparkContext.applicationId, []):
        _delete(spark, path)
    let_go(spark)


def _delete(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
    made = _made.get(spark.sparkContext.applicationId, [])
    if path in made:
        made.remove(path)


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have, in any case of letters."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


_caches: dict[str, dict] = {}
_forgets: list[Callable] = []
_last = [""]  # module of the task that ran last in this worker


def worker_cache(owner: str) -> dict:
    """What the module ``owner`` keeps in this worker from task to task, until a task of another module comes."""
    return _caches.setdefault(owner, {})


def until_others(forget: Callable) -> None:
    """Have ``forget`` called in this worker once, when a task of another module comes."""
    _forgets.append(forget)


def begin_task(module: str) -> None:
    """Drop what tasks of other modules left in this worker; what that frees goes back to the system."""
    for owner in [o for o in _caches if o != module]:
        del _caches[owner]
    if _last[0] != module:
        _last[0] = module
        while _forgets:
            _forgets.pop()()
        trim()


def map_rows(frame: DataFrame, function: Callable, schema: str, *arguments) -> DataFrame:
    """``function(slices, *arguments)`` over Arrow slices of each partition."""

    ship_package(frame.sparkSession)

    def run(batches):
        begin_task(function.__module__)  # by its name: what a shipped function refers to itself is a copy in the worker
        return released(function(slices(batches), *arguments))

    return frame.mapInArrow(run, schema)


def splitmix(value: int) -> int:
    """A fixed 64-bit mixing step; tables of constants are built from it."""
    value = (value + 0x9E3779B97F4A7C15) & MASK64
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) & MASK64
    value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) & MASK64
    return value ^ (value >> 31)


def unsigned_crc32(text: Column) -> Column:
    return F.crc32(text.cast("binary"))
