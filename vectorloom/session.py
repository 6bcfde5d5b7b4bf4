"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the library relies on; all may be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # duplicate keys inside one JSON object: the last one wins
    "spark.sql.variant.allowDuplicateKeys": "true",
    # longer lists are pushed to Parquet as a range only, and its bloom filters stay unused
    "spark.sql.parquet.pushdown.inFilterThreshold": "256",
    # long texts and lists of words reach Python workers in batches of so many bytes
    "spark.sql.execution.arrow.maxBytesPerBatch": "8388608",
}

_shipped: set[str] = set()


def apply_runtime_conf(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors once per application.

    Functions that run in Python workers are sent by name, so the workers must be able
    to import the package even where it is not installed.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="vectorloom-")) / "vectorloom.zip"
    with zipfile.ZipFile(archive, "w") as bundle:
        for source in sorted(package.rglob("*.py")):
            bundle.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def build_session(app_name: str = "vectorloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; pass further settings as ``spark_sql_shuffle_partitions="8"``."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("_", "."), value)
    return apply_runtime_conf(builder.getOrCreate())


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder for written intermediate tables.

    The cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one machine, may fall back to a
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="vectorloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def spread_small(rows: DataFrame) -> DataFrame:
    """Deal out an input that is too small to give every core a split.

    Only for stages that cost much more per byte than a shuffle. An input with at least
    Spark's smallest split (``openCostInBytes``) per core, by the planner's estimate, is
    left as it is, so never more than that is shuffled.
    """
    spark = rows.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        spark.conf.get("spark.sql.files.openCostInBytes")
    )
    return rows.repartition(cores) if int(str(size)) < cores * split else rows
