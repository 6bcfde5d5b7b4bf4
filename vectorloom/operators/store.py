"""The store of a corpus: vectors, manifests, catalog and hashes as Parquet tables.

Every write belongs to a numbered run and replaces only that run's partitions, so a
repeated run leaves the same tables. Tables grow by appending runs; the catalog and the
seen texts can be compacted into base snapshots.

Vectors, catalog and seen texts are sorted by their key within a file and carry a bloom
filter on it, so that a look-up opens few row groups. Vectors are kept as bytes, two per
component, unless the store is told to keep them as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectorloom.functions import vectors as V
from vectorloom.operators import catalog as C
from vectorloom.operators import dedup as D

# fixed values: the names of tables and columns
VECTORS = (
    "bibcode string, arrival bigint, text_hash string, embedding array<float>, half binary, error string, batch_no int, "
    "run bigint, status string, year int, model string"
)
ENTRIES = (
    "bibcode string, year int, row_id bigint, model string, vector_file string, fields_hash string, "
    "prompt_hash string, created_at timestamp, version bigint"
)
HASHES = (
    "text_hash string, first_seen_bibcode string, first_seen_year int, model string, fields_hash string, run bigint"
)
HASH_BASE = f"{HASHES}, prefix string"
VECTOR_BASE = (
    "bibcode string, arrival bigint, text_hash string, embedding array<float>, half binary, run bigint, year int, model string"
)
VECTOR_BASE_COLUMNS = ("bibcode", "arrival", "text_hash", "embedding", "half", "run", "year", "model")
MANIFESTS = (
    "year int, model string, dim int, count bigint, fields_hash string, prompt_hash string, "
    "created_at timestamp, vector_file string, version bigint"
)
REMOVED = "year int, model string, version bigint"
REPLACED = "bibcode string, model string, run bigint, year int, version bigint"
BAD_LINES = "value string, path string, seq bigint, reason string, run bigint"
RUNS = "source string, batch bigint, run bigint"
RUN_LOG = (
    "model string, fields_hash string, started_at timestamp, ended_at timestamp, seconds double, loaded_records bigint, "
    "total_records bigint, processed_records bigint, skipped_records bigint, failed_records bigint, "
    "duplicate_records bigint, total_batches bigint, run bigint"
)
SKETCHES = "model string, fields_hash string, sketch binary, run bigint"

# a sketch of seen texts errs by about 1.04 / sqrt(2 ** SKETCH_BITS): below one percent
SKETCH_BITS = 14

# hex digits of a hash that name its folder in a base snapshot
PREFIX_DIGITS = 2
# a batch of up to so many texts names them to the reader, which then skips row groups by
# their range and bloom filter; a larger one has texts in most row groups
NAMED_HASHES = 200


@dataclass(frozen=True)
class VectorStore:
    spark: SparkSession
    root: str
    half_precision: bool = True

    # ------------------------------------------------------------ files

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def _hadoop(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def exists(self, table: str) -> bool:
        hadoop_path, fs = self._hadoop(self.path(table))
        return fs.exists(hadoop_path)

    def _folders(self, table: str) -> list[str]:
        hadoop_path, fs = self._hadoop(self.path(table))
        if not fs.exists(hadoop_path):
            return []
        return [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]

    def _read(self, table: str, schema: str) -> DataFrame:
        if not self.exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def _write(
        self,
        rows: DataFrame,
        table: str,
        run: int,
        partitions: tuple[str, ...] = (),
        key: str = "run",
        look_up: str | None = None,
    ) -> None:
        """Put the rows of one run in its own folder, in place of what an earlier attempt left."""
        if partitions:
            # evens out partitions of very different size, and splits a large one; without
            # the exchange every task would leave a file in every partition
            rows = rows.hint("rebalance", *partitions)
        self._save(rows, f"{table}/{key}={run}", partitions, look_up)

    def _save(self, rows: DataFrame, path: str, partitions: Sequence[str] = (), look_up: str | None = None) -> None:
        if look_up is not None:
            rows = rows.sortWithinPartitions(*partitions, look_up)
        writer = rows.write.mode("overwrite").partitionBy(*partitions)
        if look_up is not None:
            writer = writer.option(f"parquet.bloom.filter.enabled#{look_up}", "true")
            writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        # packed vectors don't repeat, and their lengths are all but free in this form
        writer = writer.option("parquet.writer.version", "v2").option("parquet.enable.dictionary#half", "false")
        writer.parquet(self.path(path))

    # ------------------------------------------------------------ vectors

    def write_vectors(self, embedded: DataFrame, run: int) -> None:
        """Embedding results of a run; failed ones lie in their own partitions."""
        half, whole = F.lit(None).cast("binary"), F.lit(None).cast("array<float>")
        packed = [whole.alias("embedding"), V.pack_half("embedding").alias("half")]
        rows = embedded.select(
            "bibcode", "arrival", "text_hash", *(packed if self.half_precision else ["embedding", half.alias("half")]),
            "error", "batch_no", "status", "year", "model",
        )
        self._write(rows, "vectors", run, ("status", "year", "model"), look_up="bibcode")

    def _unpacked(self, rows: DataFrame) -> DataFrame:
        """Vectors as floats, however they were kept."""
        if not self.half_precision:
            return rows.drop("half")
        whole = F.coalesce("embedding", V.unpack_half("half")).alias("embedding")
        return rows.select(*[whole if c == "embedding" else c for c in rows.columns if c != "half"])

    def results(self, run: int | None = None) -> DataFrame:
        """All results, or those of a run, whose folder alone is then listed."""
        if run is None or not self.exists(f"vectors/run={run}"):
            rows = self._read("vectors", VECTORS)
            return self._unpacked(rows if run is None else rows.where(F.col("run") == run))
        reader = self.spark.read.schema(VECTORS).option("basePath", self.path("vectors"))
        return self._unpacked(reader.parquet(self.path(f"vectors/run={run}")))

    def _unfinished(self) -> list[int]:
        """Runs that wrote vectors and broke off before their catalog; there are few at any time."""
        begun = {int(name.split("=")[1]) for name in self._folders("vectors") if name.startswith("run=")}
        ended = {int(name.split("=")[1]) for name in self._folders("manifests") if name.startswith("version=")}
        return sorted(begun - ended)

    def vectors(self, year: int | None = None, model: str | None = None) -> DataFrame:
        """The latest stored vector of each record and model; year and model prune partitions.

        Runs that broke off before their catalog was written don't count.
        """
        def chosen(rows: DataFrame) -> DataFrame:
            if year is not None:
                rows = rows.where(F.col("year") == year)
            return rows if model is None else rows.where(F.col("model") == model)

        base = self._vector_base()
        later = self._read("vectors", VECTORS).where(F.col("status") == "ok")
        if base is not None:
            later = later.where(F.col("run") > base)  # whole folders are left out
        if unfinished := self._unfinished():
            later = later.where(~F.col("run").isin(unfinished))
        rows = self._without_removed(chosen(later), "run").drop("status", "error", "batch_no")
        if base is not None:
            merged = self.spark.read.schema(VECTOR_BASE).parquet(self.path(f"vector_base/upto={base}"))
            rows = chosen(merged).unionByName(rows)
        return self._unpacked(self._without_replaced(rows, base or 0))

    def _without_replaced(self, rows: DataFrame, base: int) -> DataFrame:
        """Rows that no run after ``base`` replaced; without such marks the plan has no join."""
        if not self.exists("replaced"):
            return rows
        # a mark of a run that was removed later doesn't count: the earlier vector is back
        marks = self._without_removed(self._read("replaced", REPLACED).where(F.col("version") > base), "version")
        if marks.isEmpty():
            return rows
        return rows.join(marks.select("bibcode", "model", "run"), ["bibcode", "model", "run"], "left_anti")

    def compact_vectors(self, upto: int) -> None:
        """Write the live vectors of the runs up to one number as a snapshot, sorted by block and record.

        Searches then read it in place of those runs, without looking for replaced rows.
        The runs stay, so that a block removed later brings back what it had replaced:
        from then on the snapshot is not read until the next one is written.
        """
        rows = self._read("vectors", VECTORS).where((F.col("status") == "ok") & (F.col("run") <= upto))
        if unfinished := self._unfinished():
            rows = rows.where(~F.col("run").isin(unfinished))
        rows = self._without_removed(rows, "run").drop("status", "error", "batch_no")
        if self.exists("replaced"):
            marks = self._read("replaced", REPLACED).where(F.col("version") <= upto)
            marks = self._without_removed(marks, "version").select("bibcode", "model", "run")
            rows = rows.join(marks, ["bibcode", "model", "run"], "left_anti")
        ordered = rows.select(*VECTOR_BASE_COLUMNS).repartitionByRange("year", "model", "bibcode")
        self._save(ordered, f"vector_base/upto={upto}", ["year", "model"], "bibcode")
        seen = self.spark.createDataFrame([(upto, self._removed_marks())], "upto bigint, removed_marks bigint")
        seen.coalesce(1).write.mode("overwrite").parquet(self.path(f"vector_base_info/upto={upto}"))

    def _removed_marks(self) -> int:
        return self._read("removed", REMOVED).count() if self.exists("removed") else 0

    def _vector_base(self) -> int | None:
        """The newest complete snapshot of vectors, unless a block was removed since."""
        base = self._base("vector_base_info")
        if base is None or not self.exists(f"vector_base/upto={base}/_SUCCESS"):
            return None
        info = self.spark.read.parquet(self.path(f"vector_base_info/upto={base}")).first()
        return base if info["removed_marks"] == self._removed_marks() else None

    # ------------------------------------------------------------ catalog

    def append_catalog(self, run: int, fields_hash: str, prompt_hash: str) -> None:
        """Catalog and manifest rows of a run, numbered on from the earlier runs."""
        rows = self._without_removed(self.results(run).where(F.col("status") == "ok"), "run")
        earlier = self.manifest_log().where(F.col("version") < run)
        entries = C.append_entries(C.catalog_entries(rows, fields_hash, prompt_hash), earlier)
        self._write(entries.withColumn("created_at", F.current_timestamp()), "catalog", run, key="version", look_up="bibcode")
        made = C.manifests(rows).select(
            "year", "model", "dim", "count",
            F.lit(fields_hash).alias("fields_hash"), F.lit(prompt_hash).alias("prompt_hash"),
            F.current_timestamp().alias("created_at"), C.vector_file().alias("vector_file"),
        )
        self._write(made.coalesce(1), "manifests", run, key="version")
        self._mark_replaced(rows, run)

    def _mark_replaced(self, rows: DataFrame, run: int) -> None:
        """Earlier vectors of the run's records, so that searches leave them out.

        The log is scanned for a batch's records; a repeated run finds the same ones.
        """
        earlier = self._read("catalog", ENTRIES).where(F.col("version") < run)
        new = rows.groupBy("bibcode", "model").agg(F.max("year").alias("year"))
        old = earlier.select("bibcode", "model", F.col("version").alias("run"))
        self._write(old.join(new, ["bibcode", "model"]), "replaced", run, key="version")

    def catalog_log(self) -> DataFrame:
        log, base = self._read("catalog", ENTRIES), self._base("catalog_base")
        if base is None:
            return log
        merged = self.spark.read.schema(ENTRIES).parquet(self.path(f"catalog_base/upto={base}"))
        return merged.unionByName(log.where(F.col("version") > base))

    def _base(self, table: str) -> int | None:
        """The run up to which the newest complete snapshot reaches."""
        found = sorted(int(name.split("=")[1]) for name in self._folders(table) if name.startswith("upto="))
        complete = [upto for upto in found if self.exists(f"{table}/upto={upto}/_SUCCESS")]
        return complete[-1] if complete else None

    def catalog(self) -> DataFrame:
        """One row per (record, model); the latest run wins."""
        live = self._without_removed(self.catalog_log(), "version")
        return C.upsert(live).drop("replaced")

    def compact_catalog(self, upto: int) -> None:
        """Merge the runs up to one number into a base snapshot; readers switch when it is complete."""
        merged = C.upsert(self.catalog_log().where(F.col("version") <= upto)).drop("replaced")
        self._save(merged, f"catalog_base/upto={upto}", look_up="bibcode")

    def manifest_log(self) -> DataFrame:
        return self._without_removed(self._read("manifests", MANIFESTS), "version")

    def manifests(self) -> DataFrame:
        """One row per (year, model) over all runs."""
        latest = F.max(F.struct("version", "fields_hash", "prompt_hash", "created_at", "vector_file")).alias("last")
        rows = self.manifest_log().groupBy("year", "model")
        return rows.agg(F.max("dim").alias("dim"), F.sum("count").alias("count"), latest).select(
            "year", "model", "dim", "count",
            "last.fields_hash", "last.prompt_hash", "last.created_at", "last.vector_file",
        )

    def remove_year_model(self, year: int, model: str, run: int) -> bool:
        """Hide everything stored for (year, model) up to a run; true if there was anything."""
        had = not self.manifest_log().where((F.col("year") == year) & (F.col("model") == model)).isEmpty()
        mark = self.spark.createDataFrame([(year, model, run)], REMOVED)
        mark.write.mode("append").parquet(self.path("removed"))
        return had

    def _without_removed(self, rows: DataFrame, version: str) -> DataFrame:
        if not self.exists("removed"):
            return rows
        marks = self._read("removed", REMOVED).groupBy("year", "model").agg(F.max("version").alias("_removed"))
        joined = rows.join(F.broadcast(marks), ["year", "model"], "left")  # one row per year and model
        kept = joined.where(F.col("_removed").isNull() | (F.col(version) > F.col("_removed")))
        return kept.select(*rows.columns)

    # ------------------------------------------------------------ hashes

    def append_hashes(self, run: int, fields_hash: str) -> None:
        """Texts of a run count as seen, for its model and fields, once their vectors are stored."""
        rows = self.results(run).where(F.col("status") == "ok")
        seen = rows.select(
            "text_hash", F.col("bibcode").alias("first_seen_bibcode"), F.col("year").alias("first_seen_year"),
            "model", F.lit(fields_hash).alias("fields_hash"),
        )
        self._write(seen, "hashes", run, look_up="text_hash")
        sketched = rows.groupBy("model").agg(F.hll_sketch_agg("text_hash", SKETCH_BITS).alias("sketch"))
        sketched = sketched.select("model", F.lit(fields_hash).alias("fields_hash"), "sketch")
        self._write(sketched.coalesce(1), "hash_sketches", run)

    def hash_estimate(self, model: str | None = None, fields_hash: str | None = None) -> DataFrame:
        """About how many different texts were seen: ``estimated_unique_hashes``.

        Only the runs' sketches are read, one of a few kilobytes per run and model. A sketch
        can't forget: texts of a removed block still count.
        """
        rows = self._read("hash_sketches", SKETCHES)
        if model is not None:
            rows = rows.where(F.col("model") == model)
        if fields_hash is not None:
            rows = rows.where(F.col("fields_hash") == fields_hash)
        merged = rows.agg(F.hll_union_agg("sketch").alias("sketch"))
        estimate = F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)).cast("bigint")
        return merged.select(estimate.alias("estimated_unique_hashes"))

    def compact_hashes(self, upto: int) -> None:
        """Merge the seen texts of the runs up to one number into a snapshot with a folder per prefix.

        Within a folder files are ranges of hashes. Readers switch when it is complete.
        """
        rows = self._hash_log().where(F.col("run") <= upto).withColumn("prefix", F.substring("text_hash", 1, PREFIX_DIGITS))
        ordered = rows.repartitionByRange("prefix", "text_hash")
        self._save(ordered, f"hash_base/upto={upto}", ["prefix"], "text_hash")

    def _hash_log(self, wanted: DataFrame | None = None) -> DataFrame:
        """Seen texts of the newest snapshot and of the runs after it; with ``wanted`` what may hold its texts."""
        log, base = self._read("hashes", HASHES), self._base("hash_base")
        if base is not None:
            # whole runs are left out by their folder
            log = log.where(F.col("run") > base)
            merged = self.spark.read.schema(HASH_BASE).parquet(self.path(f"hash_base/upto={base}"))
        if wanted is None:
            return log if base is None else merged.drop("prefix").unionByName(log)
        asked = wanted.select("text_hash")
        if base is not None:
            # at most 16 ** PREFIX_DIGITS values
            prefixes = asked.select(F.substring("text_hash", 1, PREFIX_DIGITS).alias("prefix")).distinct().collect()
            merged = merged.where(F.col("prefix").isin([row["prefix"] for row in prefixes]))
            log = merged.drop("prefix").unionByName(log)
        named = [row["text_hash"] for row in asked.distinct().limit(NAMED_HASHES + 1).collect()]
        return log.where(F.col("text_hash").isin(named)) if len(named) <= NAMED_HASHES else log

    def hash_rows(
        self,
        before: int | None = None,
        model: str | None = None,
        fields_hash: str | None = None,
        wanted: DataFrame | None = None,
    ) -> DataFrame:
        """Seen texts; those of a removed (year, model) are free again.

        A file of a run has one model and one hash of fields, so these filters skip whole
        files. With ``wanted``, a stored table, only what may hold its ``text_hash`` values
        is read: folders by prefix, and for a small batch row groups by bloom filter.
        """
        rows = self._hash_log(wanted)
        if before is not None:
            rows = rows.where(F.col("run") < before)
        if model is not None:
            rows = rows.where(F.col("model") == model)
        if fields_hash is not None:
            rows = rows.where(F.col("fields_hash") == fields_hash)
        named = rows.withColumnRenamed("first_seen_year", "year")
        return self._without_removed(named, "run").withColumnRenamed("year", "first_seen_year")

    def hashes(
        self,
        before: int | None = None,
        wanted: DataFrame | None = None,
        model: str | None = None,
        fields_hash: str | None = None,
    ) -> DataFrame:
        """First-seen pair per text; with ``before`` as it stood before that run.

        With ``wanted`` only for its ``text_hash`` values, which keeps a small batch from
        grouping the whole store.
        """
        rows = self.hash_rows(before, model, fields_hash, wanted)
        if wanted is not None:
            rows = D.among(rows, wanted)
        # within-year dedup keeps a text once per year, so a text may have several rows
        first = F.min(F.struct("run", "first_seen_year", "first_seen_bibcode")).alias("first")
        return rows.groupBy("text_hash").agg(first).select(
            "text_hash", "first.first_seen_bibcode", "first.first_seen_year"
        )

    # ------------------------------------------------------------ footprint

    def footprint(self) -> DataFrame:
        """Per year and model: stored vectors, their components, and the bytes of the vectors on disk.

        The bytes are those of the column in the files, read from the files' footers by
        the tasks, so the store must be open to pyarrow's file systems as it is to Spark.
        """
        column = "half" if self.half_precision else "embedding"
        rows = self._read("vectors", VECTORS).where(F.col("status") == "ok")
        size = F.octet_length("half") / 2 if self.half_precision else F.size("embedding")
        counts = rows.groupBy("year", "model").agg(
            F.count(column).alias("vectors"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("components")
        )
        files = rows.select("year", "model", F.col("_metadata.file_path").alias("file")).distinct()
        measured = files.mapInArrow(_column_bytes(column), "year int, model string, bytes bigint")
        return counts.join(measured.groupBy("year", "model").agg(F.sum("bytes").alias("bytes")), ["year", "model"])

    # ------------------------------------------------------------ run log

    def write_run_log(self, run: int, model: str, fields_hash: str, started: float, ended: float, counters: DataFrame) -> None:
        """One row of figures for a run that ended; times are seconds since the epoch."""
        figures = counters.select(
            F.lit(model).alias("model"), F.lit(fields_hash).alias("fields_hash"),
            F.timestamp_micros(F.lit(int(started * 1e6))).alias("started_at"),
            F.timestamp_micros(F.lit(int(ended * 1e6))).alias("ended_at"),
            F.lit(ended - started).alias("seconds"), *counters.columns,
        )
        self._write(figures.coalesce(1), "run_log", run)

    def run_log(self) -> DataFrame:
        """Figures of all runs that ended."""
        return self._read("run_log", RUN_LOG)

    # ------------------------------------------------------------ bad lines

    def write_bad_lines(self, lines: DataFrame, run: int) -> None:
        self._write(lines, "bad_lines", run)

    def bad_lines(self) -> DataFrame:
        """Lines of streamed files that gave no record, with the reason."""
        return self._read("bad_lines", BAD_LINES)

    # ------------------------------------------------------------ runs

    def next_run(self) -> int:
        """One above every number in use."""
        used = [
            self._read("manifests", MANIFESTS).agg(F.max("version")),
            self._read("removed", REMOVED).agg(F.max("version")),
            self._read("runs", RUNS).agg(F.max("run")),
        ]
        prepared = [int(name.split("=")[1]) for name in self._folders("prepared") if name.startswith("run=")]
        return max([frame.first()[0] or 0 for frame in used] + prepared, default=0) + 1

    def run_of_batch(self, source: str, batch: int) -> int:
        """The run of a stream's micro-batch: the same one whenever the batch is repeated."""
        known = self._read("runs", RUNS).where((F.col("source") == source) & (F.col("batch") == batch)).first()
        if known is not None:
            return known["run"]
        run = self.next_run()
        row = self.spark.createDataFrame([(source, batch, run)], RUNS)
        row.coalesce(1).write.mode("append").parquet(self.path("runs"))
        return run


def _column_bytes(column: str):
    """Sizes of a column in Parquet files, from their footers."""

    def run(batches):
        for batch in batches:
            sizes = []
            for file in batch.column("file").to_pylist():
                system, path = arrow_fs.FileSystem.from_uri(file)
                with system.open_input_file(path) as source:
                    footer = pq.read_metadata(source)
                groups = (footer.row_group(g) for g in range(footer.num_row_groups))
                chunks = (group.column(c) for group in groups for c in range(group.num_columns))
                sizes.append(sum(c.total_compressed_size for c in chunks if c.path_in_schema.split(".")[0] == column))
            yield pa.RecordBatch.from_arrays(
                [batch.column("year"), batch.column("model"), pa.array(sizes, pa.int64())], ["year", "model", "bytes"]
            )

    return run
