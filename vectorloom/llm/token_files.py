"""Token files: ids in zstandard frames with a seek table, one file per range of documents.

Layout of a file (little-endian; the seekable form of the zstandard format):

* data frames, each an independent zstandard frame of up to ``FRAME_BYTES`` of ids;
* a skippable frame with the document index: identifiers (int64) and token counts (uint32),
  compressed; documents follow one another, so a count places its document;
* a skippable frame with the seek table: for each data frame its compressed size, its
  size, and the low 32 bits of the xxh64 of its content; then the number of frames, a
  byte of flags and a magic number.

A reader fetches the tail, then only the frames that hold a requested document.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vectorloom.llm.common import id_and_text, map_rows, stored
from vectorloom.llm.pretokens import library_ids, library_words
from vectorloom.session import shared_folder

# Fixed values of the format.
INDEX_MAGIC = 0x184D2A50
TABLE_MAGIC = 0x184D2A5E
END_MAGIC = 0x8F92EAB1
CHECKSUMS = 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("stored", "<u4"), ("size", "<u4"), ("checksum", "<u4")])

FRAME_BYTES = 1 << 18
DOCS_PER_READ = 1 << 13
NO_ID = -(1 << 63)  # stands for a null identifier
TEXT_BYTES = 1 << 20


class TokenFileWriter:
    """Writes documents one by one; holds one frame and the index in memory."""

    def __init__(self, out, dtype, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.out, self.dtype, self.frame_bytes = out, np.dtype(dtype).newbyteorder("<"), frame_bytes
        self.compress = zstandard.ZstdCompressor(level=level, write_content_size=True).compress
        self.buffer, self.held = [], 0
        self.frames, self.ids, self.counts = [], [], []

    def add(self, doc_id: int, ids: np.ndarray) -> None:
        data = ids.astype(self.dtype, copy=False).tobytes()
        if self.held and self.held + len(data) > self.frame_bytes:
            self._flush()  # a document starts a new frame rather than being split
        self.ids.append(doc_id)
        self.counts.append(len(ids))
        for at in range(0, len(data), self.frame_bytes):
            part = data[at : at + self.frame_bytes]
            if self.held + len(part) > self.frame_bytes:
                self._flush()
            self.buffer.append(part)
            self.held += len(part)

    def _flush(self) -> None:
        data = b"".join(self.buffer)
        packed = self.compress(data)
        self.out.write(packed)
        self.frames.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.buffer, self.held = [], 0

    def close(self) -> None:
        if self.held:
            self._flush()
        index = np.array(self.ids, "<i8").tobytes() + np.array(self.counts, "<u4").tobytes()
        index = struct.pack("<IB", len(self.ids), self.dtype.itemsize) + self.compress(index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(index)) + index)
        table = np.array(self.frames, ENTRY).tobytes() + FOOTER.pack(len(self.frames), CHECKSUMS, END_MAGIC)
        self.out.write(struct.pack("<II", TABLE_MAGIC, len(table)) + table)


class TokenFileReader:
    """Reads single documents or ranges; decompresses and checks only the frames they lie in."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        count, flags, magic = FOOTER.unpack(self._read(size - FOOTER.size, FOOTER.size))
        if magic != END_MAGIC or flags != CHECKSUMS:
            raise ValueError("not a token file, or one cut off")
        table_at = size - FOOTER.size - count * ENTRY.itemsize
        self.frames = np.frombuffer(self._read(table_at, count * ENTRY.itemsize), ENTRY)
        self.stored_at = np.concatenate([[0], np.cumsum(self.frames["stored"], dtype=np.int64)])
        self.bytes_at = np.concatenate([[0], np.cumsum(self.frames["size"], dtype=np.int64)])
        index_at = int(self.stored_at[-1])
        index = self._read(index_at, table_at - 8 - index_at)
        n, width = struct.unpack_from("<IB", index, 8)
        self.dtype = np.dtype(f"<u{width}")
        index = zstandard.ZstdDecompressor().decompress(index[13:], max_output_size=12 * n)
        self.ids = np.frombuffer(index, "<i8", n)
        self.counts = np.frombuffer(index, "<u4", n, 8 * n)
        self.starts = np.concatenate([[0], np.cumsum(self.counts, dtype=np.int64)])
        self.decompress = zstandard.ZstdDecompressor().decompress
        self.last = (-1, b"")

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def _frame(self, number: int) -> bytes:
        if self.last[0] != number:
            packed = self._read(int(self.stored_at[number]), int(self.frames["stored"][number]))
            data = self.decompress(packed)
            if xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != self.frames["checksum"][number]:
                raise ValueError(f"frame {number} is damaged")
            self.last = (number, data)
        return self.last[1]

    def tokens(self, place: int) -> np.ndarray:
        """Ids of the document at a place of the index."""
        start, end = (int(self.starts[place + i]) * self.dtype.itemsize for i in (0, 1))
        parts, number = [], int(np.searchsorted(self.bytes_at, start, "right")) - 1
        while start < end:
            base, stop = int(self.bytes_at[number]), int(self.bytes_at[number + 1])
            parts.append(self._frame(number)[start - base : min(end, stop) - base])
            start = min(end, stop)
            number += 1
        return np.frombuffer(b"".join(parts), self.dtype)

    def find(self, doc_id: int) -> np.ndarray:
        """Ids of the first document with this identifier; the index is in ascending order."""
        place = int(np.searchsorted(self.ids, doc_id))
        if place == len(self.ids) or self.ids[place] != doc_id:
            raise KeyError(doc_id)
        return self.tokens(place)


def encoded(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Identifiers and ids by the tokenizers library, a few texts at a time."""
    for batch in batches:
        step = max(1, batch.num_rows * TEXT_BYTES // max(1, batch.nbytes))
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part.column("doc_id").to_pylist(), library_ids(path, part.column("text").to_pylist())


def _write(batches, folder: str, path: str, end_id: int):
    task = TaskContext.get()
    system, root = fs.FileSystem.from_uri(folder)
    final = f"{root}/part-{task.partitionId():06d}.tokens"
    trial = f"{root}/.trial-{task.partitionId():06d}-{task.taskAttemptId()}"
    writer, out = None, None
    for ids, tokens in encoded(batches, path):
        if writer is None:
            system.create_dir(root, recursive=True)
            out = system.open_output_stream(trial)
            writer = TokenFileWriter(out, library_words(path).dtype)
        for doc_id, own in zip(ids, tokens):
            writer.add(NO_ID if doc_id is None else doc_id, np.append(own, own.dtype.type(end_id)))
    if writer is None:
        return
    writer.close()
    out.close()
    system.move(trial, final)  # a repeated task puts the same file in its place
    yield pa.RecordBatch.from_pydict(
        {
            "part": pa.array([task.partitionId()], pa.int32()),
            "file": [f"part-{task.partitionId():06d}.tokens"],
            "n_docs": pa.array([len(writer.ids)], pa.int64()),
            "n_tokens": pa.array([sum(writer.counts)], pa.int64()),
        }
    )


def write_token_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0, id_col="doc_id", text_col="text"
) -> DataFrame:
    """Encode whole texts and write them in ascending ``doc_id`` order; gives the manifest.

    One file per task, numbered in order: ``part, file, n_docs, n_tokens``. Every document
    gets ``end_id`` at its end; null and empty texts have only that. Null identifiers come
    first; repeated identifiers are ordered by text. Each file is written under a trial
    name and moved when complete, so a task can be repeated. ``folder`` is a path or URI
    that all tasks can write through pyarrow's file systems. An empty table writes nothing.
    """
    rows = id_and_text(docs, id_col, text_col)
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first(), "text"
    )
    schema = "part int, file string, n_docs bigint, n_tokens bigint"
    return stored(map_rows(ordered, _write, schema, folder, tokenizer, end_id), "token-manifest")


def _read(batches, folder: str):
    system, root = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for row in batch.to_pylist():
            with system.open_input_file(f"{root}/{row['file']}") as source:
                reader = TokenFileReader(source)
                first, last = row["first"], min(row["first"] + DOCS_PER_READ, row["n_docs"])
                crcs = [zlib.crc32(reader.tokens(i).astype("<u4").tobytes()) for i in range(first, last)]
                ids = [None if i == NO_ID else i for i in reader.ids[first:last].tolist()]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array(ids, pa.int64()),
                        "start": pa.array(reader.starts[first:last] + row["before"]),
                        "n_tokens": pa.array(reader.counts[first:last].astype(np.int64)),
                        "ids_crc32": pa.array(crcs, pa.int64()),
                        "part": pa.array([row["part"]] * len(ids), pa.int32()),
                    }
                )


def read_token_files(spark, folder: str, manifest: DataFrame) -> DataFrame:
    """Every document of the files: ``doc_id, start, n_tokens, ids_crc32, part``.

    A task reads a range of documents and only its frames. ``start`` adds up the tokens
    of the files before; that window runs over the manifest, one row per file.
    """
    before = F.coalesce(F.sum("n_tokens").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = manifest.withColumn("before", before).select(
        "part", "file", "n_docs", "before", F.explode(F.expr(f"sequence(0, n_docs - 1, {DOCS_PER_READ})")).alias("first")
    )
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint, part int"
    return map_rows(ranges.repartition(tasks, "part", "first"), _read, schema, folder)


def documents_by_id(folder: str, files: Sequence[str], doc_ids: Sequence[int]) -> dict[int, np.ndarray]:
    """Ids of a few documents, read directly: their frames are all that is decompressed."""
    system, root = fs.FileSystem.from_uri(folder)
    found = {}
    for file in files:
        with system.open_input_file(f"{root}/{file}") as source:
            reader = TokenFileReader(source)
            held = set(reader.ids.tolist())
            found |= {i: reader.find(i) for i in doc_ids if i in held}
    return found


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """Write token files to the shared folder and read all of them back."""
    folder = shared_folder(docs.sparkSession, "token-files")
    return read_token_files(docs.sparkSession, folder, write_token_files(docs, folder, tokenizer, end_id))
