"""Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from functools import cache

import pyarrow as pa

SLICE_BYTES = 8 << 20


def slices(batches: Iterable[pa.RecordBatch], most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that one slice holds about ``most`` bytes, or one row."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, rows * most // max(1, batch.nbytes))
        for at in range(0, rows, step):
            yield batch.slice(at, step)


def released(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; after the last one, memory that is free in this process goes back to the system.

    Spark keeps idle Python workers, and else each would keep what its largest task once took.
    """
    try:
        yield from rows
    finally:
        trim()


def trim() -> None:
    """Give memory that is free in this process back to the system."""
    pa.default_memory_pool().release_unused()
    if give_back := _trim():
        give_back(0)


@cache
def _trim():
    """``malloc_trim`` of the C library, where it has one."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None
