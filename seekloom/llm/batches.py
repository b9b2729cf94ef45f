"""Bounded slices of Arrow batches, for functions given to ``mapInArrow``."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1024 * 1024


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a column's values in a slice have ``max_bytes`` together.

    A single longer value makes a slice of its own; no row is dropped and the order stays.
    After the last one the worker gives back what it no longer uses.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start, held = 0, 0
        for row, size in enumerate(sizes):
            if row > start and held + size > max_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        yield batch.slice(start)
    release_unused()


def release_unused() -> None:
    """Give free memory of this worker back to the system; else it is held while other stages run.

    That of numpy is the C library's, which has a call for it under Linux only.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The strings of a column; null is the empty string."""
    return [value or "" for value in batch.column(column).to_pylist()]


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )
