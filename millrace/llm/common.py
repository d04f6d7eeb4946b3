"""Helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import SparkSession, functions as F

from ..sources.store import FEW, discard, few, materialize, scratch, shared_dir  # noqa: F401

#: Lower-cases A-Z only, on code points (the contracts leave other letters alone).
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = ASCII_UPPER.lower()
#: The same on UTF-8 bytes, for ``bytes.translate``.
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Separators of ``[^\x20\x09-\x0D]+`` all become a blank, A-Z are lower-cased.
SPACE_WORDS = bytes(32 if 9 <= b <= 13 else LOWER_BYTES[b] for b in range(256))
#: Words of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``: digits, a-z and all non-ASCII bytes.
ALNUM_WORDS = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in LOWER_BYTES
)


def lower_ascii(col):
    """Lower-case A-Z only; null counts as the empty text."""
    return F.translate(F.coalesce(col, F.lit("")), ASCII_UPPER, ASCII_LOWER)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batches, rows: int = 256, octets: int = 4 << 20):
    """Cut Arrow batches: as Python objects a whole one can be ten times as large.

    A slice has at most so many rows and, unless it is one row, bytes. At the
    end what the allocators still hold goes back to the system, as the worker
    process lives on for other tasks.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            todo = [batch.slice(at, rows)]
            while todo:
                part = todo.pop()
                half = part.num_rows // 2
                if half and part.nbytes > octets:
                    todo += [part.slice(half), part.slice(0, half)]
                else:
                    yield part
    trim()


def trim(collect: bool = True) -> None:
    """Give memory that is free back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    if collect:
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library
