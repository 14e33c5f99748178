"""Small helpers the operators of this subpackage share.

Every operator reads only the columns it is given by name and renames them to
internal names first, so further columns of the input never clash with its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of the contracts: runs of anything but space, \t, \n, \v, \f, \r.
SPACE_CLASS = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"

# Python workers handle an Arrow batch in pieces of about this many text bytes.
CHUNK_BYTES = 1 << 20


def col(name: str) -> Column:
    """The column of exactly this name (dots and spaces are part of the name)."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns named c0, c1, ..., and the new names of ``names``.

    For operators that pass all columns on: their own names can't clash meanwhile;
    ``.toDF(*df.columns)`` gives the old names back.
    """
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), [f"c{df.columns.index(n)}" for n in names]


def spare_name(df: DataFrame, stem: str) -> str:
    """``stem``, lengthened until no column of ``df`` has the name."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def words(text: Column) -> Column:
    """Native: the words of a text in order; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_CLASS), "")


def text_chunks(batch: pa.RecordBatch, text_index: int,
                chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices of about ``chunk_bytes`` of text (one row at least)."""
    column = batch.column(text_index)
    lengths = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if i > start and held + n > chunk_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def chunked(batches: Iterable[pa.RecordBatch], text_index: int,
            chunk_bytes: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """``text_chunks`` over a stream of batches."""
    for batch in batches:
        yield from text_chunks(batch, text_index, chunk_bytes)


def tidied(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
           ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for mapInArrow; a worker gives what it no longer holds back to the system.

    Workers wait for the next task with the memory that the last one freed, and an
    executor's idle ones count beside those at work.
    """

    def then(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim:
            trim(0)

    return then
