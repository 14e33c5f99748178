"""CSV records whose quoted values hold line ends, read in parallel from split files.

A quote toggles between "outside" and "inside" a quoted value (a doubled quote toggles
twice). Whether a line end ends a record depends on all quotes before it in the file:

1. One native pass counts the quotes of every file split; a running parity over the
   splits of a file (a few rows a file) gives the state in which each split begins.
2. Each task cuts the lines of its splits into records, each split from its known state.
   Only the two ragged ends of a split leave it: the lines that finish an earlier
   record, and those that begin one not finished there.
3. The ragged ends (at most two rows a split) are joined by the split in which their
   record begins.

Rows are never shuffled; a record may span any number of splits. A quote still open at the
end of its file ends no record: the lines from the record's first on are rejects, one each.
A ``\\r`` before a record's line end belongs to the line end, any other to the value.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.skew import MAX_BROADCAST_BYTES
from ..session import pin
from . import csvtext

_RECORD, _HEAD, _TAIL = 0, 1, 2  # a whole record; lines that end one; lines that begin or continue one


@dataclass
class QuotedRecords:
    records: DataFrame   # value: one record, line ends inside quotes kept
    unclosed: DataFrame  # value: lines of records whose quote is never closed


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, block, at, value): lines with their file split and order within it."""
    return spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), "value")


def split_states(lines: DataFrame) -> DataFrame:
    """(file, block, open): whether a split begins inside a quoted value."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    splits = lines.groupBy("file", "block").agg(F.sum(quotes.cast("bigint")).alias("quotes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("open"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches (file, block, open, value) in file order -> (file, block, kind, value)."""
    split, inside, head, held = None, False, False, []

    def handed(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), (), ()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
            names=["file", "block", "kind", "value"])

    def record(kind: int) -> tuple:
        value = "\n".join(held)
        held.clear()
        return (*split, kind, value.removesuffix("\r") if kind != _TAIL else value)

    for batch in batches:
        files, blocks, states = (batch.column(i) for i in range(3))
        values = batch.column(3)
        odd = (pc.count_substring(values, '"').to_numpy(zero_copy_only=False) & 1).astype(bool)
        # Places where a split begins in this batch.
        starts = [0, *(np.flatnonzero(
            pc.or_(pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)),
                   pc.not_equal(blocks.slice(1), blocks.slice(0, len(blocks) - 1))).to_numpy(zero_copy_only=False)) + 1)]
        texts, out = values.to_pylist(), []
        for a, b in zip(starts, [*starts[1:], len(texts)]):
            if a == b:
                continue
            here = (files[a].as_py(), blocks[a].as_py())
            if here != split:
                if held:
                    out.append(record(_TAIL))
                split, inside = here, states[a].as_py()
                head = inside
            after = np.logical_xor.accumulate(odd[a:b]) ^ inside   # state after each line
            for text, still in zip(texts[a:b], after.tolist()):
                held.append(text)
                if not still:
                    out.append(record(_HEAD if head else _RECORD))
                    head = False
            inside = bool(after[-1])
        if out:
            yield handed(out)
    if held:
        yield handed([record(_TAIL)])


def _joined(ends: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The records that ragged ends make up, and the lines of the unclosed rest."""
    order = Window.partitionBy("file").orderBy("block", "kind")
    # Heads come before tails in a split. A record begins at a tail that follows a head, a
    # split that began outside, or nothing; ``first`` marks those.
    first = (F.col("kind") == _TAIL) & ~F.col("open")
    marked = pin(ends.withColumn("number", F.sum(first.cast("int")).over(order)))
    closed = marked.where(F.col("kind") == _HEAD).select(F.col("file").alias("f4"), F.col("number").alias("n4")).distinct()
    same = (F.col("file") == F.col("f4")) & (F.col("number") == F.col("n4"))
    parts = F.array_sort(F.collect_list(F.struct("block", "kind", "value")))
    made = marked.join(closed, same, "left_semi").groupBy("file", "number").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value")).select("value")
    # The rest of a file after an unclosed quote is never put together.
    return made, marked.join(closed, same, "left_anti").select(F.explode(F.split("value", "\n")).alias("value"))


def read_quoted_records(spark: SparkSession, path: str | Sequence[str]) -> QuotedRecords:
    """Records of CSV text files (RFC 4180 quoting), cut in parallel."""
    lines = _lines(spark, path)
    states = pin(split_states(lines))
    small = int(str(states._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= MAX_BROADCAST_BYTES
    known = F.broadcast(states) if small else states
    joined = lines.join(known.select(F.col("file").alias("f2"), F.col("block").alias("b2"), "open"),
                        (F.col("file") == F.col("f2")) & (F.col("block") == F.col("b2")))
    if not small:  # a shuffle join brings each split to one task; its order is restored
        joined = joined.sortWithinPartitions("file", "block", "at")
    pieces = pin(joined.select("file", "block", "open", "value").mapInArrow(
        _cut, "file string, block long, kind int, value string"))
    ends = pieces.where(F.col("kind") != _RECORD)
    # A tail continues an earlier record if its split began inside and had no head.
    heads = ends.where(F.col("kind") == _HEAD).select(F.col("file").alias("f3"), F.col("block").alias("b3"))
    ends = ends.join(states.select(F.col("file").alias("f2"), F.col("block").alias("b2"), "open"),
                     (F.col("file") == F.col("f2")) & (F.col("block") == F.col("b2")))
    ends = ends.join(heads, (F.col("file") == F.col("f3")) & (F.col("block") == F.col("b3")), "left").select(
        "file", "block", "kind", "value", (F.col("open") & (F.col("f3").isNull() | (F.col("kind") == _HEAD))).alias("open"))
    made, unclosed = _joined(ends)
    whole = pieces.where(F.col("kind") == _RECORD).select("value")
    return QuotedRecords(whole.unionByName(made), unclosed)


def read_csv_quoted(spark: SparkSession, path: str | Sequence[str], strict: bool = False) -> csvtext.ParsedCsv:
    """``csvtext.read_csv_records`` for files whose quoted values may hold line ends.

    The header is the first line of the first file (names without line ends); records equal
    to it are dropped wherever they occur. Lines of unclosed records are rejects; in strict
    mode they fail the job.
    """
    found = read_quoted_records(spark, path)
    parsed = csvtext.parse_lines(found.records, strict=strict, header_line=csvtext.first_file_line(spark, path).removesuffix("\r"))
    if strict:
        n = found.unclosed.count()
        if n:
            raise ValueError(f"{n} lines of records whose quote is never closed")
        return parsed
    problems = found.unclosed.select(F.concat(F.lit("PROBLEM WITH: "), F.col("value")).alias("value"))
    return csvtext.ParsedCsv(parsed.good, parsed.rejects.unionByName(problems), parsed.header)
