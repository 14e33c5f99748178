"""Exact-size subsets by order-statistic selection.

The n-th key of an order is found without sorting rows: a histogram of the key range is
counted (one aggregation, at most ``BUCKETS`` rows to the driver), the bucket that holds
the n-th row becomes the new range, and so on until one value is left. Only the key
columns are read, and after the first histogram only the rows of one bucket, which are
written to the shared folder. Ties on the last key are settled by the next key and at
the end by a row id, so the subset has exactly n rows. The rows themselves are then
filtered by the threshold found: no sort, no shuffle of whole rows, no task that holds n
of them.

Whole numbers, dates, timestamps and booleans are counted as numbers, texts by their
UTF-8 bytes, ``CHUNK`` at a time from the first place where those left differ. Other orderable types take the distributed
``sorted_index`` over that key alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.parallel import has_shuffle
from ..session import pin
from .ordered import sorted_index

BUCKETS = 4096   # rows of one histogram
CHUNK = 7        # bytes of a text looked at a time: 56 bits, and 3 for how many there are
HASH_BITS = 60
_ID = "_vs_id"
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@dataclass
class Threshold:
    """The n-th row of an order: its key values and its row id; all: fewer rows than asked for."""

    values: list
    row_id: int | None
    all: bool = False


def key_hash(key: Column, seed: int = 42) -> Column:
    """60 bits of the MD5 of seed and key text, as bigint (null counts as empty)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def _code(kind: T.DataType, c: Column) -> Column | None:
    """Order-preserving bigint of a whole number, boolean, date or timestamp; else None."""
    if isinstance(kind, (*_WHOLE, T.BooleanType)):
        return c.cast("bigint")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c)
    if isinstance(kind, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)
    return None


def _nth_number(rows: DataFrame, code: Column, n: int) -> tuple[int, int, DataFrame]:
    """(value of the n-th smallest ``code``, rows below it, the rows that have it).

    ``code`` is a bigint without nulls; n counts from 1 and is at most the row count.
    """
    rows = rows.withColumn("_code", code)
    low, high = rows.agg(F.min("_code"), F.max("_code")).first()
    below, narrow = 0, False
    while low < high:
        width = (high - low) // BUCKETS + 1
        # In decimals: the range may be wider than a bigint.
        bucket = F.floor((F.col("_code").cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")) / F.lit(width).cast("decimal(20,0)"))
        table = rows.groupBy(bucket.cast("int").alias("b")).agg(
            F.count("*").alias("n"), F.min("_code").alias("low"), F.max("_code").alias("high")).orderBy("b").collect()
        for b in table:
            if below + b["n"] >= n:
                break
            below += b["n"]
        low, high = b["low"], b["high"]
        rows = rows.where(F.col("_code").between(low, high))
        if not narrow and low < high:
            rows, narrow = pin(rows), True
    return low, below, rows.drop("_code")


def _text_code(data: Column, at: int) -> Column:
    """Order-preserving number of the bytes at ``at`` and how many there are."""
    piece = F.substring(data, at + 1, CHUNK)
    value = F.conv(F.rpad(F.hex(piece), 2 * CHUNK, "0"), 16, 10).cast("bigint")
    return value * 8 + F.length(piece)


def _nth_text(rows: DataFrame, column: str, n: int) -> tuple[bytes, int, DataFrame]:
    below, data = 0, F.col(column).cast("binary")
    while True:
        # What the least and the greatest text left have in common, all texts left have.
        low, high = (bytes(x) for x in rows.agg(F.min(data), F.max(data)).first())
        if low == high:
            return low, below, rows
        shared = next((k for k, (x, y) in enumerate(zip(low, high)) if x != y), min(len(low), len(high)))
        _, under, rows = _nth_number(rows, _text_code(data, shared), n - below)
        below += under


def _nth(rows: DataFrame, column: str, n: int) -> tuple[object, int, DataFrame]:
    """``_nth_number`` for a column of any orderable type, nulls first."""
    kind = rows.schema[column].dataType
    nulls = rows.where(F.col(column).isNull()).count() if rows.schema[column].nullable else 0
    if n <= nulls:
        return None, 0, rows.where(F.col(column).isNull())
    rows = rows.where(F.col(column).isNotNull())
    c = F.col(column)
    if (code := _code(kind, c)) is not None:
        value, below, rows = _nth_number(rows, code, n - nulls)
    elif isinstance(kind, (T.StringType, T.BinaryType)):
        value, below, rows = _nth_text(rows, column, n - nulls)
    else:
        rows = pin(rows)
        value = sorted_index(rows.select(column), [column], index_col="_at").where(F.col("_at") == n - nulls - 1).first()[0]
        below = rows.where(c < F.lit(value)).count()
        rows = rows.where(c.eqNullSafe(F.lit(value)))
    return value, nulls + below, rows


def nth_row(rows: DataFrame, columns: list[str], n: int, total: int | None = None) -> Threshold:
    """The n-th row (from 1) of ``rows`` in the order of ``columns``, then of its row id."""
    total = rows.count() if total is None else total
    if n >= total:
        return Threshold([], None, all=True)
    left, values = rows.select(*[F.col(f"`{c}`") for c in columns], _ID), []
    for c in columns:
        value, below, left = _nth(left, c, n)
        values.append(value)
        n -= below
    row_id, _, _ = _nth_number(left, F.col(_ID), n)
    return Threshold(values, row_id)


def _with_ids(df: DataFrame) -> DataFrame:
    # Row ids are the same on every run only for rows in a fixed order: those of files.
    return (pin(df) if has_shuffle(df) else df).withColumn(_ID, F.monotonically_increasing_id())


def _up_to(df: DataFrame, columns: list[str], found: Threshold) -> Column:
    """Rows not after the threshold, as a filter (nulls first)."""
    keep = F.col(_ID) <= F.lit(found.row_id)
    for c, value in reversed(list(zip(columns, found.values))):
        here = F.col(f"`{c}`")
        if value is None:
            keep = here.isNull() & keep
        else:
            kind = df.schema[c].dataType
            code = _code(kind, here)
            at = F.lit(value.decode() if isinstance(kind, T.StringType) and isinstance(value, bytes) else value)
            code = here if code is None else code
            keep = here.isNull() | (code < at) | ((code == at) & keep)
    return keep


def first_rows(df: DataFrame, n: int, *order_cols: str) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): the first in ``order_cols`` order,
    ascending, nulls first. The result is not sorted. Further ties are settled by the
    place of the row in its input, so reruns over the same files agree."""
    if n <= 0:
        return df.where(F.lit(False))
    rows = _with_ids(df)
    found = nth_row(rows, list(order_cols), n)
    return df if found.all else rows.where(_up_to(rows, list(order_cols), found)).drop(_ID)


def exact_sample(df: DataFrame, n: int, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows (all, if there are fewer): those with the least hash of ``key``.

    Ties of the hash (rows repeating a key) are settled by the key and the place of the
    row. The sample of a smaller n is part of that of a larger one.
    """
    if n <= 0:
        return df.where(F.lit(False))
    rows = _with_ids(df).withColumn("_vs_hash", key_hash(F.col(f"`{key}`"), seed))
    found = nth_row(rows, ["_vs_hash", key], n)
    return df if found.all else rows.where(_up_to(rows, ["_vs_hash", key], found)).drop(_ID, "_vs_hash")
