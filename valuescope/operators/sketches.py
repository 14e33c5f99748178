"""Mergeable summaries of the fields of a table: cardinalities and heavy values.

Cardinality: ``field_sketches`` stores one HyperLogLog sketch per field (and group, such
as source and epoch). Stored sketches of any groups are merged without reading rows
again, so the distinct values of all sources, or of the epochs up to now, come from a
few kilobytes a group.

Heavy values: every field's values are counted by hash bucket. A value that holds more
than a share of the rows puts its bucket above that share, so the buckets above it, at
most 1 / share a field, hold all heavy values; bucket counts are added to merge them.
One verifying pass then counts exactly, and only, the values in those buckets: no other
value crosses a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.parallel import spread
from ..plans.skew import bounded_broadcast
from .profile import _field_col, _quote, field_list

LG_K = 14             # 2^14 registers: a relative standard deviation of about 0.8 %
BUCKETS_A_SHARE = 64  # buckets for each 1 / share: few light values share a heavy bucket


def field_sketches(df: DataFrame, fields: Sequence[str] | None = None, by: Sequence[str] = (),
                   lg_k: int = LG_K, nested: bool = False) -> DataFrame:
    """(by..., field, sketch, nulls, rows): one pass, one sketch a field and group."""
    names = [n for n in (fields if fields is not None else field_list(df, nested)) if n not in set(by)]
    aggs: list[Column] = []
    for i, n in enumerate(names):
        value = _field_col(df, n).cast("string")
        aggs += [F.hll_sketch_agg(value, F.lit(lg_k)).alias(f"_s{i}"), F.count_if(value.isNull()).alias(f"_n{i}")]
    keys = [F.col(_quote(b)) for b in by]
    wide = df.groupBy(*keys).agg(*aggs, F.count("*").alias("rows"))
    each = F.array(*[F.struct(F.lit(n).alias("field"), F.col(f"_s{i}").alias("sketch"), F.col(f"_n{i}").alias("nulls"))
                     for i, n in enumerate(names)])
    return wide.select(*keys, F.explode(each).alias("_f"), "rows").select(*keys, "_f.*", "rows")


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of the same fields over coarser groups ``by``; the rows are not read."""
    return sketches.groupBy(*[F.col(_quote(b)) for b in by], "field").agg(
        F.hll_union_agg("sketch").alias("sketch"), F.sum("nulls").alias("nulls"), F.sum("rows").alias("rows"))


def sketched_cardinality(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by..., field, card): estimated distinct values, null counting as one value."""
    card = F.hll_sketch_estimate("sketch") + (F.col("nulls") > 0).cast("bigint")
    return sketches.select(*[F.col(_quote(b)) for b in by], "field", card.alias("card"))


def _values(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    picked = spread(df.select(*[_field_col(df, n).cast("string").alias(n) for n in fields]))
    return picked.unpivot([], [F.col(_quote(n)) for n in fields], "field", "value")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("field", "value"), F.lit(buckets)).cast("int")


def value_buckets(values: DataFrame, buckets: int) -> DataFrame:
    """(field, bucket, n): the mergeable summary of (field, value) rows, nulls included."""
    return values.groupBy("field", _bucket(buckets).alias("bucket")).agg(F.count("*").alias("n"))


def merge_buckets(summaries: DataFrame) -> DataFrame:
    """Sum of summaries made with the same number of buckets (of sources, of epochs)."""
    return summaries.groupBy("field", "bucket").agg(F.sum("n").alias("n"))


def bucket_count(share: float) -> int:
    return max(1024, int(BUCKETS_A_SHARE / share))


def heavy_values(df: DataFrame, share: float, fields: Sequence[str] | None = None,
                 summary: DataFrame | None = None) -> DataFrame:
    """(field, value, count, total): every value with more than ``share`` of a field's rows.

    Exact. ``summary`` may be given if it was kept (``value_buckets`` of the same rows
    with ``bucket_count(share)`` buckets, merged); then the rows are read once.
    """
    names = list(fields) if fields is not None else field_list(df)
    return heavy_of(_values(df, names), share, summary)


def heavy_of(values: DataFrame, share: float, summary: DataFrame | None = None) -> DataFrame:
    """``heavy_values`` of (field, value) rows, such as the tokens of texts."""
    buckets = bucket_count(share)
    summary = value_buckets(values, buckets) if summary is None else merge_buckets(summary)
    totals = summary.groupBy(F.col("field").alias("f2")).agg(F.sum("n").alias("total"))
    heavy = summary.join(totals, F.col("field") == F.col("f2")).where(F.col("n") > F.col("total") * F.lit(share))
    # At most 1 / share buckets a field; broadcast after a check of the size.
    known = bounded_broadcast(heavy.select("f2", F.col("bucket").alias("b2"), "total"))
    kept = values.withColumn("_b", _bucket(buckets)).join(known, (F.col("field") == F.col("f2")) & (F.col("_b") == F.col("b2")))
    counts = kept.groupBy("field", "value", "total").agg(F.count("*").alias("count"))
    return counts.where(F.col("count") > F.col("total") * F.lit(share)).select("field", "value", "count", "total")
