"""Number-sequence study: do identifier numbers run in sequence?

For every group (record set) at once: parse identifiers to integers (0 = not a
plain integer), rank the numbers (0-based position after sort, per group, via the
distributed ``sorted_index``), summarise them, list repeats and gaps, and cut
rank/number windows. Quartiles use linear interpolation between the ranked values
at floor/ceil of (n - 1) * p, read from the ranked rows -- no group is collected
into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import to_int
from .ordered import sorted_index


def with_numbers(df: DataFrame, id_col: str, group_col: str, number_col: str = "number") -> DataFrame:
    """(group, catalognumber, number) with number = to_int(catalognumber)."""
    return df.select(F.col(group_col).alias("grp"),
                     F.col(id_col).cast("string").alias("catalognumber"),
                     to_int(F.col(id_col).cast("string")).alias(number_col))


def bad_counts(numbers: DataFrame) -> DataFrame:
    """Per group: records, identifiers equal to "0", numbers parsed as 0."""
    return numbers.groupBy("grp").agg(
        F.count("*").alias("n"),
        F.sum(F.when(F.col("catalognumber") == "0", 1).otherwise(0)).cast("bigint").alias("n_zero_text"),
        F.sum(F.when(F.col("number") == 0, 1).otherwise(0)).cast("bigint").alias("n_bad"))


def rank_numbers(numbers: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """(grp, rank, number, n): rank = 0-based position of number in its group, n = group size."""
    ranked = sorted_index(numbers.select("grp", "number"), ["number"], ["grp"],
                          index_col="rank", num_partitions=num_partitions, group_size_col="n")
    return ranked.select("grp", "rank", "number", "n")


def describe(ranked: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """count, mean, std (sample), min, quartiles (linear interpolation), max per group.

    The sample standard deviation comes from exact integer moments
    (n * sum(x^2) - sum(x)^2 in decimal(38,0)), rounded once; when those sums
    leave the decimal range it falls back to the streaming ``stddev_samp``.
    """
    x = F.col("number").cast("decimal(38,0)")
    aggs = [F.count("*").alias("count"), F.avg("number").alias("mean"),
            F.try_sum(x).alias("_s1"), F.try_sum(x * x).alias("_s2"),
            F.stddev_samp("number").alias("_std_stream"), F.min("number").alias("min")]
    for p in quantiles:
        h = (F.col("n") - 1).cast("double") * F.lit(p)
        lo = F.floor(h).cast("bigint")
        at_lo = F.max(F.when(F.col("rank") == lo, F.col("number")))
        at_hi = F.max(F.when(F.col("rank") == lo + 1, F.col("number")))
        frac = F.first(h - F.floor(h))
        name = f"p{int(round(p * 100))}"
        aggs.append(at_lo.alias(f"_{name}_lo"))
        aggs.append(at_hi.alias(f"_{name}_hi"))
        aggs.append(frac.alias(f"_{name}_f"))
    aggs.append(F.max("number").alias("max"))
    g = ranked.groupBy("grp").agg(*aggs)
    n = F.col("count").cast("decimal(38,0)")
    num = F.try_subtract(F.try_multiply(n, F.col("_s2")), F.try_multiply(F.col("_s1"), F.col("_s1")))
    exact = F.sqrt(num.cast("double") / (F.col("count") * (F.col("count") - 1)).cast("double"))
    std = F.when(F.col("count") > 1, F.coalesce(exact, F.col("_std_stream")))
    out = g.withColumn("std", std)
    cols = ["grp", "count", "mean", "std", "min"]
    for p in quantiles:
        name = f"p{int(round(p * 100))}"
        lo = F.col(f"_{name}_lo").cast("double")
        hi = F.coalesce(F.col(f"_{name}_hi"), F.col(f"_{name}_lo")).cast("double")
        out = out.withColumn(name, lo + (hi - lo) * F.col(f"_{name}_f"))
        cols.append(name)
    cols.append("max")
    return out.select(*cols)


def rank_slice(ranked: DataFrame, start: int, stop: int | None = None, drop_last: int = 0) -> DataFrame:
    """Rows with start <= rank < stop (stop None = to the end), minus the last ``drop_last``."""
    cond = F.col("rank") >= F.lit(start)
    if stop is not None:
        cond = cond & (F.col("rank") < F.lit(stop))
    if drop_last:
        cond = cond & (F.col("rank") < F.col("n") - F.lit(drop_last))
    return ranked.where(cond)


def tail(ranked: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest numbers of every group (the end of the sorted series)."""
    return ranked.where(F.col("rank") >= F.col("n") - F.lit(k))


def zoom(ranked: DataFrame, x_start: int, x_end: int, y_start: int, y_end: int) -> DataFrame:
    """Rank window [x_start, x_end) and number window [y_start, y_end]."""
    return ranked.where((F.col("rank") >= x_start) & (F.col("rank") < x_end)
                        & F.col("number").between(y_start, y_end))


def gaps(ranked: DataFrame, min_gap: int = 2) -> DataFrame:
    """Breaks in sequence: consecutive ranked numbers more than 1 apart.

    Every row is emitted twice, keyed by (group, rank) as itself and by
    (group, rank - 1) as the successor of the previous rank; one aggregation on
    those unique keys (hash exchange, balanced, no sort) pairs each number with
    the next one -- no group-wide lag window and no two-sided join.
    """
    typ = ranked.schema["number"].dataType
    this = ranked.select("grp", F.col("rank").alias("_k"), F.col("number").alias("_cur"),
                         F.lit(None).cast(typ).alias("_next"))
    succ = ranked.select("grp", (F.col("rank") - 1).alias("_k"), F.lit(None).cast(typ).alias("_cur"),
                         F.col("number").alias("_next"))
    pairs = this.unionByName(succ).groupBy("grp", "_k").agg(
        F.max("_cur").alias("number"), F.max("_next").alias("next_number"))
    return (pairs.where(F.col("number").isNotNull() & F.col("next_number").isNotNull())
            .select("grp", F.col("_k").alias("rank"), "number", "next_number",
                    (F.col("next_number") - F.col("number")).alias("gap"))
            .where(F.col("gap") >= min_gap))


def repeats(numbers: DataFrame) -> DataFrame:
    """Numbers occurring more than once in a group: (grp, number, count)."""
    return (numbers.groupBy("grp", "number").agg(F.count("*").alias("count"))
            .where(F.col("count") > 1))


def islands(numbers: DataFrame, min_length: int = 1) -> DataFrame:
    """Runs of consecutive numbers: (grp, first, last, n), n = records in the run.

    Over the distinct numbers of a group, number minus its (dense) rank is the same all
    along a run. The rank is the distributed ordinal; a run that spans range partitions
    is put together by the aggregation on (group, number - rank), partially aggregated,
    so a run of any length costs a row per task. ``min_length`` is in distinct numbers.
    """
    distinct = numbers.where(F.col("number").isNotNull()).groupBy("grp", "number").agg(F.count("*").alias("_records"))
    ranked = sorted_index(distinct, ["number"], ["grp"], index_col="_rank", unique=True)
    runs = ranked.groupBy("grp", (F.col("number") - F.col("_rank")).alias("_run")).agg(
        F.min("number").alias("first"), F.max("number").alias("last"), F.sum("_records").alias("n"))
    return runs.where(F.col("last") - F.col("first") + 1 >= min_length).select("grp", "first", "last", "n")


def slope_segments(ranked: DataFrame, width: int = 100) -> DataFrame:
    """Local slope of the number/rank curve over rank buckets of ``width`` rows.

    slope = (last - first number) / (last - first rank) per bucket: 1 = sequential,
    below 1 = repeats, above 1 = gaps.
    """
    b = ranked.withColumn("bucket", F.floor(F.col("rank") / F.lit(width)).cast("bigint"))
    g = b.groupBy("grp", "bucket").agg(
        F.min("rank").alias("first_rank"), F.max("rank").alias("last_rank"),
        F.min("number").alias("first_number"), F.max("number").alias("last_number"))
    span = (F.col("last_rank") - F.col("first_rank")).cast("double")
    return g.withColumn("slope", F.when(span > 0, (F.col("last_number") - F.col("first_number"))
                                        .cast("double") / span))
