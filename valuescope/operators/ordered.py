"""Ordered computations without single-task windows.

``sorted_index`` gives every row its 0-based position in a sort order, within
optional groups, as a distributed job:

1. range-partition on (group keys, order keys, unique tie-break) and sort within
   partitions; a partition-local ordinal comes from ``monotonically_increasing_id``;
2. pin the result with a reliable checkpoint (range bounds are sampled, so a
   recomputation could move rows between partitions);
3. count rows per (partition, group) -- at most partitions + groups rows -- and
   turn the counts into offsets with a window over that small table;
4. broadcast the offsets (size checked) and add them to the local ordinals.

A group of any size (a third of all rows) is spread over many range partitions,
so no task ever holds a whole group. The cumulation of a value profile is built
on it through frequency classes: values of one field with the same count form a
class, the running record total of the classes is a window over a table whose
size per field is at most sqrt(2 * records), and inside a class the running total
is count * (rank in class + 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.parallel import has_shuffle
from ..plans.skew import bounded_broadcast
from ..session import pin

# Spark's default size of a relation it knows nothing about is the largest long.
UNKNOWN_BYTES = 1 << 60
_MID = "_vs_mid"
_TB = "_vs_tb"


def range_partitions(df: DataFrame) -> int:
    """Range partitions for ``df``: its estimated size over the advisory partition
    size, at least the default parallelism (or the shuffle partitions, if fewer).

    The estimate of a plan with joins or generators can be far too large, so it counts
    as four times the size of the tables below at most.
    """
    spark = df.sparkSession
    lower = min(int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.sparkContext.defaultParallelism))
    advisory = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    target = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(advisory))
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    below = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    if any(n >= UNKNOWN_BYTES for n in below):  # rows from the driver or an RDD: no estimate
        return max(lower, int(spark.conf.get("spark.sql.shuffle.partitions")))
    size = min(int(str(plan.stats().sizeInBytes())), 4 * sum(below))
    return max(lower, -(-size // max(target, 1)))


def _ranged_blocks(df: DataFrame, order_by: Sequence[str | Column], group_by: Sequence[str],
                   num_partitions: int | None, unique: bool) -> tuple[DataFrame, DataFrame]:
    """Pinned range-sorted rows with local ordinals, and the small per-block table.

    The block table has one row per (range partition, group) present:
    _vs_pid, group keys, _vs_n (rows), _vs_first (first local ordinal),
    _vs_off (rows of the group in earlier partitions).
    """
    parts = num_partitions or range_partitions(df)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    keys = [F.col(g) for g in group_by] + order_cols
    base = df
    if not unique:
        # Unique tie-break so that rows with equal keys (a hot value) still spread
        # over range partitions. Row ids are only reproducible on a deterministic
        # input order (file scans); an input that went through a shuffle is
        # materialised first so that retried tasks see the same ids.
        if has_shuffle(base):
            base = pin(base)
        base = base.withColumn(_TB, F.monotonically_increasing_id())
        keys = keys + [F.col(_TB)]
    ranged = (base.repartitionByRange(parts, *keys)
              .sortWithinPartitions(*keys)
              .withColumn(_MID, F.monotonically_increasing_id()))
    ranged = pin(ranged)
    pid = F.shiftright(F.col(_MID), 33)
    ranged = (ranged.withColumn("_vs_pid", pid)
              .withColumn("_vs_loc", F.col(_MID) - F.shiftleft(pid, 33)))
    blocks = ranged.groupBy("_vs_pid", *group_by).agg(
        F.count("*").alias("_vs_n"), F.min("_vs_loc").alias("_vs_first"))
    before = Window.partitionBy(*group_by).orderBy("_vs_pid").rowsBetween(
        Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_vs_off", F.coalesce(F.sum("_vs_n").over(before), F.lit(0)))
    return ranged, blocks


def _join_blocks(ranged: DataFrame, blocks: DataFrame, group_by: Sequence[str],
                 carry: Sequence[str]) -> DataFrame:
    """Broadcast-join the (size-checked) block table back to the pinned rows.

    Output: every column of ``ranged`` plus ``_b_off``, ``_b_first`` and the
    ``carry`` columns of ``blocks`` (renamed ``_b_<name>``).
    """
    gnames = [f"_b_g{i}" for i in range(len(group_by))]
    sel = [F.col("_vs_pid").alias("_b_pid")] + [F.col(g).alias(b) for g, b in zip(group_by, gnames)]
    sel += [F.col("_vs_off").alias("_b_off"), F.col("_vs_first").alias("_b_first")]
    sel += [F.col(c).alias(f"_b_{c}") for c in carry]
    # At most (partitions + groups) rows; broadcast only after checking that bound.
    small = bounded_broadcast(blocks.select(*sel))
    cond = F.col("_vs_pid") == F.col("_b_pid")
    for g, b in zip(group_by, gnames):
        cond = cond & F.col(g).eqNullSafe(F.col(b))
    return ranged.join(small, cond, "inner")


def sorted_index(df: DataFrame, order_by: Sequence[str | Column], group_by: Sequence[str] = (),
                 index_col: str = "idx", num_partitions: int | None = None,
                 unique: bool = False, group_size_col: str | None = None) -> DataFrame:
    """Add ``index_col``: 0-based position of the row in ``order_by`` order within ``group_by``.

    Ascending order, NULLs first (Spark's default). Rows equal on all order keys
    get consecutive positions in arbitrary order unless ``unique`` says the keys
    are already unique. ``group_size_col`` optionally adds the group's row count.
    """
    ranged, blocks = _ranged_blocks(df, order_by, group_by, num_partitions, unique)
    carry = []
    if group_size_col:
        blocks = blocks.withColumn("size", F.sum("_vs_n").over(Window.partitionBy(*group_by)))
        carry.append("size")
    joined = _join_blocks(ranged, blocks, group_by, carry)
    out_cols = [F.col("`" + c + "`") for c in df.columns]
    out_cols.append((F.col("_b_off") + F.col("_vs_loc") - F.col("_b_first")).alias(index_col))
    if group_size_col:
        out_cols.append(F.col("_b_size").alias(group_size_col))
    return joined.select(*out_cols)


def _valued(profile: DataFrame) -> DataFrame:
    # Blank and NULL values are not part of a frequency curve.
    return profile.where(F.col("value").isNotNull() & (F.col("value") != ""))


def frequency_classes(profile: DataFrame) -> DataFrame:
    """(field, count, n_values): how many values of a field occur exactly ``count`` times."""
    return (_valued(profile).groupBy("field", "count")
            .agg(F.count("*").alias("n_values")))


def cumulate(profile: DataFrame, num_partitions: int | None = None,
             keys: Sequence[str] = ("field",)) -> DataFrame:
    """Cumulative record curve per field, values in ascending frequency.

    Input: long profile (field, value, count). Output columns:
    field, value, count, cum_count, cum_perc_pop, x, x_perc with
    ``cum_count`` = running sum of count ordered by (count, value), ``x`` the
    0-based ordinal in that order, percentages of the field's records and values.

    Values are ranked inside their frequency class (field, count) by the
    distributed ``sorted_index`` machinery; the class table is derived from its
    small per-block table (no extra pass over the values), gets its running
    totals from a window partitioned by field, and travels back with the block
    offsets in one size-checked broadcast join.
    """
    keys = list(keys)
    prof = _valued(profile).select(*keys, "value", F.col("count").cast("bigint").alias("count"))
    groups = [*keys, "count"]
    ranged, blocks = _ranged_blocks(prof, ["value"], groups, num_partitions, unique=True)
    classes = blocks.groupBy(*groups).agg(F.sum("_vs_n").alias("_vs_nv"))
    by_count = Window.partitionBy(*keys).orderBy("count")
    earlier = by_count.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    classes = (classes
               .withColumn("_vs_recs", F.col("count") * F.col("_vs_nv"))
               .select(*keys, "count",
                       F.coalesce(F.sum("_vs_nv").over(earlier), F.lit(0)).alias("vals_before"),
                       F.coalesce(F.sum("_vs_recs").over(earlier), F.lit(0)).alias("recs_before"),
                       F.sum("_vs_recs").over(whole).alias("total"),
                       F.sum("_vs_nv").over(whole).alias("nvals")))
    enriched = blocks.join(classes, groups)
    j = _join_blocks(ranged, enriched, groups, ["vals_before", "recs_before", "total", "nvals"])
    rank = F.col("_b_off") + F.col("_vs_loc") - F.col("_b_first")
    x = F.col("_b_vals_before") + rank
    cum = F.col("_b_recs_before") + F.col("count") * (rank + 1)
    return j.select(
        *keys, "value", "count",
        cum.alias("cum_count"),
        (cum.cast("double") / F.col("_b_total").cast("double") * F.lit(100.0)).alias("cum_perc_pop"),
        x.alias("x"),
        (x.cast("double") / F.col("_b_nvals").cast("double") * F.lit(100.0)).alias("x_perc"),
    )


def freq_of_freq(profile: DataFrame) -> DataFrame:
    """Frequency of frequencies: (field, count, n_values, records) per class."""
    return (frequency_classes(profile)
            .withColumn("records", F.col("count") * F.col("n_values")))


def head_coverage(profile: DataFrame, percents: Sequence[float] = (50.0, 80.0, 90.0, 99.0)) -> DataFrame:
    """How many of the most frequent values of a field hold ``p`` % of its records.

    Computed exactly on the frequency classes (most frequent first): the classes
    before the one that crosses the target contribute all their values, the
    crossing class contributes ceil(remaining / count) values.
    """
    classes = frequency_classes(profile).withColumn("_recs", F.col("count") * F.col("n_values"))
    desc = Window.partitionBy("field").orderBy(F.col("count").desc())
    upto = desc.rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("field")
    classes = (classes
               .withColumn("_recs_upto", F.sum("_recs").over(upto))
               .withColumn("_vals_upto", F.sum("n_values").over(upto))
               .withColumn("total_records", F.sum("_recs").over(whole))
               .withColumn("total_values", F.sum("n_values").over(whole)))
    pct = F.explode(F.array(*[F.lit(float(p)) for p in percents])).alias("percent")
    c = classes.select("*", pct)
    target = F.ceil(F.col("total_records").cast("double") * F.col("percent") / F.lit(100.0)).cast("bigint")
    c = c.withColumn("_target", target)
    recs_before = F.col("_recs_upto") - F.col("_recs")
    vals_before = F.col("_vals_upto") - F.col("n_values")
    crossing = c.where((F.col("_recs_upto") >= F.col("_target")) & (recs_before < F.col("_target")))
    need = vals_before + F.ceil((F.col("_target") - recs_before).cast("double")
                                / F.col("count").cast("double")).cast("bigint")
    return crossing.select(
        "field", "percent", "total_records", "total_values",
        need.alias("values_needed"),
        (need.cast("double") / F.col("total_values").cast("double") * F.lit(100.0)).alias("values_perc"),
    )


def compare_profiles(clean: DataFrame, raw: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """Pair the cumulation curves of a cleaned and a raw profile by field and ordinal.

    Only fields present in both profiles are paired; the curves are matched by
    ``x`` like a full outer join (their lengths differ). Both curves come from one
    cumulation over the union of the profiles keyed by (side, field), and they
    are paired by one aggregation on (field, x) -- each key holds at most one row
    per side -- instead of a join that would shuffle both sides.
    """
    both = (clean.select("field").distinct()
            .join(raw.select("field").distinct(), "field"))
    sides = (clean.join(both, "field", "left_semi").select(F.lit("clean").alias("side"), "field", "value", "count")
             .unionByName(raw.join(both, "field", "left_semi")
                          .select(F.lit("raw").alias("side"), "field", "value", "count")))
    cur = cumulate(sides, num_partitions, keys=("side", "field"))

    def pick(side: str, col: str, name: str):
        return F.max(F.when(F.col("side") == side, F.col(col))).alias(name)

    return cur.groupBy("field", "x").agg(
        pick("clean", "value", "clean_value"), pick("clean", "count", "clean_count"),
        pick("clean", "cum_count", "clean_cum_count"), pick("raw", "value", "raw_value"),
        pick("raw", "count", "raw_count"), pick("raw", "cum_count", "raw_cum_count"))
