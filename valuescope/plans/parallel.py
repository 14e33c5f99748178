"""Parallelism guard for CPU-heavy row work on under-partitioned inputs.

A scan yields one task per file split / row group. When an input has fewer
partitions than the cluster has cores (one large row group, a handful of files),
per-row work such as regex tokenising would run on a few cores only. ``spread``
then hash-partitions the (already pruned) rows over ``spark.default.parallelism``
partitions by their row id -- balanced whatever the key distribution (copies
of one row included), and deterministic because ``spread`` only acts on inputs
without a shuffle, whose row order is fixed; a lost executor recomputes the
same rows. On a
cluster reading many files the input already has enough partitions and ``spread``
returns the DataFrame unchanged (no shuffle is added).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Smallest share of the input a spread partition should get.
MIN_SPREAD_BYTES = 256 * 1024  # compressed bytes: CPU-heavy rows (text) need small shares


def target_parallelism(df: DataFrame) -> int:
    """Cores, but no more partitions than the estimated input size / MIN_SPREAD_BYTES
    (a small input on a large cluster is not cut into thousands of tiny tasks)."""
    cores = int(df.sparkSession.sparkContext.defaultParallelism)
    try:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # noqa: BLE001 - no estimate: use the cores
        return cores
    return max(1, min(cores, -(-size // MIN_SPREAD_BYTES)))


# An exchange as a node of the plan's tree, not as a part of a column's or path's name.
_EXCHANGE = re.compile(r"(?m)^[\s:+\-*()0-9]*(Broadcast|Reused)?Exchange\b")


def has_shuffle(df: DataFrame) -> bool:
    """True when the physical plan of ``df`` contains an exchange."""
    return _EXCHANGE.search(df._jdf.queryExecution().executedPlan().toString()) is not None


def spread(df: DataFrame, keys: Sequence[str] | None = None, min_partitions: int | None = None) -> DataFrame:
    """Hash-repartition ``df`` when it has fewer partitions than the target parallelism."""
    target = min_partitions or target_parallelism(df)
    if has_shuffle(df):
        # Already shuffled (it has the configured shuffle parallelism); asking an
        # adaptive plan for its partition count would also run its stages.
        return df
    current = df.rdd.getNumPartitions()
    if current >= target:
        return df
    if keys:
        # Plain key columns: a later aggregation keyed by (these keys, ...) reuses
        # this partitioning. Only for keys known to be (nearly) unique: a hot key
        # would land in one partition.
        return df.repartition(target, *[F.col("`" + c + "`") for c in keys])
    # Key = row id. The input has no shuffle (checked above), so its row order and
    # ids are deterministic; unlike a hash of the row, the id spreads identical
    # rows (a group of copies) evenly too.
    rid = "_vs_rid"
    return df.withColumn(rid, F.monotonically_increasing_id()).repartition(target, rid).drop(rid)
