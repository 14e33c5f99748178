"""Plan helpers for size-checked broadcasts and hot-key joins.

* ``bounded_broadcast``: broadcast a side only after its size in bytes was checked
  against a bound; above the bound the side is joined by shuffle.
* ``salted_join``: an inner equi-join where keys holding more than a share of
  one side's rows are split over tasks (that side gets a salt, the other side's rows
  with a hot key are replicated once per part). Hot keys are found by
  an exact partial-aggregated count, so their list has a proven size bound
  (rows / threshold).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin

# A side is broadcast when its stored (compressed, columnar) form takes at most this.
MAX_BROADCAST_BYTES = 16 << 20


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files of a written table (``pin``)."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def bounded_broadcast(df: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast`` of ``df`` when it is small in bytes, else a shuffle-join side.

    ``df`` is written once to the shared folder; the size of the files decides. No
    rows pass through the driver beyond the broadcast itself.
    """
    stored = pin(df)
    return F.broadcast(stored) if stored_bytes(stored) <= max_bytes else stored


def _key_counts(df: DataFrame, key: str, share: float, min_rows: int) -> tuple[DataFrame, int]:
    """(keys above the threshold with their rows as _vs_rows, the threshold)."""
    threshold = max(int(df.count() * share), min_rows)
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_vs_rows"))
    return counts.where(F.col("_vs_rows") > threshold), threshold


def hot_keys(df: DataFrame, key: str, share: float = 0.001, min_rows: int = 10_000) -> DataFrame:
    """Keys of ``df`` holding more than ``share`` of its rows (and more than ``min_rows``).

    At most ``1/share`` keys can pass the share test, so the result is bounded.
    """
    return _key_counts(df, key, share, min_rows)[0].select(key)


def salted_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                salts: int | None = None, share: float = 0.001, min_rows: int = 10_000) -> DataFrame:
    """Inner equi-join ``left.left_key == right.right_key`` with hot keys of ``right`` split.

    A key above the threshold (``share`` of the rows of ``right``, at least ``min_rows``)
    is split so that a task gets about that many of its rows (or ``salts`` ways); rows of
    ``left`` with the key are replicated once per part. ``right`` is written to the shared
    folder first (it is counted and joined, and its row ids must not change). The result
    equals the plain inner join.
    """
    right = pin(right)
    hot, threshold = _key_counts(right, right_key, share, min_rows)
    # At most 1/share keys, one job.
    found = hot.limit(int(1 / share) + 1).collect()
    if not found:  # nothing hot: the plain join (AQE still splits skewed partitions)
        return left.join(right, left[left_key] == right[right_key], "inner")
    parts = [(r[right_key], salts or -(-r["_vs_rows"] // max(threshold, 1))) for r in found]
    kind = right.schema[right_key].dataType.simpleString()
    hot_list = F.broadcast(right.sparkSession.createDataFrame(parts, f"_vs_key {kind}, _vs_parts int"))
    r = (right.join(hot_list, F.col(right_key) == F.col("_vs_key"), "left")
         # Salt from the row id: ``right`` is a written table, so the ids are the same
         # in a retried task, and even identical rows are spread over the parts.
         .withColumn("_vs_salt", F.when(F.col("_vs_parts").isNotNull(), F.pmod(
             F.monotonically_increasing_id(), F.col("_vs_parts")).cast("int")).otherwise(F.lit(0)))
         .drop("_vs_key", "_vs_parts"))
    lh = (left.join(hot_list, F.col(left_key) == F.col("_vs_key"), "left")
          .withColumn("_vs_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_vs_parts"), F.lit(1)) - 1)))
          .drop("_vs_key", "_vs_parts"))
    cond = (lh[left_key] == r[right_key]) & (lh["_vs_salt"] == r["_vs_salt"])
    return lh.join(r, cond, "inner").drop(lh["_vs_salt"]).drop(r["_vs_salt"])
