"""Development subsets: predicate, fixed-position substring, ordered limit, hash sample.

These are sampling operators: limiting or sampling rows is their purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .selection import first_rows


def substring_subset(df: DataFrame, col: str, pos: int, length: int, equals: str) -> DataFrame:
    """Deterministic subset: ``substring(col, pos, length) == equals`` (1-based pos)."""
    return df.where(F.substring(F.col(col), pos, length) == F.lit(equals))


def predicate_subset(df: DataFrame, *conditions: Column | str) -> DataFrame:
    """Chained ``where`` conditions (logical AND); strings are SQL predicates."""
    out = df
    for c in conditions:
        out = out.where(c)
    return out


def ordered_subset(df: DataFrame, n: int, *order_cols: str) -> DataFrame:
    """Reproducible ``n``-row subset: the first ``n`` rows in ``order_cols`` order.

    Found by selection, so no task gathers or sorts n rows; the result is not sorted.
    """
    return first_rows(df, n, *order_cols)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Deterministic sample of about ``fraction`` of the rows, chosen by a hash of ``key``.

    The same key is always in or out, whatever the partitioning, so reruns and
    lost executors give the same subset. The hash is the first 60 bits of the MD5 of
    seed and key text, compared with ``fraction * 2**60``: no fraction is too small.
    """
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("")))), 1, 15), 16, 10)
    return df.where(h.cast("bigint") < F.lit(int(fraction * (1 << 60))))


def random_sample(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample without replacement (Spark's ``sample``)."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)
