"""Groups of items sharing a median-threshold fingerprint (vectors or images).

The fingerprint of a row is computed by column expressions (vectors) or by an
Arrow-batched pandas UDF (images, see ``valuescope.sources.media``); the grouping
is a partial-aggregated count, so a fingerprint shared by a third of all rows is
one partial row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import fingerprint64, fold8
from ..plans.parallel import spread


def vector_fingerprints(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, fingerprint, fingerprint8) per row."""
    rows = spread(df.select(id_col, vec_col))
    return rows.select(F.col(id_col), fingerprint64(vec_col).alias("fingerprint"),
                     fold8(vec_col).alias("fingerprint8"))


def fingerprint_histogram(prints: DataFrame, key: str = "fingerprint") -> DataFrame:
    """(key, count): how many rows share each fingerprint (NULL = failed rows)."""
    return prints.groupBy(key).agg(F.count("*").alias("count"))


def top_fingerprints(prints: DataFrame, k: int = 20, key: str = "fingerprint") -> DataFrame:
    """The ``k`` most shared fingerprints, ties broken by fingerprint (a top-k report)."""
    return (fingerprint_histogram(prints, key)
            .orderBy(F.col("count").desc(), F.col(key).asc_nulls_first())
            .limit(k))
