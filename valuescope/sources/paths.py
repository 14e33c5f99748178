"""Dataset path templates: ``<base>/<name>-<version><size>.parquet``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def dataset_path(base: str, name: str, version: str, size: str = "", suffix: str = ".parquet") -> str:
    """Path of a versioned dataset (``size`` is an optional subset suffix such as "-100k")."""
    return f"{base.rstrip('/')}/{name}-{version}{size}{suffix}"


def read_dataset(spark: SparkSession, base: str, name: str, version: str, size: str = "") -> DataFrame:
    """Parquet scan of a versioned dataset."""
    return spark.read.parquet(dataset_path(base, name, version, size))
