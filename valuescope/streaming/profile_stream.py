"""Structured Streaming forms of the counting operators.

The value profile and the term-frequency index are plain counts, so new files are
counted on their own: every micro-batch aggregates its rows and writes them as one
partition ``epoch=<n>`` of the output table (overwritten if the batch is run again, so
each batch counts once). Nothing is kept in streaming state and earlier results are
never rewritten; the value profile is the sum over the epochs. With the
``availableNow`` trigger a run processes everything present and stops, which makes the
job usable as an incremental batch: rerun it after new files arrive and only those
are read. The checkpoint belongs to the output: by default it lies in its folder, so
two streams never share one and a new application goes on where the last one ended.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import profile, tf


def _run(stream: DataFrame, count, output: str, checkpoint: str | None) -> None:
    """Append ``count`` of every micro-batch as its own epoch of ``output``."""
    base = output.rstrip("/")

    def write(batch: DataFrame, epoch: int) -> None:
        count(batch).write.mode("overwrite").parquet(f"{base}/epoch={epoch}")

    (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint or f"{base}/_checkpoint")
     .trigger(availableNow=True).start().awaitTermination())


def _epochs(spark: SparkSession, output: str, schema: str) -> DataFrame:
    return spark.read.schema(schema + ", epoch bigint").parquet(output).drop("epoch")


def stream_value_profile(spark: SparkSession, source: str, schema: StructType | str,
                         fields: Sequence[str], output: str, checkpoint: str | None = None,
                         fmt: str = "parquet", max_files_per_trigger: int | None = None) -> DataFrame:
    """Incremental long profile (field, value, count) of ``fields`` over files in ``source``.

    Runs until all available files are processed, then returns the sum over the epochs.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    _run(reader.load(source), lambda batch: profile.value_profile(batch, fields), output, checkpoint)
    return (_epochs(spark, output, "field string, value string, count bigint")
            .groupBy("field", "value").agg(F.sum("count").alias("count")))


def stream_tf_index(spark: SparkSession, source: str, schema: StructType | str, id_col: str,
                    text_cols: Sequence[str], output: str, tokenizer: str = "treebank",
                    checkpoint: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Incremental term-frequency index (id, token, count) over files in ``source``.

    A document arrives whole, so its counts are final when its file was read.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(source)
    kind = stream.schema[id_col].dataType.simpleString()
    _run(stream, lambda batch: tf.tf_index(batch, id_col, text_cols, tokenizer=tokenizer), output, checkpoint)
    return _epochs(spark, output, f"`{id_col}` {kind}, token string, count bigint")
