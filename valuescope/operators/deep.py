"""Profile of arbitrarily deep values: (path, value, count) of JSON text or nested columns.

The values become VARIANT and are taken apart level by level: what is no object or array
is counted under its path, the rest is exploded once more. Array items share the path of
their array (``[]``), so a path names a place in the schema and not in a document. A
level is one generator pass over what the level before left; the number of levels is the
depth of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..session import pin


def _variant(df: DataFrame, column: str) -> Column:
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, StringType):
        return F.try_parse_json(c)
    return F.try_parse_json(F.to_json(F.struct(c.alias("v")), {"ignoreNullFields": "false"}))


def _step(key: Column) -> Column:
    """A path step: plain names as they are, others quoted."""
    plain = key.rlike(r"^[A-Za-z_][A-Za-z0-9_]*$")
    return F.when(key.isNull(), "[]").when(plain, F.concat(F.lit("."), key)).otherwise(
        F.concat(F.lit("['"), F.replace(key, F.lit("'"), F.lit("\\'")), F.lit("']")))


def deep_profile(df: DataFrame, column: str) -> DataFrame:
    """(path, value, count): every leaf value of ``column`` with the records it occurs in
    (each occurrence counts). ``$`` is the column itself; text that is no JSON, empty
    objects and arrays, and nulls are leaves with a null value."""
    spark = df.sparkSession
    wrapped = not isinstance(df.schema[column].dataType, StringType)
    rows = df.select(F.lit("$").alias("path"), _variant(df, column).alias("v"))
    if wrapped:  # to_json takes a struct: its one field is the column
        rows = rows.select("path", F.try_variant_get("v", "$.v", "variant").alias("v"))
    counts = None
    while True:
        shape = F.schema_of_variant("v")
        # An empty object or array has nothing to explode.
        nested = F.coalesce((shape.startswith("OBJECT<") & (shape != "OBJECT<>")) |
                            (shape.startswith("ARRAY<") & (F.try_variant_get("v", "$[0]", "variant").isNotNull())), F.lit(False))
        rows = pin(rows.withColumn("nested", nested))
        holds = shape.startswith("OBJECT") | shape.startswith("ARRAY")
        leaf = F.when(F.coalesce(holds, F.lit(False)), None).otherwise(F.try_variant_get("v", "$", "string"))
        found = rows.where(~F.col("nested")).groupBy("path", leaf.alias("value")).agg(F.count("*").alias("count"))
        counts = found if counts is None else counts.unionByName(found)
        inner = rows.where("nested")
        if inner.isEmpty():
            return counts.groupBy("path", "value").agg(F.sum("count").alias("count"))
        parts = inner.select("path", "v").lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
        rows = parts.select(F.concat("path", _step(F.col("key"))).alias("path"), F.col("value").alias("v"))
