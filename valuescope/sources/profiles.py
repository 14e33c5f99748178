"""Load a folder of per-field value files back as one long profile.

Each field's values were written as headerless ``value,count`` CSV under
``unique_<slug>.csv`` (a single file or a folder of part files). One distributed
read covers all of them; the field comes from the file path. An unquoted empty
value is NULL and a quoted ``""`` is the empty string (as the writer encodes
them); no "NA"/"null" guessing. Line ends inside values come back from the writer's codes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import slug_text, unescape_line
from ..sinks.writers import field_names

_SLUG_FROM_PATH = "unique_([^/]*?)\\.csv(/[^/]*)?$"


def load_profile_dir(spark: SparkSession, folder: str, fields: Sequence[str] | None = None) -> DataFrame:
    """(field, value, count) from ``folder/unique_<slug>.csv``; ``fields`` limits the files read.

    The writer's codes for line ends are turned back, and the field is the name the
    files were written for (its slug where the folder does not tell).
    """
    base = folder.rstrip("/")
    paths = [f"{base}/unique_{slug_text(f)}.csv" for f in fields] if fields else [f"{base}/unique_*.csv"]
    df = (spark.read.schema("value string, count bigint")
          .option("escape", '"').option("header", "false")
          .option("nullValue", "\u0000")  # only an unquoted empty field is NULL
          .csv(paths))
    slug = F.regexp_extract(F.col("_metadata.file_path"), _SLUG_FROM_PATH, 1)
    df = df.select(slug.alias("_slug"), unescape_line(F.col("value")).alias("value"), "count")
    known = field_names(spark, paths)
    if not known:
        return df.select(F.col("_slug").alias("field"), "value", "count")
    pairs = F.create_map(*[F.lit(x) for pair in sorted(known.items()) for x in pair])
    return df.select(F.coalesce(pairs[F.col("_slug")], F.col("_slug")).alias("field"), "value", "count")
