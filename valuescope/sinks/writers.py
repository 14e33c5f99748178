"""Distributed writers; nothing is funnelled through the driver.

* ``write_parquet``: overwrite (default) or error-if-exists.
* ``write_profile_partitioned``: the long profile as headerless CSV partitioned
  by field (``field=<name>/part-*``); reading one field back prunes the others.
* ``write_field_csvs``: one ``unique_<slug>.csv`` folder per field, skipping
  fields whose folder is already complete (resume after a failure).
* ``write_text_pairs``: ``count,value`` text lines.
* ``write_rejects``: append the reject lines of a tolerant CSV parse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import escape_line, slug_text

# Blanks at either end belong to the value (the writer would trim them by default).
CSV_WRITE = {"header": "false", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
             "ignoreTrailingWhiteSpace": "false"}
CSV_LINE = {"escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
# In the folder of a field's value files: the name behind the slug (Spark's readers skip it).
FIELD_NAME = "_FIELD"


def _fs(spark, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def field_names(spark, paths: Sequence[str]) -> dict[str, str]:
    """Slug -> field name of the value files under ``paths`` (globs), where they tell."""
    names = {}
    for path in paths:  # one small file per field
        fs, p = _fs(spark, f"{path}/{FIELD_NAME}")
        for status in fs.globStatus(p) or []:
            stream = fs.open(status.getPath())
            name = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            names[slug_text(name)] = name
    return names


def path_complete(spark, path: str) -> bool:
    """True when ``path`` holds a committed Spark output (its _SUCCESS marker)."""
    fs, p = _fs(spark, path.rstrip("/") + "/_SUCCESS")
    return bool(fs.exists(p))


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def _partitions(df: DataFrame) -> int:
    from ..operators.ordered import range_partitions
    return range_partitions(df)


def write_profile_partitioned(profile: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Headerless CSV under ``field=<name>/``.

    Values are escaped as in ``write_field_csvs``. Rows are range-partitioned on
    (field, value) first, so each task holds a
    contiguous slice of few fields: about tasks + fields files instead of
    tasks x fields, and values come out sorted within a field.
    """
    (profile.select(escape_line(F.col("value")).alias("value"), "count", "field")
     .repartitionByRange(_partitions(profile), "field", "value")
     .write.mode(mode).options(**CSV_WRITE).partitionBy("field").csv(path))


def write_profile_parquet(profile: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The long profile as parquet partitioned by field (``field=<name>/``).

    Range-partitioned on (field, value) first, as the CSV form: about tasks +
    fields files; reading one field back prunes to its folder.
    """
    (profile.repartitionByRange(_partitions(profile), "field", "value")
     .write.mode(mode).partitionBy("field").parquet(path))


def done_fields(spark, folder: str, fields: Sequence[str]) -> list[str]:
    """Fields whose ``unique_<slug>.csv`` output is already complete."""
    return [f for f in fields if path_complete(spark, f"{folder.rstrip('/')}/unique_{slug_text(f)}.csv")]


def check_slugs(fields: Sequence[str]) -> None:
    seen: dict[str, str] = {}
    for f in fields:
        s = slug_text(f)
        if s in seen and seen[s] != f:
            raise ValueError(f"fields {seen[s]!r} and {f!r} share the output name {s!r}")
        seen[s] = f


def _rename(fs, src, dst) -> None:
    if not fs.rename(src, dst):
        raise OSError(f"could not rename {src} to {dst}")


def write_field_csvs(profile: DataFrame, folder: str, fields: Sequence[str], resume: bool = True) -> list[str]:
    """Write ``folder/unique_<slug>.csv`` per field from one long profile, in one pass.

    The profile is written once, partitioned by the field slug, into a staging
    folder next to the target; each partition folder then takes its
    ``unique_<slug>.csv`` name, and only after that move succeeded is it marked
    complete and an old output dropped. With ``resume`` fields whose output is
    already complete are filtered out before the aggregation runs. Line ends and
    the escape character are written as two-character codes (``escape_line``), so
    every value stays on one line; a small file ``FIELD_NAME`` keeps the field's name.
    Returns the fields written.
    """
    from ..functions.scalars import slug
    check_slugs(fields)
    spark = profile.sparkSession
    base = folder.rstrip("/")
    todo = [f for f in fields if not (resume and path_complete(spark, f"{base}/unique_{slug_text(f)}.csv"))]
    if not todo:
        return []
    staging = f"{base}/_staging"
    (profile.where(F.col("field").isin(todo))
     .select(escape_line(F.col("value")).alias("value"), "count", slug(F.col("field")).alias("_slug"))
     .repartitionByRange(_partitions(profile), "_slug", "value")  # ~tasks + fields files
     .write.mode("overwrite").options(**CSV_WRITE).partitionBy("_slug").csv(staging))
    fs, _ = _fs(spark, base)
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for f in todo:
        s = slug_text(f)
        src, dst, old = jpath(f"{staging}/_slug={s}"), jpath(f"{base}/unique_{s}.csv"), jpath(f"{staging}/_old={s}")
        if not fs.exists(src):  # a field without rows still gets an (empty) complete output
            fs.mkdirs(src)
        if fs.exists(dst):  # kept in the staging folder until the new output is in its place
            _rename(fs, dst, old)
        _rename(fs, src, dst)
        name = fs.create(jpath(f"{base}/unique_{s}.csv/{FIELD_NAME}"), True)
        name.write(bytearray(f.encode("utf-8")))
        name.close()
        fs.create(jpath(f"{base}/unique_{s}.csv/_SUCCESS")).close()
    fs.delete(jpath(staging), True)
    return todo


def write_csv_pairs(counts: DataFrame, path: str, value_col: str = "value", count_col: str = "count") -> None:
    """``value,count`` CSV text lines (RFC quoting, line ends escaped) as plain text files."""
    line = F.to_csv(F.struct(escape_line(F.col(value_col)).alias("value"), F.col(count_col)), CSV_LINE)
    counts.select(line.alias("value")).write.mode("overwrite").text(path)


def field_output_name(dataset: str, version: str, field: str, kind: str = "unique") -> str:
    """Output name from data set, version and field slug: ``<dataset>-<version>-<kind>-<slug>``."""
    return f"{dataset}-{version}-{kind}-{slug_text(field)}"


def write_text_pairs(counts: DataFrame, path: str, value_col: str = "value", count_col: str = "count") -> None:
    """``count,value`` lines (count first, value unquoted, line ends escaped; NULL is empty)."""
    (counts.select(F.concat(F.col(count_col).cast("string"), F.lit(","), F.coalesce(
        escape_line(F.col(value_col)), F.lit(""))).alias("value"))
     .write.mode("overwrite").text(path))


def write_rejects(rejects: DataFrame, path: str) -> None:
    rejects.select("value").write.mode("append").text(path)
