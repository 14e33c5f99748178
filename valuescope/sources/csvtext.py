"""CSV read as text lines, parsed with column expressions.

The original jobs read CSV line by line (so a quoted value spanning two lines
becomes two records), drop every line equal to the header (repeated headers of
concatenated files), and parse each line with RFC-4180 quoting (``""`` inside a
quoted value is a quote). Empty values are ``""``, never NULL. In the tolerant
mode a line with **more** values than the header is a reject: it is logged and
its record keeps all fields ``""`` (it still counts); shorter lines are padded
with ``""``. The strict mode fails the job on any length mismatch.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A quoted field (with doubled quotes inside) at a value start, up to its closing
# quote or the end of the line; removing them leaves only separating commas.
_QUOTED_FIELD = '(^|,)"[^"]*(?:""[^"]*)*("|$)'
CSV_OPTIONS = {"escape": '"', "quote": '"', "sep": ","}


@dataclass
class ParsedCsv:
    good: DataFrame      # one string column per header field, all records (rejects blanked)
    rejects: DataFrame   # (value) "PROBLEM WITH: <line>" for every rejected line
    header: list[str]


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Text line scan: DataFrame[value: string], one row per line."""
    return spark.read.text(path)


def parse_header(line: str) -> list[str]:
    """Field names from a header line (driver side, a single line)."""
    return next(csv.reader(io.StringIO(line)))


def first_line(lines: DataFrame) -> str:
    """The first row of a lines DataFrame (one row to the driver)."""
    row = lines.select("value").first()
    if row is None:
        raise ValueError("empty input: no header line")
    return row[0]


def first_file_line(spark: SparkSession, path: str | Sequence[str]) -> str:
    """The first line of the first file (by name) of a text input.

    Spark packs file splits by size, so "the first row" of a multi-file scan is
    not necessarily the head of the first file. The file listing (names only)
    gives the first file; one line is read from its first split.
    """
    files = sorted(spark.read.text(path).inputFiles())
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in files:  # empty part files are skipped (length from the listing)
        hpath = jvm.org.apache.hadoop.fs.Path(name)
        if hpath.getFileSystem(conf).getFileStatus(hpath).getLen() == 0:
            continue
        row = spark.read.text(name).limit(1).first()
        if row is not None:
            return row[0]
    raise ValueError("empty input: no header line")


def drop_header_lines(lines: DataFrame, header_line: str) -> DataFrame:
    """Remove every line equal to the header (not only the first one)."""
    return lines.where(F.col("value") != F.lit(header_line))


def value_count(line: Column) -> Column:
    """Number of CSV values in a line: quoted parts removed, commas + 1."""
    stripped = F.regexp_replace(line, F.lit(_QUOTED_FIELD), F.lit("$1"))
    return (F.length(stripped) - F.length(F.replace(stripped, F.lit(","), F.lit("")))) + F.lit(1)


def _schema(names: Sequence[str]) -> str:
    return ", ".join("`" + n.replace("`", "``") + "` STRING" for n in names)


def parse_lines(lines: DataFrame, header: Sequence[str] | None = None,
                strict: bool = False, header_line: str | None = None) -> ParsedCsv:
    """Parse CSV text lines into string columns named after the header.

    ``header``: field names; else parsed from ``header_line``; else from the first
    row of ``lines``. Lines equal to the header line are removed wherever they occur.
    """
    if header is None:
        head_line = header_line if header_line is not None else first_line(lines)
        names = parse_header(head_line)
    else:
        names = list(header)
        head_line = ",".join(names)
    body = drop_header_lines(lines, head_line)
    n = len(names)
    rec = F.from_csv(F.col("value"), _schema(names), CSV_OPTIONS)
    counted = body.select("value", value_count(F.col("value")).alias("_n"), rec.alias("_r"))
    if strict:
        bad = F.col("_n") != F.lit(n)
        checked = counted.withColumn("_ok", F.when(bad, F.raise_error(
            F.concat(F.lit("wrong number of values: "), F.col("value")))).otherwise(F.lit(True)))
        good = checked.select(*[F.coalesce(F.col("_r")[c], F.lit("")).alias(c) for c in names],
                              F.col("_ok"))
        good = good.where(F.col("_ok")).drop("_ok")
        rejects = counted.where(F.lit(False)).select(F.col("value"))
        return ParsedCsv(good, rejects, names)
    reject = F.col("_n") > F.lit(n)
    good = counted.select(*[F.when(reject, F.lit("")).otherwise(F.coalesce(F.col("_r")[c], F.lit(""))).alias(c)
                            for c in names])
    rejects = counted.where(reject).select(F.concat(F.lit("PROBLEM WITH: "), F.col("value")).alias("value"))
    return ParsedCsv(good, rejects, names)


def read_csv_records(spark: SparkSession, path: str | Sequence[str], strict: bool = False) -> ParsedCsv:
    """Text scan + header discovery + header removal + parse (tolerant by default)."""
    return parse_lines(read_lines(spark, path), strict=strict,
                       header_line=first_file_line(spark, path))


def naive_pick(line: Column, index: int, strict: bool = False) -> Column:
    """``line.split(',')[index]`` without quote handling; NULL (or error) when short."""
    parts = F.split(line, ",", -1)
    return parts[index] if strict else F.get(parts, index)


def to_csv_lines(df: DataFrame, header: bool = True) -> DataFrame:
    """Render rows as CSV text lines (RFC quoting), optionally with a header line first."""
    body = df.select(F.to_csv(F.struct(*[F.col("`" + c + "`") for c in df.columns]),
                              {"escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false",
                               "ignoreTrailingWhiteSpace": "false"}).alias("value"))
    if not header:
        return body
    buf = io.StringIO()
    csv.writer(buf, lineterminator="").writerow(df.columns)
    head = df.sparkSession.range(0, 1, 1, 1).select(F.lit(buf.getvalue()).alias("value"))
    return head.unionAll(body)
