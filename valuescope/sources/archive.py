"""Descriptor-driven archive tables (an extracted Darwin Core Archive folder).

``meta.xml`` names one core table and any number of extension tables: file
location, separators, quote character, encoding, number of header lines, the
id / coreid column and ``field`` elements mapping a column index (or a constant
default) to a term URI. The descriptor is read with Spark's XML source (a single
small row); each table is then a distributed CSV read:

* term URIs are shortened to their namespace prefix (``dwc:``, ``xmpRights:``...);
* the first ``ignoreHeaderLines`` non-blank lines of **every file** are skipped
  (record ordinal within the file from ``monotonically_increasing_id`` against
  the file's first row; the per-file first-row table is broadcast after a size
  check);
* the table is read as text lines (all columns of every line are always
  parsed, so counting rows cannot skip the short-row check);
* a location is resolved as given, else by file-name suffix (last match wins);
* blank lines and undecodable lines are skipped; a row with fewer values than the highest mapped index
  is dropped; extra values are ignored; an empty value is absent (NULL);
* terms with a default but no index become constant columns;
* values are unquoted by RFC-4180 rules (a doubled quote is a quote).

A list of several extensions skips one whose file cannot be read; a single
extension that cannot be read is an error, as is a field with neither index nor
default. ``join_core_extension`` joins an extension to its core on id = coreid.
"""

from __future__ import annotations

import codecs
import logging
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import escape_line, shorten_term, unescape_line
from ..plans.skew import bounded_broadcast

_FIELD = "struct<_index: int, _term: string, _default: string>"
_TABLE = ("struct<_rowType: string, _encoding: string, _linesTerminatedBy: string, "
          "_fieldsTerminatedBy: string, _fieldsEnclosedBy: string, _ignoreHeaderLines: int, _lineCodes: boolean, "
          "files: struct<location: string>, id: struct<_index: int>, coreid: struct<_index: int>, "
          f"field: array<{_FIELD}>>")
DESCRIPTOR_SCHEMA = f"_metadata string, core {_TABLE}, extension array<{_TABLE}>"


@dataclass
class TableSpec:
    kind: str                      # "core" or "extension"
    row_type: str
    location: str
    encoding: str
    lines_terminated_by: str
    fields_terminated_by: str
    fields_enclosed_by: str
    ignore_header_lines: int
    columns: dict[int, str]        # index -> short term name (id / coreid included)
    defaults: dict[str, str] = field(default_factory=dict)
    line_codes: bool = False       # line ends inside values are written as codes (own archives)


@dataclass
class Archive:
    core: DataFrame
    extensions: list[DataFrame]
    specs: list[TableSpec]
    metadata: DataFrame | None


def _unescape(s: str | None, default: str) -> str:
    if s is None:
        return default
    return codecs.decode(s, "unicode_escape") if "\\" in s else s


def _spec(kind: str, row, namespaces: Sequence[tuple[str, str]] = ()) -> TableSpec:
    id_tag = "id" if kind == "core" else "coreid"
    id_struct = row[id_tag]
    if id_struct is None or id_struct["_index"] is None:
        raise ValueError(f"{kind} table has no {id_tag} index")
    columns = {int(id_struct["_index"]): id_tag}
    defaults: dict[str, str] = {}
    for f in row["field"] or []:
        term = shorten_term(f["_term"], namespaces)
        if f["_index"] is not None:
            columns[int(f["_index"])] = term
        elif f["_default"] is not None:
            defaults[term] = f["_default"]
        else:
            raise ValueError(f"field {term} has neither index nor default in {row['files']['location']}")
    return TableSpec(
        kind=kind, row_type=row["_rowType"], location=row["files"]["location"],
        encoding=row["_encoding"] or "UTF-8",
        lines_terminated_by=_unescape(row["_linesTerminatedBy"], "\n"),
        fields_terminated_by=_unescape(row["_fieldsTerminatedBy"], "\t"),
        fields_enclosed_by=_unescape(row["_fieldsEnclosedBy"], ""),
        ignore_header_lines=int(row["_ignoreHeaderLines"] or 0),
        columns=columns, defaults=defaults, line_codes=bool(row["_lineCodes"]))


def read_descriptor(spark: SparkSession, folder: str, meta_name: str = "meta.xml",
                    namespaces: Sequence[tuple[str, str]] = ()):
    """(metadata file name or None, [TableSpec core, TableSpec extension...]).

    ``namespaces``: extra (uri, prefix) pairs for term shortening.
    """
    path = f"{folder.rstrip('/')}/{meta_name}"
    rows = (spark.read.format("xml").option("rowTag", "archive")
            .schema(DESCRIPTOR_SCHEMA).load(path).collect())
    if len(rows) != 1 or rows[0]["core"] is None:
        raise ValueError(f"{path}: expected one archive element with a core table")
    r = rows[0]
    specs = ([_spec("core", r["core"], namespaces)]
             + [_spec("extension", e, namespaces) for e in (r["extension"] or [])])
    return r["_metadata"], specs


def _value_count(line: Column, sep: str, quote: str) -> Column:
    """Values in a raw line: quoted parts removed, separators + 1."""
    import re
    s, q = re.escape(sep), re.escape(quote)
    if quote:
        pattern = f"(^|{s}){q}[^{q}]*(?:{q}{q}[^{q}]*)*({q}|$)"
        line = F.regexp_replace(line, F.lit(pattern), F.lit("$1"))
    return F.size(F.split(line, s, -1))


def _read_lines(spark: SparkSession, path: str, encoding: str, line_sep: str) -> DataFrame:
    """Raw lines (``value``) of a table file or folder in the given encoding."""
    if encoding.replace("-", "").lower() in ("utf8", ""):
        reader = spark.read
        if line_sep not in ("\n", "\r\n", "\r"):
            reader = reader.option("lineSep", line_sep)
        return reader.text(path)
    # Other encodings: the raw bytes of each line, decoded whole. Line ends are searched
    # in the encoding's own bytes; a carriage return before one goes with it.
    end = "\n" if line_sep in ("\n", "\r\n") else line_sep
    raw = spark.read.option("encoding", encoding).option("lineSep", end).text(path)
    text = F.decode(F.col("value").cast("binary"), encoding)
    meta = F.struct(F.col("_metadata.file_path").alias("file_path"),
                    F.col("_metadata.file_block_start").alias("file_block_start"))
    return raw.select(F.regexp_replace(text, "\\r$", "").alias("value"), meta.alias("_metadata"))


def resolve_location(spark: SparkSession, folder: str, location: str) -> str:
    """Path of a table: ``folder/location`` if it exists, else the last file under
    ``folder`` (recursive listing, names only) whose path ends with ``location``."""
    base = folder.rstrip("/")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    direct = jvm.org.apache.hadoop.fs.Path(f"{base}/{location}")
    fs = direct.getFileSystem(conf)
    if fs.exists(direct):
        return f"{base}/{location}"
    found = None
    files = fs.listFiles(jvm.org.apache.hadoop.fs.Path(base), True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(location):
            found = name
    if found is None:
        raise FileNotFoundError(f"{location} not present in {folder}")
    return found


def read_table(spark: SparkSession, folder: str, spec: TableSpec) -> DataFrame:
    """One archive table as a DataFrame of string columns named by term."""
    width = max(spec.columns) + 1
    names = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{n} string" for n in names)
    path = resolve_location(spark, folder, spec.location)
    lines = _read_lines(spark, path, spec.encoding, spec.lines_terminated_by)
    # Blank lines are skipped before header lines are counted; so are lines that
    # are not valid text in the declared encoding.
    lines = lines.where((F.length(F.regexp_replace("value", "[\\r\\n]", "")) > 0)
                        & F.is_valid_utf8("value"))
    df = lines.select("value", F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"),
                      F.monotonically_increasing_id().alias("_mid"))
    if spec.ignore_header_lines > 0:
        firsts = (df.where(F.col("_block") == 0).groupBy(F.col("_file").alias("_ff"))
                  .agg(F.min("_mid").alias("_first")))
        firsts = bounded_broadcast(firsts)  # one row per file
        df = (df.join(firsts, F.col("_file") == F.col("_ff"), "left")
              .where(F.col("_first").isNull() | (F.col("_block") != 0)
                     | (F.col("_mid") - F.col("_first") >= F.lit(spec.ignore_header_lines))))
    # Rows with fewer values than the highest mapped index are dropped.
    n_values = _value_count(F.col("value"), spec.fields_terminated_by, spec.fields_enclosed_by)
    df = df.where(n_values >= F.lit(width))
    opts = {"sep": spec.fields_terminated_by, "quote": spec.fields_enclosed_by or "\u0000",
            "escape": spec.fields_enclosed_by or "\\", "mode": "PERMISSIVE"}
    rec = F.from_csv(F.col("value"), schema, opts).alias("_r")
    df = df.select(rec)
    def value(i: int) -> Column:
        found = F.expr(f"nullif(_r._c{i}, '')")
        return unescape_line(found) if spec.line_codes else found

    cols = [value(i).alias(term) for i, term in sorted(spec.columns.items())]
    cols += [F.lit(v).alias(term) for term, v in spec.defaults.items()]
    return df.select(*cols)


def load_archive(spark: SparkSession, folder: str, skip_eml: bool = False,
                 namespaces: Sequence[tuple[str, str]] = ()) -> Archive:
    """Core, extensions and (optional) EML metadata of an extracted archive folder."""
    meta_file, specs = read_descriptor(spark, folder, namespaces=namespaces)
    core = read_table(spark, folder, specs[0])
    ext_specs = specs[1:]
    extensions: list[DataFrame] = []
    kept: list[TableSpec] = [specs[0]]
    for spec in ext_specs:
        try:
            t = read_table(spark, folder, spec)
            t.schema  # resolves the path now
            extensions.append(t)
            kept.append(spec)
        except Exception as err:  # noqa: BLE001 - one bad extension of several is left out
            if len(ext_specs) == 1:
                raise
            logging.getLogger(__name__).warning("extension %s cannot be read and is left out: %s", spec.location, err)
    metadata = None
    if meta_file and not skip_eml:
        metadata = spark.read.format("xml").option("rowTag", "dataset").load(
            f"{folder.rstrip('/')}/{meta_file}")
    return Archive(core, extensions, kept, metadata)


def join_core_extension(core: DataFrame, extension: DataFrame, how: str = "left") -> DataFrame:
    """Core rows with their extension rows (core.id = extension.coreid).

    ``how="left"`` keeps core rows without extension rows. It is built as an
    inner join (AQE can split a skewed partition on either side, e.g. one core
    record owning a third of the extension rows) plus the core rows whose id is
    absent from the extension (anti join against the distinct extension ids),
    rather than an outer join, whose non-preserved side cannot be split.
    """
    ext = extension
    for c in ext.columns:
        if c != "coreid" and c in core.columns:
            ext = ext.withColumnRenamed(c, f"ext_{c}")
    inner = core.join(ext, core["id"] == ext["coreid"], "inner")
    if how == "inner":
        return inner
    if how != "left":
        return core.join(ext, core["id"] == ext["coreid"], how)
    ids = ext.select(F.col("coreid").alias("_vs_cid")).distinct()
    lonely = core.join(ids, core["id"] == ids["_vs_cid"], "left_anti")
    lonely = lonely.select(*[F.col("`" + c + "`") for c in core.columns],
                           *[F.lit(None).cast(ext.schema[c].dataType).alias(c) for c in ext.columns])
    return inner.unionByName(lonely)


def _xml_attr(s: str) -> str:
    return (s.replace("&", "&amp;").replace('"', "&quot;").replace("<", "&lt;")
            .replace("\t", "\\t").replace("\n", "\\n"))


def _table_xml(tag: str, location: str, id_tag: str, id_index: int, terms: list[str],
               defaults: dict[str, str], row_type: str, header_lines: int, sep: str) -> str:
    fields = [f'    <field index="{i + 1}" term="{_xml_attr(t)}"/>' for i, t in enumerate(terms)]
    fields += [f'    <field term="{_xml_attr(t)}" default="{_xml_attr(v)}"/>' for t, v in defaults.items()]
    return (f'  <{tag} encoding="UTF-8" fieldsTerminatedBy="{_xml_attr(sep)}" linesTerminatedBy="\\n" '
            f'fieldsEnclosedBy="&quot;" ignoreHeaderLines="{header_lines}" lineCodes="true" rowType="{_xml_attr(row_type)}">\n'
            f"    <files><location>{location}</location></files>\n"
            f'    <{id_tag} index="{id_index}"/>\n' + "\n".join(fields) + f"\n  </{tag}>")


def write_archive(folder: str, core: DataFrame, core_id: str, core_terms: dict[str, str],
                  extensions: list[tuple[str, DataFrame, str, dict[str, str]]] = (),
                  core_defaults: dict[str, str] | None = None, header_lines: int = 1,
                  sep: str = "\t", core_row_type: str = "http://rs.tdwg.org/dwc/terms/Occurrence") -> None:
    """Write an archive folder: one delimited folder per table plus ``meta.xml``.

    ``core_terms`` / extension terms map column -> term URI; the id (coreid)
    column is written first. Data are written by Spark (every part file carries
    ``header_lines`` header line when 1); line ends inside values are written as
    two-character codes, which the descriptor says (``lineCodes``), so any value but
    the empty one (absent in an archive) is read back as it was. ``meta.xml`` is a
    small driver-side file.
    """
    spark = core.sparkSession
    base = folder.rstrip("/")
    opts = {"sep": sep, "header": "true" if header_lines else "false", "quote": '"', "escape": '"',
            "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

    def put(df: DataFrame, name: str, key: str, cols: list[str]) -> None:
        df.select(*[escape_line(F.col(c).cast("string")).alias(c) for c in [key, *cols]]).write.mode("overwrite") \
            .options(**opts).csv(f"{base}/{name}")

    put(core, "core", core_id, list(core_terms))
    parts = [_table_xml("core", "core", "id", 0, list(core_terms.values()), core_defaults or {},
                        core_row_type, header_lines, sep)]
    for name, df, coreid, terms in extensions:
        put(df, name, coreid, list(terms))
        parts.append(_table_xml("extension", name, "coreid", 0, list(terms.values()), {},
                                "http://rs.tdwg.org/dwc/terms/MeasurementOrFact", header_lines, sep))
    xml = ('<?xml version="1.0" encoding="UTF-8"?>\n'
           '<archive xmlns="http://rs.tdwg.org/dwc/text/">\n' + "\n".join(parts) + "\n</archive>\n")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{base}/meta.xml")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    out.write(bytearray(xml.encode("utf-8")))
    out.close()
