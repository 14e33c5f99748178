"""User-level jobs: the analyses end to end, each a few DataFrame operators.

| job                 | analysis                                                   |
|---------------------|------------------------------------------------------------|
| profile_values      | distinct values and counts of every field, one pass        |
| profile_csv         | the same for CSV text, with the reject side output         |
| cardinality_report  | distinct values per field, trimmed and ranked              |
| cumulate            | ascending-frequency cumulative record curve                |
| compare_profiles    | raw versus cleaned curves paired by field and ordinal      |
| build_tf_index      | (id, token, count) over free-text columns                  |
| cross_reference_job | identifiers repeated as tokens in other records' texts     |
| number_sequence     | are identifier numbers sequential: ranks, summary, gaps    |
| media_duplicates    | images sharing a perceptual fingerprint                    |
| load_archive        | descriptor-driven archive tables                           |
| make_subset         | development subsets written as parquet                     |
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import fingerprint, profile, selection, sequence, subset, tf, xref
from .operators.ordered import compare_profiles, cumulate  # noqa: F401  (re-exported jobs)
from .operators.profile import cardinality_report  # noqa: F401
from .session import pin
from .sinks import done_fields, write_field_csvs, write_parquet, write_rejects
from .sources import csvtext, media
from .sources.archive import load_archive  # noqa: F401
from .sources.profiles import load_profile_dir


def profile_values(df: DataFrame, fields: Sequence[str] | None = None, nested: bool = False,
                   out: str | None = None, resume: bool = False) -> DataFrame:
    """Long profile (field, value, count); with ``out`` also one value file per field.

    With ``resume`` fields whose files are complete are not aggregated again: their
    part of the returned profile is read back from the files.
    """
    names = list(fields) if fields is not None else profile.field_list(df, nested)
    done = done_fields(df.sparkSession, out, names) if out is not None and resume else []
    todo = [f for f in names if f not in set(done)]
    prof = profile.value_profile(df, todo) if todo else None
    if out is None:
        return prof
    if todo:
        write_field_csvs(prof, out, todo, resume=resume)
    if not done:
        return prof
    before = load_profile_dir(df.sparkSession, out, done)
    return prof.unionByName(before) if todo else before


def profile_csv(spark: SparkSession, path: str | Sequence[str], fields: Sequence[str] | None = None,
                rejects_out: str | None = None, out: str | None = None, resume: bool = False) -> DataFrame:
    """Profile CSV text read line by line (tolerant parse; rejects logged, still counted)."""
    parsed = csvtext.read_csv_records(spark, path)
    if rejects_out is not None:
        write_rejects(parsed.rejects, rejects_out)
    return profile_values(parsed.good, fields, out=out, resume=resume)


def build_tf_index(df: DataFrame, id_col: str, text_cols: Sequence[str], tokenizer: str = "treebank",
                   out: str | None = None, id_alias: str | None = None) -> DataFrame:
    """Term-frequency index; with ``out`` written as parquet (overwrite)."""
    index = tf.tf_index(df, id_col, text_cols, tokenizer=tokenizer, id_alias=id_alias)
    if out is not None:
        write_parquet(index, out)
    return index


def cross_reference_job(df: DataFrame, uuid_col: str, id_col: str, text_cols: Sequence[str],
                        index: DataFrame | None = None, tokenizer: str = "treebank",
                        out: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(cross reference rows, identifier-length histogram) of one table.

    ``index`` is an existing TF index (uuid, token, count) of the same table;
    its part for the identifiers is built when missing. With ``out`` the rows are written (error if exists).
    """
    ids = xref.identifier_view(df, uuid_col, id_col)
    notes = tf.notes(df, uuid_col, text_cols, id_alias="note_uuid", drop_empty=False)
    if index is None:  # only its identifier part is needed, built once for both results
        index = pin(xref.identifier_index(df, ids, uuid_col, text_cols, tokenizer))
    rows = xref.cross_reference(ids, index, notes)
    if out is not None:
        write_parquet(rows, out, mode="errorifexists")
    return rows, xref.id_length_histogram(ids, index, notes)


@dataclass
class NumberSequence:
    numbers: DataFrame      # grp, catalognumber, number
    ranked: DataFrame       # grp, rank, number, n
    bad: DataFrame          # grp, n, n_zero_text, n_bad
    summary: DataFrame      # grp, count, mean, std, min, p25, p50, p75, max
    repeats: DataFrame      # grp, number, count
    gaps: DataFrame         # grp, rank, number, next_number, gap
    slopes: DataFrame       # grp, bucket, first/last rank and number, slope
    islands: DataFrame      # grp, first, last, n: runs of consecutive numbers


def number_sequence(df: DataFrame, id_col: str, group_col: str, slope_width: int = 1000) -> NumberSequence:
    """All parts of the sequence study for every group (record set) at once."""
    nums = sequence.with_numbers(df, id_col, group_col)
    ranked = sequence.rank_numbers(nums)
    return NumberSequence(nums, ranked, sequence.bad_counts(nums), sequence.describe(ranked),
                          sequence.repeats(nums), sequence.gaps(ranked),
                          sequence.slope_segments(ranked, slope_width), sequence.islands(nums))


def media_duplicates(spark: SparkSession, path: str, k: int = 20) -> DataFrame:
    """The ``k`` most shared image fingerprints (NULL = unreadable images)."""
    prints = media.image_fingerprints(media.read_images(spark, path))
    return fingerprint.top_fingerprints(prints, k)


def make_subset(df: DataFrame, n: int | None = None, where: Sequence[Column | str] = (),
                order_by: Sequence[str] = (), fraction: float | None = None, key: str | None = None,
                out: str | None = None, size: int | None = None) -> DataFrame:
    """Development subset: predicates, then a hash sample (a ``fraction``, or exactly
    ``size`` rows) or a row limit, in order if ``order_by`` is given."""
    sub = subset.predicate_subset(df, *where)
    if fraction is not None:
        sub = subset.hash_sample(sub, key or sub.columns[0], fraction)
    if size is not None:
        sub = selection.exact_sample(sub, size, key or sub.columns[0])
    if n is not None:
        sub = selection.first_rows(sub, n, *order_by) if order_by else sub.limit(n)
    if out is not None:
        write_parquet(sub, out)
    return sub


def shape(df: DataFrame) -> tuple[int, int]:
    """(rows, columns)."""
    return df.count(), len(df.columns)


def row_count_text(spark: SparkSession, path: str) -> int:
    """Lines of a text dump (the map/reduce line count as one aggregate)."""
    return csvtext.read_lines(spark, path).agg(F.count("*")).first()[0]
