"""Registered queries over the shared test tables, with their SQL checks.

Every query reads whole tables (or data Spark derives from them) and runs the
library's operators; ``SQL`` holds the equivalent DuckDB text for each key that
has one. Stand-ins for the original data: ``documents`` plays the specimen notes
(doc_id = record id, text = note, source = record set, doc_id as text =
catalogue number), ``lineitem``/``customer``/``part``/``orders``/``events`` the
wide tables, ``pages`` non-numeric identifiers and ``embeddings`` the vectors
behind a fingerprint.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from .. import jobs
from ..functions.scalars import slug, to_int, unescape_line
from ..functions.text import note
from ..operators import fingerprint as fp
from ..operators import deep, ordered, profile, segments, selection, sequence, sketches, subset, tf, xref
from ..sources import csvtext, quoted
from ..session import pin, scratch_path
from ..sinks.writers import field_output_name
from ..sinks import (write_csv_pairs, write_field_csvs, write_parquet, write_profile_partitioned, write_rejects,
                     write_text_pairs)
from ..sources import archive
from ..sources.paths import dataset_path, read_dataset
from ..sources.profiles import load_profile_dir
from ..streaming import profile_stream
from . import oracle as O
from .parallel import spread

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- term frequency

def q_tf_index_words(spark, d):
    return tf.tf_index(table(spark, d, "documents"), "doc_id", ["text"], tokenizer="words")


def q_tf_index_treebank(spark, d):
    return tf.tf_index(table(spark, d, "documents"), "doc_id", ["text"], tokenizer="treebank")


def q_tf_index_conversations(spark, d):
    # A second corpus; id = (conversation, turn) folded into one text key.
    conv = table(spark, d, "conversations").select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("uuid"),
        "role", "text")
    return tf.tf_index(conv, "uuid", ["role", "text"], tokenizer="treebank")


def q_notes_nonempty(spark, d):
    docs = table(spark, d, "documents")
    return (docs.select("doc_id", note(F.expr("nullif(lang, 'en')"), F.expr("nullif(source, 'src0')")).alias("note"))
            .where(F.col("note") != ""))


# ---------------------------------------------------------------- counts and profiles

def q_line_count(spark, d):
    return profile.row_count(table(spark, d, "lineitem"))


def q_value_counts_one(spark, d):
    return profile.value_counts(table(spark, d, "documents"), "source")


def q_value_counts_sql(spark, d):
    table(spark, d, "orders").createOrReplaceTempView("vs_orders")
    return profile.value_counts_sql(spark, "vs_orders", "o_orderpriority")


def q_value_profile_all(spark, d):
    return profile.value_profile(table(spark, d, "customer"))


def q_value_profile_lineitem(spark, d):
    li = table(spark, d, "lineitem")
    return profile.value_profile(li)


def _events_nested(spark, d):
    ev = table(spark, d, "events")
    return ev.select("user_id", "event_type", F.from_json("props", "k int").alias("data"))


def q_value_profile_events(spark, d):
    # Every column, including fractional-second timestamps and doubles, as text.
    return profile.value_profile(table(spark, d, "events"))


def q_value_profile_nested(spark, d):
    return profile.value_profile(_events_nested(spark, d), nested=True)


def q_deep_profile(spark, d):
    return deep.deep_profile(table(spark, d, "events"), "props")


def q_named_outputs(spark, d):
    # One folder a field, named by data set, version and field; read back by name.
    orders, base, paths = table(spark, d, "orders"), scratch_path(spark, "named"), []
    for f in ("o_orderstatus", "o_orderpriority"):
        paths.append(f"{base}/{field_output_name('orders', '2024-01', f, 'pairs')}")
        write_text_pairs(profile.value_counts(orders, f), paths[-1])
    return spark.read.text(paths).select(
        F.regexp_extract("_metadata.file_path", "([^/]+)/[^/]*$", 1).alias("output"), "value")


def q_cardinality(spark, d):
    return profile.cardinality_report(profile.value_profile(table(spark, d, "lineitem")))


_SOURCE_FIELDS = ["doc_id", "text", "lang", "n_chars"]  # all but the grouping column


def q_value_profile_by_source(spark, d):
    # One profile per record set (source), all from one pass.
    return profile.value_profile(table(spark, d, "documents"), _SOURCE_FIELDS, by=["source"])


def q_cardinality_by_source(spark, d):
    docs = table(spark, d, "documents")
    return profile.cardinality(profile.value_profile(docs, _SOURCE_FIELDS, by=["source"]), by=["source"])


def q_cardinality_estimate(spark, d):
    # Approximate (HyperLogLog++) beside the exact counts: per field, whether the
    # estimate is within 5 %.
    li = table(spark, d, "lineitem")
    exact = profile.cardinality(profile.value_profile(li)).withColumnRenamed("field", "f").withColumnRenamed("card", "exact")
    got = profile.cardinality_estimate(li).join(exact, F.col("field") == F.col("f"))
    return got.select("field", (F.abs(F.col("card") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_5_percent"))


def q_cardinality_sketched(spark, d):
    # Sketches stored per source and epoch, merged per source without reading the rows.
    docs = table(spark, d, "documents").withColumn("epoch", F.pmod("doc_id", F.lit(5)))
    stored = pin(sketches.field_sketches(docs, _SOURCE_FIELDS, by=["source", "epoch"]))
    got = sketches.sketched_cardinality(sketches.merge_sketches(stored, ["source"]), ["source"])
    exact = profile.cardinality(profile.value_profile(docs, _SOURCE_FIELDS, by=["source"]), by=["source"])
    exact = exact.select(F.col("source").alias("s2"), F.col("field").alias("f2"), F.col("card").alias("exact"))
    return got.join(exact, F.col("source").eqNullSafe(F.col("s2")) & (F.col("field") == F.col("f2"))).select(
        "source", "field", (F.abs(F.col("card") - F.col("exact")) <= 0.05 * F.col("exact")).alias("within_5_percent"))


_HEAVY = 0.002


def q_heavy_values(spark, d):
    return sketches.heavy_values(table(spark, d, "lineitem"), _HEAVY)


def q_heavy_tokens(spark, d):
    tokens = tf.tokens(table(spark, d, "documents"), "doc_id", ["text"], tokenizer="words")
    return sketches.heavy_of(tokens.select(F.lit("token").alias("field"), F.col("token").alias("value")), _HEAVY)


def q_cardinality_all(spark, d):
    return profile.cardinality(profile.value_profile(table(spark, d, "orders")))


# ---------------------------------------------------------------- frequency curves

def q_cumulate(spark, d):
    return ordered.cumulate(profile.value_profile(table(spark, d, "lineitem")))


def q_compare_raw_clean(spark, d):
    docs = table(spark, d, "documents")
    raw = pin(tf.token_profile(docs, ["text"], tokenizer="treebank"))
    clean = tf.reprofile(raw, F.lower)
    return ordered.compare_profiles(clean, raw)


def q_freq_of_freq(spark, d):
    return ordered.freq_of_freq(tf.token_profile(table(spark, d, "documents"), ["text"], tokenizer="words"))


def q_head_coverage(spark, d):
    return ordered.head_coverage(tf.token_profile(table(spark, d, "documents"), ["text"], tokenizer="words"))


# ---------------------------------------------------------------- cross reference

def _xref_inputs(spark, d):
    docs = table(spark, d, "documents")
    ids = xref.identifier_view(docs, "doc_id", "doc_id")
    index = xref.identifier_index(docs, ids, "doc_id", ["text"])
    notes = tf.notes(docs, "doc_id", ["text"], id_alias="note_uuid", drop_empty=False)
    return ids, index, notes


def q_id_cross_reference(spark, d):
    return xref.cross_reference(*_xref_inputs(spark, d))


def q_id_length_hist(spark, d):
    return xref.id_length_histogram(*_xref_inputs(spark, d))


# ---------------------------------------------------------------- number sequences

def _page_numbers(spark, d):
    pages = table(spark, d, "pages")
    last = F.element_at(F.split("url", "/"), -1)
    host = F.split("url", "/")[2]
    return pages.select(host.alias("grp"), F.col("page_id"), last.alias("catalognumber"),
                        to_int(last).alias("number"))


def q_seq_to_int(spark, d):
    return _page_numbers(spark, d).select("page_id", "catalognumber", "number")


def q_seq_bad_count(spark, d):
    return sequence.bad_counts(_page_numbers(spark, d))


def _line_numbers(spark, d):
    return sequence.with_numbers(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")


def _ranked(spark, d):
    return sequence.rank_numbers(_line_numbers(spark, d))


def q_seq_rank(spark, d):
    return _ranked(spark, d)


def q_seq_slice(spark, d):
    return sequence.rank_slice(_ranked(spark, d), 100, 300)


def q_seq_drop_last(spark, d):
    return sequence.rank_slice(_ranked(spark, d), 0, None, drop_last=3)


def q_seq_tail(spark, d):
    return sequence.tail(_ranked(spark, d), 10)


def q_seq_zoom(spark, d):
    return sequence.zoom(_ranked(spark, d), 100, 400, 2000, 9000)


def q_seq_describe(spark, d):
    return sequence.describe(_ranked(spark, d))


def q_seq_gaps(spark, d):
    return sequence.gaps(_ranked(spark, d))


def q_seq_repeats(spark, d):
    return sequence.repeats(_line_numbers(spark, d))


def q_seq_slopes(spark, d):
    return sequence.slope_segments(_ranked(spark, d), 100)


def q_seq_islands(spark, d):
    return sequence.islands(_line_numbers(spark, d))


def q_seq_page_islands(spark, d):
    return sequence.islands(_page_numbers(spark, d))


# Orders between neighbours of one supplier vary by about as much.
_SEGMENT_ERROR = 250.0


def q_seq_segments(spark, d):
    return segments.linear_segments(_ranked(spark, d), _SEGMENT_ERROR)


def q_seq_page_rank(spark, d):
    return sequence.rank_numbers(_page_numbers(spark, d))


# ---------------------------------------------------------------- filters and subsets

def q_prefix_filter(spark, d):
    return subset.substring_subset(table(spark, d, "customer"), "c_name", 16, 2, "11")


def q_or_filter(spark, d):
    return subset.predicate_subset(table(spark, d, "part"), "p_brand = 'Brand#13' OR p_brand = 'Brand#31'")


def q_and_filter(spark, d):
    o = table(spark, d, "orders")
    return subset.predicate_subset(o, F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT")


def q_subset_ordered(spark, d):
    return subset.ordered_subset(table(spark, d, "orders"), 100, "o_orderkey")


def q_subset_hash(spark, d):
    return subset.hash_sample(table(spark, d, "orders"), "o_orderkey", 0.1)


def q_subset_exact_100(spark, d):
    return selection.exact_sample(table(spark, d, "orders"), 100, "o_orderkey")


def q_subset_exact_10000(spark, d):
    return selection.exact_sample(table(spark, d, "orders"), 10_000, "o_orderkey")


def q_subset_exact_half(spark, d):
    orders = table(spark, d, "orders")
    return selection.exact_sample(orders, orders.count() // 2, "o_orderkey")


def q_subset_exact_texts(spark, d):
    return selection.exact_sample(table(spark, d, "documents"), 100, "doc_id", seed=7)


def q_subset_first_by_date(spark, d):
    return selection.first_rows(table(spark, d, "orders"), 1_000, "o_orderdate", "o_orderkey")


def q_subset_first_by_text(spark, d):
    return selection.first_rows(table(spark, d, "documents"), 150, "lang", "text", "doc_id")


# ---------------------------------------------------------------- whole jobs

def q_job_profile_csv(spark, d):
    # Tolerant profile of CSV files, value files written and loaded back on a second run.
    lines, out = scratch_path(spark, "csv"), scratch_path(spark, "unique")
    _customer_lines(spark, d).write.text(lines)
    jobs.profile_csv(spark, lines, rejects_out=scratch_path(spark, "rejects"), out=out)
    return jobs.profile_csv(spark, lines, out=out, resume=True)


def q_job_tf_index(spark, d):
    out = scratch_path(spark, "tf")
    jobs.build_tf_index(table(spark, d, "documents"), "doc_id", ["lang", "text"], tokenizer="words", out=out, id_alias="uuid")
    return spark.read.parquet(out)


def q_job_cross_reference(spark, d):
    out = scratch_path(spark, "xref")
    jobs.cross_reference_job(table(spark, d, "documents"), "doc_id", "doc_id", ["text"], out=out)
    return spark.read.parquet(out)


def q_job_number_sequence(spark, d):
    study = jobs.number_sequence(table(spark, d, "lineitem"), "l_orderkey", "l_suppkey")
    bad = study.bad.select(F.col("grp").alias("g2"), "n_zero_text", "n_bad")
    runs = study.islands.groupBy(F.col("grp").alias("g3")).agg(F.count("*").alias("n_islands"), F.max("n").alias("longest"))
    return (study.summary.join(bad, F.col("grp").eqNullSafe(F.col("g2"))).join(runs, F.col("grp").eqNullSafe(F.col("g3")))
            .drop("g2", "g3"))


def q_job_make_subset(spark, d):
    out = scratch_path(spark, "subset")
    jobs.make_subset(table(spark, d, "orders"), n=500, where=["o_orderstatus <> 'F'"], order_by=["o_custkey", "o_orderkey"], out=out)
    return spark.read.parquet(out)


def q_slug_fields(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", slug(F.concat_ws(" ", "p_type", "p_name", "p_brand")).alias("slug"))


# ---------------------------------------------------------------- fingerprints

def _prints(spark, d):
    return fp.vector_fingerprints(table(spark, d, "embeddings"), "vec_id", "embedding")


def q_fingerprint_hist(spark, d):
    return fp.fingerprint_histogram(_prints(spark, d))


def q_fingerprint_top(spark, d):
    return fp.top_fingerprints(_prints(spark, d), 20)


def q_fingerprint8_hist(spark, d):
    return fp.fingerprint_histogram(_prints(spark, d), "fingerprint8")


# ---------------------------------------------------------------- CSV text path

def _customer_lines(spark, d):
    return csvtext.to_csv_lines(table(spark, d, "customer"), header=True)


def q_csv_roundtrip_profile(spark, d):
    lines = _customer_lines(spark, d)
    parsed = csvtext.parse_lines(lines)
    return profile.value_profile(parsed.good)


def q_csv_file_profile(spark, d):
    # Stand-in input: customer rendered as CSV text files (header once, in the
    # first file); the reader finds the header, drops it and parses every line.
    lines = _customer_lines(spark, d)
    folder = scratch_path(spark, "csv")
    lines.write.text(folder)
    return profile.value_profile(csvtext.read_csv_records(spark, folder).good)


def q_csv_quoted_profile(spark, d):
    # Documents rendered as plain RFC CSV: texts keep their line ends, inside quotes.
    docs = table(spark, d, "documents")
    folder = scratch_path(spark, "csv")
    csvtext.to_csv_lines(docs, header=True).write.text(folder)
    return profile.value_profile(quoted.read_csv_quoted(spark, folder, strict=True).good)


def q_profile_files_roundtrip(spark, d):
    # Per-field value files written in one pass, then loaded back as one profile.
    cust = table(spark, d, "customer")
    folder = scratch_path(spark, "unique")
    write_field_csvs(profile.value_profile(cust), folder, cust.columns)
    return load_profile_dir(spark, folder)


def _orders_value_files(spark, d):
    o = table(spark, d, "orders")
    folder = scratch_path(spark, "unique")
    write_field_csvs(profile.value_profile(o), folder, o.columns)
    return load_profile_dir(spark, folder)


def q_cardinality_from_files(spark, d):
    # The file-based flow: value files per field -> loaded back -> cardinality report.
    return profile.cardinality_report(_orders_value_files(spark, d))


def q_cumulate_from_files(spark, d):
    # Value files per field -> loaded back -> frequency curves.
    return ordered.cumulate(_orders_value_files(spark, d))


def q_csv_column_pick(spark, d):
    lines = _customer_lines(spark, d)
    picked = lines.select(csvtext.naive_pick(F.col("value"), 2).alias("value"))
    return picked.groupBy("value").agg(F.count("*").alias("count"))


# ---------------------------------------------------------------- archive tables

ARCHIVE_CORE_TERMS = {"c_name": "http://rs.tdwg.org/dwc/terms/catalogNumber",
                      "c_mktsegment": "http://rs.tdwg.org/dwc/terms/basisOfRecord",
                      "c_nationkey": "http://purl.org/dc/terms/rightsHolder"}
ARCHIVE_EXT_TERMS = {"o_orderkey": "http://rs.tdwg.org/ac/terms/identifier",
                     "o_orderstatus": "http://ns.adobe.com/xap/1.0/rights/UsageTerms",
                     "o_orderpriority": "http://ns.adobe.com/xap/1.0/Rating"}


def q_archive_core_ext(spark, d):
    # Stand-in input: customer (core) and orders (extension, coreid = o_custkey)
    # written as a tab-separated archive with a descriptor; the loader does the rest.
    folder = scratch_path(spark, "archive")
    archive.write_archive(folder, table(spark, d, "customer"), "c_custkey", ARCHIVE_CORE_TERMS,
                          [("orders", table(spark, d, "orders"), "o_custkey", ARCHIVE_EXT_TERMS)],
                          core_defaults={"http://purl.org/dc/terms/type": "PhysicalObject"})
    arc = archive.load_archive(spark, folder)
    return archive.join_core_extension(arc.core, arc.extensions[0])


# ---------------------------------------------------------------- more coverage

def q_tf_index_multi(spark, d):
    # Several text columns joined into one note (NULL parts skipped).
    docs = table(spark, d, "documents")
    return tf.tf_index(docs, "doc_id", ["source", "lang", "text"], tokenizer="words")


def q_value_counts_nested(spark, d):
    return profile.value_counts(_events_nested(spark, d), "data.k")


def q_cardinality_nested(spark, d):
    return profile.cardinality(profile.value_profile(_events_nested(spark, d), nested=True))


def q_cumulate_tokens(spark, d):
    # Tens of thousands of distinct values in one field: the distributed prefix sum.
    return ordered.cumulate(tf.token_profile(table(spark, d, "documents"), ["text"], tokenizer="words"))


def q_value_profile_orders(spark, d):
    return profile.value_profile(table(spark, d, "orders"))


def q_freq_of_freq_lineitem(spark, d):
    return ordered.freq_of_freq(profile.value_profile(table(spark, d, "lineitem")))


def q_head_coverage_lineitem(spark, d):
    return ordered.head_coverage(profile.value_profile(table(spark, d, "lineitem")))


def q_seq_page_describe(spark, d):
    return sequence.describe(sequence.rank_numbers(_page_numbers(spark, d)))


def q_seq_page_gaps(spark, d):
    return sequence.gaps(sequence.rank_numbers(_page_numbers(spark, d)))


def q_archive_profile(spark, d):
    folder = scratch_path(spark, "archive")
    archive.write_archive(folder, table(spark, d, "customer"), "c_custkey", ARCHIVE_CORE_TERMS,
                          core_defaults={"http://purl.org/dc/terms/type": "PhysicalObject"})
    return profile.value_profile(archive.load_archive(spark, folder).core)


def q_tf_index_sql_api(spark, d):
    # The same index written in SQL with the library's SQL functions.
    from ..functions.sql import register_sql_functions
    register_sql_functions(spark)
    spread(table(spark, d, "documents").select("doc_id", "text")).createOrReplaceTempView("vs_documents")
    return spark.sql(
        "SELECT doc_id, token, count(*) AS count FROM "
        "(SELECT doc_id, explode(toks) AS token FROM "
        " (SELECT doc_id, vs_treebank_tokens(text) AS toks FROM vs_documents WHERE text <> '')) "
        "GROUP BY doc_id, token")


def q_fingerprint_hist_sql_api(spark, d):
    # The fingerprint histogram written in SQL with the library's SQL functions.
    from ..functions.sql import register_sql_functions
    register_sql_functions(spark)
    table(spark, d, "embeddings").createOrReplaceTempView("vs_embeddings")
    return spark.sql("SELECT vs_fingerprint64(embedding) AS fingerprint, count(*) AS count "
                     "FROM vs_embeddings GROUP BY vs_fingerprint64(embedding)")


# ---------------------------------------------------------------- streaming

def _file_glob(d: str, name: str) -> str:
    # File stream sources take a folder or a glob; the tables are single files.
    return f"{d.rstrip('/')}/{name}.parque[t]"


def q_stream_value_profile(spark, d):
    docs = table(spark, d, "documents")
    return profile_stream.stream_value_profile(
        spark, _file_glob(d, "documents"), docs.schema, docs.columns,
        scratch_path(spark, "stream-profile"), checkpoint=scratch_path(spark, "stream-profile-ckpt"))


def q_stream_tf_index(spark, d):
    docs = table(spark, d, "documents")
    return profile_stream.stream_tf_index(
        spark, _file_glob(d, "documents"), docs.schema, "doc_id", ["text"],
        scratch_path(spark, "stream-tf"), checkpoint=scratch_path(spark, "stream-tf-ckpt"))


# ---------------------------------------------------------------- files: any value survives

def _value_file_profile(spark, d, name):
    t = table(spark, d, name)
    folder = scratch_path(spark, "unique")
    write_field_csvs(profile.value_profile(t), folder, t.columns)
    return load_profile_dir(spark, folder)


def q_profile_files_text(spark, d):
    # Whole texts with line ends, quotes and blanks through the per-field value files.
    return _value_file_profile(spark, d, "documents")


def q_profile_files_pages(spark, d):
    return _value_file_profile(spark, d, "pages")


def q_profile_files_conversations(spark, d):
    return _value_file_profile(spark, d, "conversations")


def q_profile_partitioned_text(spark, d):
    # The long profile as CSV partitioned by field, read back.
    folder = scratch_path(spark, "partitioned")
    write_profile_partitioned(profile.value_profile(table(spark, d, "documents")), folder)
    back = (spark.read.schema("value string, count bigint, field string").option("escape", '"')
            .option("nullValue", "\u0000").csv(folder))
    return back.select("field", unescape_line(F.col("value")).alias("value"), "count")


def q_profile_resume(spark, d):
    # One field was finished before; the resumed job returns the whole profile.
    o = table(spark, d, "orders")
    folder = scratch_path(spark, "unique")
    jobs.profile_values(o, ["o_orderstatus"], out=folder)
    return jobs.profile_values(o, out=folder, resume=True)


def q_text_pairs(spark, d):
    # count,value lines, as written.
    path = scratch_path(spark, "pairs")
    write_text_pairs(profile.value_counts(table(spark, d, "conversations"), "text"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def q_csv_pairs(spark, d):
    # value,count CSV lines, parsed again.
    path = scratch_path(spark, "pairs")
    write_csv_pairs(profile.value_counts(table(spark, d, "conversations"), "text"), path)
    rec = F.from_csv(F.col("value"), "v string, c bigint", {"escape": '"'})
    return spark.read.text(path).select(rec.alias("r")).select(
        unescape_line(F.col("r.v")).alias("value"), F.col("r.c").alias("count"))


def q_archive_documents(spark, d):
    # Whole texts through an archive (core table), line ends and all.
    folder = scratch_path(spark, "archive")
    archive.write_archive(folder, table(spark, d, "documents"), "doc_id", {
        "text": "http://rs.tdwg.org/dwc/terms/occurrenceRemarks", "lang": "http://purl.org/dc/terms/language",
        "source": "http://rs.tdwg.org/dwc/terms/collectionCode", "n_chars": "http://rs.tdwg.org/dwc/terms/individualCount"})
    return archive.load_archive(spark, folder).core


# ---------------------------------------------------------------- CSV lines: strict, rejects, empty values

def _supplier_lines(spark, d):
    """Stand-in input: suppliers as CSV lines; every third has an empty name, every
    seventh an extra value."""
    s = table(spark, d, "supplier")
    lines = s.select("s_suppkey", F.concat_ws(
        ",", *[F.when(F.col("s_suppkey") % 3 == 0, F.lit("")).otherwise(F.col(c).cast("string")) if c == "s_name"
               else F.col(c).cast("string") for c in s.columns]).alias("value"))
    return s.columns, lines.select(F.when(F.col("s_suppkey") % 7 == 0, F.concat("value", F.lit(",extra")))
                                   .otherwise(F.col("value")).alias("value"))


def q_csv_rejects(spark, d):
    # Over-long lines go to the reject side output, as text.
    names, lines = _supplier_lines(spark, d)
    path = scratch_path(spark, "rejects")
    write_rejects(csvtext.parse_lines(lines, names).rejects, path)
    return spark.read.text(path)


def q_csv_tolerant_profile(spark, d):
    # Empty values are "" and reject lines still count, with "" in every field.
    names, lines = _supplier_lines(spark, d)
    return profile.value_profile(csvtext.parse_lines(lines, names).good)


def q_csv_strict_profile(spark, d):
    part = table(spark, d, "part")
    return profile.value_profile(csvtext.parse_lines(csvtext.to_csv_lines(part), part.columns, strict=True).good)


def _wide(spark, d):
    """Stand-in for a table of 200+ fields: six text forms of every lineitem column."""
    # Dealt out before the forms are made: few splits would make all of them alone.
    li = spread(table(spark, d, "lineitem"))
    out = []
    for c in li.columns:
        t = F.col(c).cast("string")
        out += [t.alias(f"{c}_0"), F.md5(t).alias(f"{c}_1"), F.length(t).cast("string").alias(f"{c}_2"),
                F.reverse(t).alias(f"{c}_3"), F.substring(t, 1, 3).alias(f"{c}_4"), F.upper(t).alias(f"{c}_5")]
    return li.select(*out)


def q_value_profile_wide(spark, d):
    # More than 64 fields: one pass through one array column.
    return profile.value_profile(_wide(spark, d))


# ---------------------------------------------------------------- parquet sinks, versioned paths

def q_versioned_dataset(spark, d):
    base = scratch_path(spark, "versions")
    for version, name in (("20240101", "part"), ("20240201", "supplier")):
        write_parquet(table(spark, d, name), dataset_path(base, "records", version, "-all"))
    return read_dataset(spark, base, "records", "20240201", "-all")


def q_parquet_overwrite(spark, d):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, d, "supplier"), path)
    write_parquet(table(spark, d, "part"), path)
    return spark.read.parquet(path)


def q_parquet_error_if_exists(spark, d):
    path = scratch_path(spark, "parquet")
    write_parquet(table(spark, d, "part"), path, mode="errorifexists")
    try:
        write_parquet(table(spark, d, "supplier"), path, mode="errorifexists")
    except AnalysisException as err:
        if "PATH_ALREADY_EXISTS" not in str(err):
            raise
    return spark.read.parquet(path)


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items())
    if name.startswith("q_") and callable(fn)
}

# ---------------------------------------------------------------- SQL checks

_CUST_TEXT = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
_ORD_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]

_PAGE_NUMBERS = (
    "SELECT string_split(url, '/')[3] AS grp, page_id, string_split(url, '/')[-1] AS catalognumber, "
    + O.to_int_sql("string_split(url, '/')[-1]") + " AS number FROM pages")
_LINE_NUMBERS = (
    "SELECT l_suppkey AS grp, CAST(l_orderkey AS VARCHAR) AS catalognumber, "
    + O.to_int_sql("CAST(l_orderkey AS VARCHAR)") + " AS number FROM lineitem")
_RANKED = (
    f"SELECT grp, CAST(row_number() OVER (PARTITION BY grp ORDER BY number) - 1 AS BIGINT) AS rank, number, "
    f"count(*) OVER (PARTITION BY grp) AS n FROM ({_LINE_NUMBERS})")


def _token_profile_sql(kind: str, lower: bool = False) -> str:
    v = "lower(token)" if lower else "token"
    return (f"SELECT 'token' AS field, {v} AS value, count(*) AS count FROM "
            f"(SELECT unnest({O.tokens_sql(kind, 'note')}) AS token FROM "
            f"(SELECT concat_ws(' ', text) AS note FROM documents) WHERE note <> '') GROUP BY {v}")


def _describe_sql() -> str:
    return (
        f"SELECT grp, count(*) AS count, avg(number) AS mean, "
        f"CASE WHEN count(*) > 1 THEN sqrt(CAST(count(*) * sum(CAST(number AS HUGEINT) * number) "
        f"- sum(CAST(number AS HUGEINT)) * sum(CAST(number AS HUGEINT)) AS DOUBLE) "
        f"/ CAST(count(*) * (count(*) - 1) AS DOUBLE)) END AS std, "
        f"min(number) AS min, quantile_cont(number, 0.25) AS p25, quantile_cont(number, 0.5) AS p50, "
        f"quantile_cont(number, 0.75) AS p75, max(number) AS max FROM ({_LINE_NUMBERS}) GROUP BY grp")


def _csv_profile_sql() -> str:
    return O.profile_sql("customer", _CUST_TEXT)


_PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]
_DOC_ALL = ["doc_id", "text", "lang", "source", "n_chars"]
_ESCAPED = "replace(replace(replace(text, chr(92), chr(92) || 's'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r')"
_SUPPLIER = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]
_SUPPLIER_LINE = ("concat_ws(',', CAST(s_suppkey AS VARCHAR), CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END, "
                  "CAST(s_nationkey AS VARCHAR), CAST(s_acctbal AS VARCHAR))")

_XREF_SQL = (
        f"WITH tf AS ({O.tf_index_sql('documents', 'doc_id', ['text'], 'treebank')}), "
        "ids AS (SELECT doc_id AS record_uuid, CAST(doc_id AS VARCHAR) AS record_identifier FROM documents), "
        "notes AS (SELECT doc_id AS note_uuid, concat_ws(' ', text) AS note FROM documents) "
        "SELECT record_uuid, record_identifier, tf.doc_id AS uuid, token, count, note_uuid, note, "
        "CAST(length(record_identifier) AS INTEGER) AS catalognumber_len "
        "FROM ids JOIN tf ON ids.record_identifier = tf.token JOIN notes ON tf.doc_id = notes.note_uuid")


def _islands_sql(numbers: str) -> str:
    return (f"SELECT grp, min(number) AS first, max(number) AS last, count(*) AS n FROM (SELECT grp, number, "
            f"number - dense_rank() OVER (PARTITION BY grp ORDER BY number) AS run FROM ({numbers})) GROUP BY grp, run")


def _heavy_sql(profile_sql: str) -> str:
    return (f"SELECT * FROM (SELECT field, value, count, CAST(sum(count) OVER (PARTITION BY field) AS BIGINT) AS total "
            f"FROM ({profile_sql})) WHERE count > total * {_HEAVY}::DOUBLE")


def _sample_sql(name: str, key: str, seed: int, n: str) -> str:
    h = f"CAST('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 15) AS UBIGINT)"
    return f"SELECT * FROM {name} ORDER BY {h}, {key} LIMIT {n}"


SQL: dict[str, str] = {
    "profile_files_text": O.profile_sql("documents", _DOC_ALL),
    "profile_files_pages": O.profile_sql("pages", ["page_id", "url", "html"]),
    "profile_files_conversations": O.profile_sql("conversations", ["conv_id", "turn", "role", "text"]),
    "profile_partitioned_text": O.profile_sql("documents", _DOC_ALL),
    "profile_resume": O.profile_sql("orders", _ORD_ALL),
    "text_pairs": f"SELECT CAST(count(*) AS VARCHAR) || ',' || coalesce({_ESCAPED}, '') AS line FROM conversations GROUP BY text",
    "csv_pairs": "SELECT text AS value, count(*) AS count FROM conversations GROUP BY text",
    "archive_documents": (
        "SELECT CAST(doc_id AS VARCHAR) AS id, nullif(text, '') AS \"dwc:occurrenceRemarks\", nullif(lang, '') AS \"dcterms:language\", "
        "nullif(source, '') AS \"dwc:collectionCode\", CAST(n_chars AS VARCHAR) AS \"dwc:individualCount\" FROM documents"),
    "csv_rejects": f"SELECT 'PROBLEM WITH: ' || {_SUPPLIER_LINE} || ',extra' AS value FROM supplier WHERE s_suppkey % 7 = 0",
    "csv_tolerant_profile": O.profile_sql(
        "(SELECT " + ", ".join(
            f"CASE WHEN s_suppkey % 7 = 0 THEN '' ELSE " + ("CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE s_name END" if c == "s_name"
                                                            else f"CAST({c} AS VARCHAR)") + f" END AS {c}"
            for c in _SUPPLIER) + " FROM supplier)", _SUPPLIER),
    "csv_strict_profile": O.profile_sql("part", _PART),
    "parquet_overwrite": "SELECT * FROM part",
    "versioned_dataset": "SELECT * FROM supplier",
    "value_profile_wide": O.profile_sql("(SELECT " + ", ".join(
        f"{t} AS {c}_0, md5({t}) AS {c}_1, CAST(length({t}) AS VARCHAR) AS {c}_2, reverse({t}) AS {c}_3, "
        f"left({t}, 3) AS {c}_4, upper({t}) AS {c}_5" for c in _LI_ALL for t in [f"CAST({c} AS VARCHAR)"]) + " FROM lineitem)",
        [f"{c}_{k}" for c in _LI_ALL for k in range(6)]),
    "parquet_error_if_exists": "SELECT * FROM part",
    "subset_hash": ("SELECT * FROM orders WHERE CAST('0x' || substr(md5('42:' || CAST(o_orderkey AS VARCHAR)), 1, 15) AS UBIGINT) "
                    f"< {int(0.1 * (1 << 60))}"),
    "cardinality_estimate": ("SELECT DISTINCT field, true AS within_5_percent FROM (" + O.profile_sql("lineitem", _LI_ALL) + ")"),
    "tf_index_words": O.tf_index_sql("documents", "doc_id", ["text"], "words"),
    "tf_index_treebank": O.tf_index_sql("documents", "doc_id", ["text"], "treebank"),
    "tf_index_conversations": O.tf_index_sql(
        "(SELECT concat_ws(':', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)) AS uuid, role, text FROM conversations)",
        "uuid", ["role", "text"], "treebank"),
    "notes_nonempty": ("SELECT doc_id, note FROM (SELECT doc_id, concat_ws(' ', nullif(lang, 'en'), "
                       "nullif(source, 'src0')) AS note FROM documents) WHERE note <> ''"),
    "line_count": "SELECT count(*) AS n FROM lineitem",
    "value_counts_one": "SELECT source AS value, count(*) AS count FROM documents GROUP BY source",
    "value_counts_sql": "SELECT o_orderpriority AS value, count(*) AS count FROM orders GROUP BY o_orderpriority",
    "value_profile_all": O.profile_sql("customer", _CUST_TEXT),
    "value_profile_lineitem": O.profile_sql("lineitem", _LI_ALL),
    "value_profile_events": O.profile_sql("events", ["event_id", "ts", "user_id", "event_type", "value", "props"]),
    "value_profile_nested": O.profile_sql(
        "(SELECT user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)",
        ["user_id", "event_type", "data.k"], {"data.k": "k"}),
    "cardinality": (
        f"WITH p AS ({O.profile_sql('lineitem', _LI_ALL)}), c AS (SELECT field, count(*) AS card FROM p GROUP BY field), "
        "m AS (SELECT *, max(card) OVER () AS mx FROM c), "
        "k AS (SELECT field, card FROM m WHERE card > 100 AND CAST(card AS DOUBLE) < CAST(mx AS DOUBLE) * 0.95) "
        "SELECT field, card, CAST(row_number() OVER (ORDER BY card DESC, field) - 1 AS BIGINT) AS x FROM k"),
    "cardinality_all": (f"SELECT field, count(*) AS card FROM ({O.profile_sql('orders', _ORD_ALL)}) GROUP BY field"),
    "cumulate": O.cumulate_sql(O.profile_sql("lineitem", _LI_ALL)),
    # Tokenised once; the clean profile comes from the raw one, each curve is kept.
    "compare_raw_clean": (
        f"WITH p AS MATERIALIZED ({_token_profile_sql('treebank')}), "
        "q AS MATERIALIZED (SELECT field, lower(value) AS value, CAST(sum(count) AS BIGINT) AS count FROM p GROUP BY field, lower(value)), "
        f"c AS MATERIALIZED ({O.cumulate_sql('SELECT * FROM q')}), r AS MATERIALIZED ({O.cumulate_sql('SELECT * FROM p')}), "
        "b AS (SELECT DISTINCT field FROM c WHERE field IN (SELECT field FROM r)), "
        "cs AS (SELECT field, x, value AS clean_value, count AS clean_count, cum_count AS clean_cum_count FROM c WHERE field IN (SELECT field FROM b)), "
        "rs AS (SELECT field, x, value AS raw_value, count AS raw_count, cum_count AS raw_cum_count FROM r WHERE field IN (SELECT field FROM b)) "
        "SELECT COALESCE(cs.field, rs.field) AS field, COALESCE(cs.x, rs.x) AS x, clean_value, clean_count, clean_cum_count, "
        "raw_value, raw_count, raw_cum_count FROM cs FULL OUTER JOIN rs ON cs.field = rs.field AND cs.x = rs.x"),
    "freq_of_freq": (
        f"SELECT field, count, count(*) AS n_values, count * count(*) AS records FROM ({_token_profile_sql('words')}) "
        "WHERE value IS NOT NULL AND value <> '' GROUP BY field, count"),
    "head_coverage": (
        f"WITH cl AS (SELECT field, count, count(*) AS n_values, count * count(*) AS recs FROM ({_token_profile_sql('words')}) "
        "WHERE value IS NOT NULL AND value <> '' GROUP BY field, count), "
        "w AS (SELECT *, sum(recs) OVER (PARTITION BY field ORDER BY count DESC ROWS UNBOUNDED PRECEDING) AS recs_upto, "
        "sum(n_values) OVER (PARTITION BY field ORDER BY count DESC ROWS UNBOUNDED PRECEDING) AS vals_upto, "
        "sum(recs) OVER (PARTITION BY field) AS total_records, sum(n_values) OVER (PARTITION BY field) AS total_values FROM cl), "
        "p AS (SELECT *, CAST(ceil(CAST(total_records AS DOUBLE) * percent / 100.0) AS BIGINT) AS target FROM w, "
        "(SELECT unnest([50.0, 80.0, 90.0, 99.0]::DOUBLE[]) AS percent)), "
        "c AS (SELECT *, vals_upto - n_values + CAST(ceil(CAST(target - (recs_upto - recs) AS DOUBLE) / CAST(count AS DOUBLE)) AS BIGINT) AS need "
        "FROM p WHERE recs_upto >= target AND recs_upto - recs < target) "
        "SELECT field, percent, CAST(total_records AS BIGINT) AS total_records, CAST(total_values AS BIGINT) AS total_values, "
        "CAST(need AS BIGINT) AS values_needed, CAST(need AS DOUBLE) / CAST(total_values AS DOUBLE) * 100.0 AS values_perc FROM c"),
    "id_cross_reference": _XREF_SQL,
    "id_length_hist": (
        f"WITH tf AS ({O.tf_index_sql('documents', 'doc_id', ['text'], 'treebank')}), "
        "ids AS (SELECT doc_id AS record_uuid, CAST(doc_id AS VARCHAR) AS record_identifier FROM documents), "
        "notes AS (SELECT doc_id AS note_uuid, concat_ws(' ', text) AS note FROM documents), "
        "j AS (SELECT CAST(length(record_identifier) AS INTEGER) AS catalognumber_len FROM ids "
        "JOIN tf ON ids.record_identifier = tf.token JOIN notes ON tf.doc_id = notes.note_uuid) "
        "SELECT catalognumber_len, count(*) AS count, log10(CAST(count(*) AS DOUBLE)) AS log_count FROM j GROUP BY catalognumber_len"),
    "seq_to_int": f"SELECT page_id, catalognumber, number FROM ({_PAGE_NUMBERS})",
    "seq_bad_count": (
        f"SELECT grp, count(*) AS n, CAST(sum(CASE WHEN catalognumber = '0' THEN 1 ELSE 0 END) AS BIGINT) AS n_zero_text, "
        f"CAST(sum(CASE WHEN number = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad FROM ({_PAGE_NUMBERS}) GROUP BY grp"),
    "seq_rank": _RANKED,
    "seq_slice": f"SELECT * FROM ({_RANKED}) WHERE rank >= 100 AND rank < 300",
    "seq_drop_last": f"SELECT * FROM ({_RANKED}) WHERE rank >= 0 AND rank < n - 3",
    "seq_tail": f"SELECT * FROM ({_RANKED}) WHERE rank >= n - 10",
    "seq_zoom": f"SELECT * FROM ({_RANKED}) WHERE rank >= 100 AND rank < 400 AND number BETWEEN 2000 AND 9000",
    "seq_describe": _describe_sql(),
    "seq_gaps": (
        f"SELECT * FROM (SELECT grp, rank, number, lead(number) OVER (PARTITION BY grp ORDER BY rank) AS next_number, "
        f"lead(number) OVER (PARTITION BY grp ORDER BY rank) - number AS gap FROM ({_RANKED})) WHERE gap >= 2"),
    "seq_repeats": (f"SELECT grp, number, count(*) AS count FROM ({_LINE_NUMBERS}) GROUP BY grp, number HAVING count(*) > 1"),
    "seq_slopes": (
        f"SELECT grp, bucket, first_rank, last_rank, first_number, last_number, "
        f"CASE WHEN last_rank - first_rank > 0 THEN CAST(last_number - first_number AS DOUBLE) / CAST(last_rank - first_rank AS DOUBLE) END AS slope "
        f"FROM (SELECT grp, CAST(floor(rank / 100) AS BIGINT) AS bucket, min(rank) AS first_rank, max(rank) AS last_rank, "
        f"min(number) AS first_number, max(number) AS last_number FROM ({_RANKED}) GROUP BY grp, bucket)"),
    "cardinality_sketched": ("SELECT DISTINCT source, unnest(['doc_id', 'text', 'lang', 'n_chars']) AS field, "
                             "true AS within_5_percent FROM documents"),
    "heavy_values": _heavy_sql(O.profile_sql("lineitem", _LI_ALL)),
    "heavy_tokens": _heavy_sql(_token_profile_sql("words")),
    "deep_profile": (
        "WITH RECURSIVE w AS (SELECT '$' AS path, CAST(props AS JSON) AS v FROM events UNION ALL "
        "SELECT path || '.' || k, json_extract(v, '$.' || k) FROM (SELECT path, v, unnest(json_keys(v)) AS k FROM w WHERE json_type(v) = 'OBJECT')) "
        "SELECT path, json_extract_string(v, '$') AS value, count(*) AS count FROM w "
        "WHERE v IS NULL OR json_type(v) <> 'OBJECT' OR json_keys(v) = [] GROUP BY ALL"),
    "named_outputs": " UNION ALL ".join(
        f"SELECT 'orders-2024-01-pairs-{f}' AS output, CAST(count(*) AS VARCHAR) || ',' || coalesce({f}, '') AS value "
        f"FROM orders GROUP BY {f}" for f in ("o_orderstatus", "o_orderpriority")),
    "seq_islands": _islands_sql(_LINE_NUMBERS),
    "seq_page_islands": _islands_sql(_PAGE_NUMBERS),
    # One row a step: the cone of slopes from the segment's first point.
    "seq_segments": (
        f"WITH RECURSIVE r AS MATERIALIZED ({_RANKED}), walk AS ("
        "SELECT grp, rank, number, rank AS x0, number AS y0, '-infinity'::DOUBLE AS lo, 'infinity'::DOUBLE AS hi FROM r WHERE rank = 0 "
        "UNION ALL SELECT grp, rank, number, CASE WHEN nlo <= nhi THEN x0 ELSE rank END, CASE WHEN nlo <= nhi THEN y0 ELSE number END, "
        "CASE WHEN nlo <= nhi THEN nlo ELSE '-infinity'::DOUBLE END, CASE WHEN nlo <= nhi THEN nhi ELSE 'infinity'::DOUBLE END FROM ("
        "SELECT r.grp, r.rank, r.number, x0, y0, "
        f"greatest(lo, (r.number - {_SEGMENT_ERROR}::DOUBLE - y0) / CAST(r.rank - x0 AS DOUBLE)) AS nlo, "
        f"least(hi, (r.number + {_SEGMENT_ERROR}::DOUBLE - y0) / CAST(r.rank - x0 AS DOUBLE)) AS nhi "
        "FROM walk JOIN r ON r.grp = walk.grp AND r.rank = walk.rank + 1)) "
        "SELECT grp, x0 AS first_rank, max(rank) AS last_rank, y0 AS first_number, max(number) AS last_number, "
        "max(rank) - x0 + 1 AS n, CASE WHEN max(rank) > x0 THEN (arg_max(lo, rank) + arg_max(hi, rank)) / 2 END AS slope "
        "FROM walk GROUP BY grp, x0, y0"),
    "subset_exact_100": _sample_sql("orders", "o_orderkey", 42, "100"),
    "subset_exact_10000": _sample_sql("orders", "o_orderkey", 42, "10000"),
    "subset_exact_half": _sample_sql("orders", "o_orderkey", 42, "(SELECT count(*) // 2 FROM orders)"),
    "subset_exact_texts": _sample_sql("documents", "doc_id", 7, "100"),
    "subset_first_by_date": "SELECT * FROM orders ORDER BY o_orderdate NULLS FIRST, o_orderkey LIMIT 1000",
    "subset_first_by_text": ("SELECT * FROM documents ORDER BY encode(lang) NULLS FIRST, encode(text) NULLS FIRST, doc_id LIMIT 150"),
    "csv_quoted_profile": O.profile_sql(
        "(SELECT " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '') AS {c}" for c in _DOC_ALL) + " FROM documents)", _DOC_ALL),
    "job_profile_csv": _csv_profile_sql(),
    "job_tf_index": "SELECT doc_id AS uuid, token, count FROM (" + O.tf_index_sql("documents", "doc_id", ["lang", "text"], "words") + ")",
    "job_cross_reference": _XREF_SQL,
    "job_number_sequence": (
        f"SELECT s.*, n_zero_text, n_bad, n_islands, longest FROM ({_describe_sql()}) s JOIN ("
        "SELECT grp, CAST(sum(CASE WHEN catalognumber = '0' THEN 1 ELSE 0 END) AS BIGINT) AS n_zero_text, "
        f"CAST(sum(CASE WHEN number = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_bad FROM ({_LINE_NUMBERS}) GROUP BY grp) b "
        "ON s.grp IS NOT DISTINCT FROM b.grp JOIN (SELECT grp, count(*) AS n_islands, max(n) AS longest FROM "
        f"({_islands_sql(_LINE_NUMBERS)}) GROUP BY grp) i ON s.grp IS NOT DISTINCT FROM i.grp"),
    "job_make_subset": "SELECT * FROM orders WHERE o_orderstatus <> 'F' ORDER BY o_custkey NULLS FIRST, o_orderkey LIMIT 500",
    "seq_page_rank": (
        f"SELECT grp, CAST(row_number() OVER (PARTITION BY grp ORDER BY number) - 1 AS BIGINT) AS rank, number, "
        f"count(*) OVER (PARTITION BY grp) AS n FROM ({_PAGE_NUMBERS})"),
    "prefix_filter": "SELECT * FROM customer WHERE substring(c_name, 16, 2) = '11'",
    "or_filter": "SELECT * FROM part WHERE p_brand = 'Brand#13' OR p_brand = 'Brand#31'",
    "and_filter": "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'",
    "subset_ordered": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 100",
    "slug_fields": ("SELECT p_partkey, regexp_replace(concat_ws(' ', p_type, p_name, p_brand), '[\\W_]+', '_', 'g') AS slug "
                    "FROM part"),
    "fingerprint_hist": (f"SELECT {O.fingerprint64_sql('embedding')} AS fingerprint, count(*) AS count "
                         "FROM embeddings GROUP BY 1"),
    "fingerprint_top": (f"SELECT {O.fingerprint64_sql('embedding')} AS fingerprint, count(*) AS count "
                        "FROM embeddings GROUP BY 1 ORDER BY count DESC, fingerprint ASC NULLS FIRST LIMIT 20"),
    "fingerprint8_hist": (f"SELECT {O.fold8_sql('embedding')} AS fingerprint8, count(*) AS count "
                          "FROM embeddings GROUP BY 1"),
    "csv_roundtrip_profile": _csv_profile_sql(),
    "archive_core_ext": (
        "SELECT CAST(c.c_custkey AS VARCHAR) AS id, c.c_name AS \"dwc:catalogNumber\", "
        "c.c_mktsegment AS \"dwc:basisOfRecord\", CAST(c.c_nationkey AS VARCHAR) AS \"dcterms:rightsHolder\", "
        "'PhysicalObject' AS \"dcterms:type\", CAST(o.o_custkey AS VARCHAR) AS coreid, "
        "CAST(o.o_orderkey AS VARCHAR) AS \"ac:identifier\", o.o_orderstatus AS \"xmpRights:UsageTerms\", "
        "o.o_orderpriority AS \"xmp:Rating\" FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey"),
    "cardinality_from_files": (
        f"WITH p AS ({O.profile_sql('orders', _ORD_ALL)}), "
        "c AS (SELECT field, count(*) AS card FROM p GROUP BY field), m AS (SELECT *, max(card) OVER () AS mx FROM c), "
        "k AS (SELECT field, card FROM m WHERE card > 100 AND CAST(card AS DOUBLE) < CAST(mx AS DOUBLE) * 0.95) "
        "SELECT field, card, CAST(row_number() OVER (ORDER BY card DESC, field) - 1 AS BIGINT) AS x FROM k"),
    "cumulate_from_files": O.cumulate_sql(O.profile_sql("orders", _ORD_ALL)),
    "value_profile_by_source": " UNION ALL ".join(
        f"SELECT source, '{c}' AS field, CAST({c} AS VARCHAR) AS value, count(*) AS count FROM documents GROUP BY source, {c}"
        for c in _SOURCE_FIELDS),
    "cardinality_by_source": "SELECT source, field, count(*) AS card FROM (" + " UNION ALL ".join(
        f"SELECT source, '{c}' AS field, CAST({c} AS VARCHAR) AS value FROM documents GROUP BY source, {c}"
        for c in _SOURCE_FIELDS) + ") GROUP BY source, field",
    "fingerprint_hist_sql_api": (f"SELECT {O.fingerprint64_sql('embedding')} AS fingerprint, count(*) AS count "
                                 "FROM embeddings GROUP BY 1"),
    "tf_index_sql_api": O.tf_index_sql("documents", "doc_id", ["text"], "treebank"),
    "stream_value_profile": O.profile_sql("documents", ["doc_id", "text", "lang", "source", "n_chars"]),
    "stream_tf_index": O.tf_index_sql("documents", "doc_id", ["text"], "treebank"),
    "tf_index_multi": O.tf_index_sql("documents", "doc_id", ["source", "lang", "text"], "words"),
    "value_counts_nested": ("SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS value, count(*) AS count "
                            "FROM events GROUP BY 1"),
    "cardinality_nested": (
        "SELECT field, count(*) AS card FROM (" + O.profile_sql(
            "(SELECT user_id, event_type, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events)",
            ["user_id", "event_type", "data.k"], {"data.k": "k"}) + ") GROUP BY field"),
    "cumulate_tokens": O.cumulate_sql(_token_profile_sql("words")),
    "value_profile_orders": O.profile_sql("orders", _ORD_ALL),
    "freq_of_freq_lineitem": (
        f"SELECT field, count, count(*) AS n_values, count * count(*) AS records FROM "
        f"({O.profile_sql('lineitem', _LI_ALL)}) WHERE value IS NOT NULL AND value <> '' GROUP BY field, count"),
    "head_coverage_lineitem": (
        f"WITH cl AS (SELECT field, count, count(*) AS n_values, count * count(*) AS recs FROM ({O.profile_sql('lineitem', _LI_ALL)}) "
        "WHERE value IS NOT NULL AND value <> '' GROUP BY field, count), "
        "w AS (SELECT *, sum(recs) OVER (PARTITION BY field ORDER BY count DESC ROWS UNBOUNDED PRECEDING) AS recs_upto, "
        "sum(n_values) OVER (PARTITION BY field ORDER BY count DESC ROWS UNBOUNDED PRECEDING) AS vals_upto, "
        "sum(recs) OVER (PARTITION BY field) AS total_records, sum(n_values) OVER (PARTITION BY field) AS total_values FROM cl), "
        "p AS (SELECT *, CAST(ceil(CAST(total_records AS DOUBLE) * percent / 100.0) AS BIGINT) AS target FROM w, "
        "(SELECT unnest([50.0, 80.0, 90.0, 99.0]::DOUBLE[]) AS percent)), "
        "c AS (SELECT *, vals_upto - n_values + CAST(ceil(CAST(target - (recs_upto - recs) AS DOUBLE) / CAST(count AS DOUBLE)) AS BIGINT) AS need "
        "FROM p WHERE recs_upto >= target AND recs_upto - recs < target) "
        "SELECT field, percent, CAST(total_records AS BIGINT) AS total_records, CAST(total_values AS BIGINT) AS total_values, "
        "CAST(need AS BIGINT) AS values_needed, CAST(need AS DOUBLE) / CAST(total_values AS DOUBLE) * 100.0 AS values_perc FROM c"),
    "seq_page_describe": (
        f"SELECT grp, count(*) AS count, avg(number) AS mean, "
        f"CASE WHEN count(*) > 1 THEN sqrt(CAST(count(*) * sum(CAST(number AS HUGEINT) * number) "
        f"- sum(CAST(number AS HUGEINT)) * sum(CAST(number AS HUGEINT)) AS DOUBLE) "
        f"/ CAST(count(*) * (count(*) - 1) AS DOUBLE)) END AS std, min(number) AS min, "
        f"quantile_cont(number, 0.25) AS p25, quantile_cont(number, 0.5) AS p50, "
        f"quantile_cont(number, 0.75) AS p75, max(number) AS max FROM ({_PAGE_NUMBERS}) GROUP BY grp"),
    "seq_page_gaps": (
        f"SELECT * FROM (SELECT grp, rank, number, lead(number) OVER (PARTITION BY grp ORDER BY rank) AS next_number, "
        f"lead(number) OVER (PARTITION BY grp ORDER BY rank) - number AS gap FROM "
        f"(SELECT grp, CAST(row_number() OVER (PARTITION BY grp ORDER BY number) - 1 AS BIGINT) AS rank, number "
        f"FROM ({_PAGE_NUMBERS}))) WHERE gap >= 2"),
    "archive_profile": O.profile_sql(
        "(SELECT CAST(c_custkey AS VARCHAR) AS id, c_name, c_mktsegment, CAST(c_nationkey AS VARCHAR) AS c_nationkey, "
        "'PhysicalObject' AS t FROM customer)",
        ["id", "dwc:catalogNumber", "dwc:basisOfRecord", "dcterms:rightsHolder", "dcterms:type"],
        {"dwc:catalogNumber": "c_name", "dwc:basisOfRecord": "c_mktsegment",
         "dcterms:rightsHolder": "c_nationkey", "dcterms:type": "t"}),
    "csv_file_profile": _csv_profile_sql(),
    "profile_files_roundtrip": O.profile_sql("customer", _CUST_TEXT),
    "csv_column_pick": ("SELECT value, count(*) AS count FROM (SELECT CAST(c_nationkey AS VARCHAR) AS value FROM customer "
                        "UNION ALL SELECT 'c_nationkey') GROUP BY value"),
}
