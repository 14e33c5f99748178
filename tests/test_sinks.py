"""Per-field value files with resume, partitioned profile, text pairs, profile loader."""

import os

from valuescope.operators import profile
from valuescope.sinks import done_fields, write_csv_pairs, write_field_csvs, write_profile_partitioned, write_text_pairs
from valuescope.sources.profiles import load_profile_dir


def test_field_files_roundtrip_and_resume(spark, tmp_dir):
    df = spark.createDataFrame([("a", None), ("a", "x"), ("b", ""), (None, "x")], "`dwc:genus` string, f2 string")
    prof = profile.value_profile(df)
    folder = os.path.join(tmp_dir, "unique")
    written = write_field_csvs(prof, folder, ["dwc:genus", "f2"])
    assert written == ["dwc:genus", "f2"]
    assert sorted(os.listdir(folder)) == ["unique_dwc_genus.csv", "unique_f2.csv"]
    assert done_fields(spark, folder, ["dwc:genus", "f2"]) == ["dwc:genus", "f2"]
    assert write_field_csvs(prof, folder, ["dwc:genus", "f2"]) == []  # resume: nothing to do
    back = load_profile_dir(spark, folder)
    got = {(r["field"], r["value"], r["count"]) for r in back.collect()}
    # NULL is written as an empty field and "" as a quoted empty string.
    assert ("dwc:genus", "a", 2) in got and ("f2", "x", 2) in got
    assert ("f2", "", 1) in got and ("f2", None, 1) in got
    assert {r["field"] for r in load_profile_dir(spark, folder, ["dwc:genus"]).collect()} == {"dwc:genus"}
    only = load_profile_dir(spark, folder, ["f2"])
    assert {r["field"] for r in only.collect()} == {"f2"}


def test_partitioned_profile_prunes(spark, tmp_dir):
    df = spark.createDataFrame([("a", "x"), ("b", "y")], "f1 string, f2 string")
    out = os.path.join(tmp_dir, "prof")
    write_profile_partitioned(profile.value_profile(df), out)
    back = spark.read.schema("value string, count bigint, field string").csv(out).where("field = 'f1'")
    assert sorted(r["value"] for r in back.collect()) == ["a", "b"]


def test_text_pairs_count_first(spark, tmp_dir):
    counts = spark.createDataFrame([("Smith, J.", 3)], "value string, count bigint")
    out = os.path.join(tmp_dir, "pairs")
    write_text_pairs(counts, out)
    assert [r[0] for r in spark.read.text(out).collect()] == ["3,Smith, J."]


def test_profile_parquet_partitioned_by_field(spark, tmp_dir):
    from valuescope.sinks import write_profile_parquet
    df = spark.createDataFrame([("a", "x"), ("b", "y"), (None, "y")], "`dwc:genus` string, f2 string")
    out = os.path.join(tmp_dir, "pq")
    write_profile_parquet(profile.value_profile(df), out)
    back = spark.read.parquet(out)
    plan = back.where("field = 'f2'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(field" in plan
    assert {(r["value"], r["count"]) for r in back.where("field = 'f2'").collect()} == {("x", 1), ("y", 2)}


def test_partitioned_write_file_count_is_tasks_plus_fields(spark, tmp_dir):
    import glob
    from pyspark.sql import functions as F
    wide = spark.range(0, 5000, 1, 8).select(
        *[((F.col("id") * (i + 3)) % 97).cast("string").alias(f"f{i}") for i in range(30)])
    out = os.path.join(tmp_dir, "parts")
    write_profile_partitioned(profile.value_profile(wide), out)
    files = [p for p in glob.glob(os.path.join(out, "field=*", "part-*")) if not p.endswith(".crc")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(files) <= parts + 30  # not tasks x fields (= 240 here)


AWKWARD = [" a", "a ", "a", " ", "", None, "x\ny", "x\r\ny", "\\n", "\\", "\\s", "a\0b", "\ufeffbom", 'q"u,o', '"', ",", "\t"]


def test_any_value_survives_the_value_files(spark, tmp_dir):
    df = spark.createDataFrame([(v,) for v in AWKWARD] * 2, "`dwc:notes` string")
    prof = profile.value_profile(df)
    folder = os.path.join(tmp_dir, "u")
    write_field_csvs(prof, folder, ["dwc:notes"])
    back = [tuple(r) for r in load_profile_dir(spark, folder).collect()]
    assert sorted(back, key=str) == sorted([("dwc:notes", v, 2) for v in AWKWARD], key=str)


def test_text_and_csv_pairs_keep_blanks_and_null(spark, tmp_dir):
    counts = spark.createDataFrame([(None, 3), (" a ", 2), ("x\ny", 1)], "value string, count bigint")
    out = os.path.join(tmp_dir, "pairs")
    write_text_pairs(counts, out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == ["1,x\\ny", "2, a ", "3,"]
    write_csv_pairs(counts.where("value is not null"), out)
    assert sorted(r[0] for r in spark.read.text(out).collect()) == [" a ,2", "x\\ny,1"]
