"""Composite jobs end to end."""

import os

from valuescope import jobs

SF = "/root/testdata/sf0.001"


def test_profile_values_writes_and_resumes(spark, tmp_dir):
    cust = spark.read.parquet(f"{SF}/customer.parquet")
    out = os.path.join(tmp_dir, "u")
    prof = jobs.profile_values(cust, ["c_mktsegment", "c_nationkey"], out=out)
    assert prof.count() > 0
    assert sorted(os.listdir(out)) == ["unique_c_mktsegment.csv", "unique_c_nationkey.csv"]
    # A finished field is read back; the returned profile is whole either way.
    both = jobs.profile_values(cust, ["c_mktsegment", "c_nationkey", "c_name"], out=out, resume=True)
    whole = jobs.profile_values(cust, ["c_mktsegment", "c_nationkey", "c_name"])
    assert sorted(map(str, both.collect())) == sorted(map(str, whole.collect()))
    again = jobs.profile_values(cust, ["c_mktsegment", "c_nationkey"], out=out, resume=True)
    assert sorted(map(str, again.collect())) == sorted(map(str, prof.collect()))


def test_without_resume_a_rerun_replaces_stale_files(spark, tmp_dir):
    from valuescope.sources.profiles import load_profile_dir
    out = os.path.join(tmp_dir, "u")
    jobs.profile_values(spark.createDataFrame([("old",)], "f string"), out=out)
    jobs.profile_values(spark.createDataFrame([("new",)], "f string"), out=out)
    assert [tuple(r) for r in load_profile_dir(spark, out).collect()] == [("f", "new", 1)]


def test_number_sequence_bundle(spark):
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    s = jobs.number_sequence(li, "l_orderkey", "l_suppkey", slope_width=50)
    n = li.count()
    assert s.ranked.count() == n
    assert s.summary.agg({"count": "sum"}).first()[0] == n
    # Every key is numeric: only a genuine key 0 parses to 0.
    assert s.bad.agg({"n_bad": "sum"}).first()[0] == li.where("l_orderkey = 0").count()


def test_cross_reference_job(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows, hist = jobs.cross_reference_job(docs, "doc_id", "doc_id", ["text"])
    total = hist.agg({"count": "sum"}).first()[0] or 0
    assert rows.count() == total


def test_make_subset(spark, tmp_dir):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    out = os.path.join(tmp_dir, "sub")
    sub = jobs.make_subset(orders, n=10, where=["o_orderstatus = 'F'"], order_by=["o_orderkey"], out=out)
    got = [r["o_orderkey"] for r in spark.read.parquet(out).orderBy("o_orderkey").collect()]
    assert got == [r["o_orderkey"] for r in sub.collect()] and len(got) == 10
    assert jobs.shape(orders)[1] == len(orders.columns)


def test_small_helpers(spark, tmp_dir):
    from valuescope.operators.subset import random_sample
    from valuescope.sources.paths import dataset_path, read_dataset
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    n = orders.count()
    assert 0 < random_sample(orders, 0.5, seed=7).count() < n
    orders.write.parquet(os.path.join(tmp_dir, "orders-20161119-100k.parquet"))
    assert dataset_path(tmp_dir, "orders", "20161119", "-100k").endswith("orders-20161119-100k.parquet")
    assert read_dataset(spark, tmp_dir, "orders", "20161119", "-100k").count() == n
    text = os.path.join(tmp_dir, "dump.txt")
    with open(text, "w") as f:
        f.write("a\nb\n\nc\n")
    assert jobs.row_count_text(spark, text) == 4


def test_profile_csv_with_rejects(spark, tmp_dir):
    path = os.path.join(tmp_dir, "in.csv")
    with open(path, "w") as f:
        f.write("a,b\n1,x\n2,y,extra\n3,\n")
    rejects = os.path.join(tmp_dir, "rej")
    prof = jobs.profile_csv(spark, path, rejects_out=rejects)
    got = {(r["field"], r["value"], r["count"]) for r in prof.collect()}
    assert ("a", "", 1) in got and ("b", "", 2) in got and ("a", "1", 1) in got
    assert [r[0] for r in spark.read.text(rejects).collect()] == ["PROBLEM WITH: 2,y,extra"]


def test_compare_skips_fields_missing_in_raw(spark):
    from valuescope.operators.ordered import compare_profiles
    clean = spark.createDataFrame([("f", "a", 2), ("only_clean", "z", 1)], "field string, value string, count bigint")
    raw = spark.createDataFrame([("f", "a", 1), ("f", "A", 1)], "field string, value string, count bigint")
    rows = compare_profiles(clean, raw).collect()
    assert {r["field"] for r in rows} == {"f"} and len(rows) == 2


def test_hash_sample_is_partitioning_independent(spark):
    from valuescope.operators.subset import hash_sample
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    a = {r["o_orderkey"] for r in hash_sample(orders, "o_orderkey", 0.2).collect()}
    b = {r["o_orderkey"] for r in hash_sample(orders.repartition(7), "o_orderkey", 0.2).collect()}
    assert a == b and 0 < len(a) < orders.count()


def test_make_subset_hash_fraction(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    a = jobs.make_subset(orders, fraction=0.3, key="o_orderkey")
    b = jobs.make_subset(orders, fraction=0.3, key="o_orderkey")
    assert a.count() == b.count() and 0 < a.count() < orders.count()
    assert a.exceptAll(b).count() == 0
