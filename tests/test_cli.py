"""Command line jobs."""

import os

from valuescope.__main__ import main

SF = "/root/testdata/sf0.001"


def test_cli_profile_and_cardinality(spark, tmp_dir):
    out = os.path.join(tmp_dir, "u")
    assert main(["profile", "--input", f"{SF}/customer.parquet", "--out", out,
                 "--fields", "c_mktsegment,c_nationkey"]) == 0
    assert sorted(os.listdir(out)) == ["unique_c_mktsegment.csv", "unique_c_nationkey.csv"]
    card = os.path.join(tmp_dir, "card")
    assert main(["cardinality", "--input", f"{SF}/customer.parquet", "--out", card, "--approx"]) == 0


def test_cli_sequence_and_tf(spark, tmp_dir):
    out = os.path.join(tmp_dir, "seq")
    assert main(["sequence", "--input", f"{SF}/lineitem.parquet", "--out", out,
                 "--ident", "l_orderkey", "--group", "l_suppkey"]) == 0
    assert set(os.listdir(out)) == {"ranked", "bad", "summary", "repeats", "gaps", "slopes"}
    tf_out = os.path.join(tmp_dir, "tf")
    assert main(["tf-index", "--input", f"{SF}/documents.parquet", "--out", tf_out,
                 "--id", "doc_id", "--text", "text", "--tokenizer", "words"]) == 0


def test_release_scratch(spark):
    from valuescope.session import pin, release_scratch
    kept = pin(spark.range(10))
    assert kept.count() == 10
    assert release_scratch(spark) >= 1


def test_cli_csv_profile_with_rejects(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in.csv")
    with open(src, "w") as f:
        f.write("dwc:genus,b\nAcer,1\nQuercus,2,3\n")
    out, rej = os.path.join(tmp_dir, "u"), os.path.join(tmp_dir, "rej")
    assert main(["profile", "--format", "csv", "--input", src, "--out", out, "--rejects", rej]) == 0
    assert sorted(os.listdir(out)) == ["unique_b.csv", "unique_dwc_genus.csv"]
    assert [r[0] for r in spark.read.text(rej).collect()] == ["PROBLEM WITH: Quercus,2,3"]


def test_cli_profile_by_group(spark, tmp_dir):
    out = os.path.join(tmp_dir, "byp")
    assert main(["profile", "--input", f"{SF}/documents.parquet", "--out", out,
                 "--fields", "lang", "--by", "source"]) == 0
    assert set(spark.read.parquet(out).columns) == {"source", "field", "value", "count"}


def test_cli_profile_parquet(spark, tmp_dir):
    out = os.path.join(tmp_dir, "pq")
    assert main(["profile", "--input", f"{SF}/customer.parquet", "--out", out,
                 "--fields", "c_mktsegment", "--out-format", "parquet"]) == 0
    assert os.listdir(out).count("field=c_mktsegment") == 1


def test_cli_xref_and_cumulate(spark, tmp_dir):
    xo = os.path.join(tmp_dir, "xref")
    assert main(["xref", "--input", f"{SF}/documents.parquet", "--out", xo,
                 "--uuid", "doc_id", "--ident", "doc_id", "--text", "text"]) == 0
    assert set(spark.read.parquet(xo).columns) >= {"record_uuid", "token", "note", "catalognumber_len"}
    co = os.path.join(tmp_dir, "cum")
    assert main(["cumulate", "--input", f"{SF}/lineitem.parquet", "--out", co, "--fields", "l_shipdate"]) == 0
    assert spark.read.parquet(co).where("field = 'l_shipdate'").count() > 0
