"""CSV text path: repeated headers, rejects, empty values, line-based records."""

import os

import pytest

from valuescope.sources import csvtext

CSV_TEXT = "\n".join([
    'id,"a",b',
    '1,"he said ""hi""",',
    "2,x",
    "3,a,b,c",
    '4,"",z',
    'id,"a",b',
    '5,"multi',
    'line",q',
    '6,a\\"b,q',
]) + "\n"


@pytest.fixture()
def csv_file(tmp_dir):
    path = os.path.join(tmp_dir, "occurrence.csv")
    with open(path, "w") as f:
        f.write(CSV_TEXT)
    return path


def test_tolerant_parse(spark, csv_file, tmp_dir):
    parsed = csvtext.read_csv_records(spark, csv_file)
    assert parsed.header == ["id", "a", "b"]
    rows = [tuple(r) for r in parsed.good.collect()]
    assert len(rows) == 7  # header twice removed; the quoted two-line value is two records
    assert ("1", 'he said "hi"', "") in rows
    assert ("2", "x", "") in rows
    assert ("", "", "") in rows            # the reject keeps a blank record
    assert ("4", "", "z") in rows
    assert ("6", 'a\\"b', "q") in rows
    assert all(v is not None for r in rows for v in r)
    rejects = [r["value"] for r in parsed.rejects.collect()]
    assert rejects == ["PROBLEM WITH: 3,a,b,c"]
    from valuescope.sinks import write_rejects
    out = os.path.join(tmp_dir, "rejects")
    write_rejects(parsed.rejects, out)
    assert spark.read.text(out).count() == 1


def test_value_count_matches_python_csv(spark):
    import csv
    import io
    samples = ['a,b', '"a,b",c', '"x""y",z,', '', ',', '"q', 'a,"b,"c",d', '"",""']
    df = spark.createDataFrame([(s,) for s in samples], "value string")
    got = [r[0] for r in df.select(csvtext.value_count(df["value"])).collect()]
    want = [len(next(csv.reader(io.StringIO(s)), [""])) or 1 for s in samples]
    assert got == want


def test_strict_parse_fails_on_bad_rows(spark, csv_file):
    parsed = csvtext.read_csv_records(spark, csv_file, strict=True)
    with pytest.raises(Exception):
        parsed.good.collect()


def test_naive_pick(spark, csv_file):
    from pyspark.sql import functions as F
    lines = csvtext.read_lines(spark, csv_file)
    picked = [r[0] for r in lines.select(csvtext.naive_pick(F.col("value"), 2)).collect()]
    assert picked[0] == "b" and picked[2] is None and picked[3] == "b"


def test_roundtrip_lines(spark):
    df = spark.createDataFrame([(1, 'x,"y"'), (2, None)], "k int, s string")
    lines = csvtext.to_csv_lines(df)
    parsed = csvtext.parse_lines(lines)
    assert sorted(tuple(r) for r in parsed.good.collect()) == [("1", 'x,"y"'), ("2", "")]


def test_header_from_first_file_by_name(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "parts")
    os.makedirs(folder)
    with open(os.path.join(folder, "part-0.csv"), "w") as f:
        f.write("")                                   # empty part file
    with open(os.path.join(folder, "part-1.csv"), "w") as f:
        f.write("k,v\n1,a\n")                         # small file with the header
    with open(os.path.join(folder, "part-2.csv"), "w") as f:
        f.write("k,v\n" + "".join(f"{i},b\n" for i in range(2, 2000)))  # bigger, repeated header
    parsed = csvtext.read_csv_records(spark, folder)
    assert parsed.header == ["k", "v"]
    assert parsed.good.count() == 1999
    assert parsed.good.where("k = 'k'").count() == 0
