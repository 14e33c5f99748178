"""Quoted records over line ends and file splits, against Python's csv reader."""

import csv
import io
import os
import random

import pytest

from valuescope.operators import profile
from valuescope.sources import csvtext, quoted


def _write(folder, files):
    os.makedirs(folder, exist_ok=True)
    for name, text in files.items():
        with open(os.path.join(folder, name), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return folder


def _random_rows(rng, n):
    pieces = ["", "a", "é", "line\nend", "\n", '"', '""', ",", "two\n\nlines", 'he said "x,\ny"', " sp ", "x" * 30]
    return [["".join(rng.choice(pieces) for _ in range(rng.randrange(3))) or "v" for _ in range(3)] for _ in range(n)]


def _csv(rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows(rows)
    return out.getvalue()


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], "64")
    spark.conf.set(names[1], "1")
    yield
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_cut_like_the_csv_reader(spark, tmp_dir, small_splits, end):
    rng = random.Random(1)
    rows = [_random_rows(rng, 60) for _ in range(3)]
    # A record over many splits.
    rows[1].insert(20, ["a", "long\n" * 100 + '"', "z"])
    head = ["c1", "c2", "c3"]
    folder = _write(tmp_dir + "/csv", {f"part{i}.csv": _csv([head, *r], end) for i, r in enumerate(rows)})
    assert quoted._lines(spark, folder).select("file", "block").distinct().count() > 20
    got = quoted.read_csv_quoted(spark, folder)
    assert got.header == head and got.rejects.count() == 0
    expected = sorted(tuple(x) for r in rows for x in r)
    assert sorted(tuple(r) for r in got.good.collect()) == expected
    strict = quoted.read_csv_quoted(spark, folder, strict=True)
    assert sorted(tuple(r) for r in strict.good.collect()) == expected


def test_unclosed_quotes_are_rejects(spark, tmp_dir, small_splits):
    text = 'a,b\n1,"x\ny"\n2,"never closed\n' + "more text of it\n" * 20 + "end"
    folder = _write(tmp_dir + "/csv", {"one.csv": text, "two.csv": "a,b\n3,z\n"})
    got = quoted.read_csv_quoted(spark, folder)
    assert sorted(map(tuple, got.good.collect())) == [("1", "x\ny"), ("3", "z")]
    lost = [r["value"] for r in got.rejects.collect()]
    assert len(lost) == 22 and 'PROBLEM WITH: 2,"never closed' in lost and "PROBLEM WITH: end" in lost
    with pytest.raises(ValueError):
        quoted.read_csv_quoted(spark, folder, strict=True)


def test_too_many_values_and_empty_files(spark, tmp_dir):
    folder = _write(tmp_dir + "/csv", {"a.csv": 'a,b\n1,2\n"x\ny",2,3\n', "b.csv": "", "c.csv": "a,b\n"})
    got = quoted.read_csv_quoted(spark, folder)
    assert sorted(map(tuple, got.good.collect())) == [("", ""), ("1", "2")]
    assert [r["value"] for r in got.rejects.collect()] == ['PROBLEM WITH: "x\ny",2,3']


def test_shuffle_join_of_the_states(spark, tmp_dir, small_splits, monkeypatch):
    monkeypatch.setattr(quoted, "MAX_BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = _random_rows(random.Random(5), 80)
        folder = _write(tmp_dir + "/csv", {"a.csv": _csv([["x", "y", "z"], *rows])})
        got = quoted.read_csv_quoted(spark, folder).good
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_profile_of_texts_with_line_ends(spark, tmp_dir, small_splits):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    folder = tmp_dir + "/docs"
    csvtext.to_csv_lines(docs, header=True).coalesce(1).write.text(folder)
    got = profile.value_profile(quoted.read_csv_quoted(spark, folder, strict=True).good)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, profile.value_profile(docs).collect()))
