"""Exact-size subsets against a plain sort."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from valuescope import jobs
from valuescope.operators import selection, subset


def _first(rows, n, *keys):
    """The n least key tuples, nulls first."""
    order = lambda r: tuple((r[k] is not None, r[k].encode() if isinstance(r[k], str) else r[k] or 0) for k in keys)
    return [order(r) for r in sorted(rows, key=order)[:n]], order


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(4)
    texts = [None, "", "a", "a\x00", "ab", "abcdefg", "abcdefgh", "abcdefg\x00", "é", "\U0001F600", "z" * 30, "z" * 29 + "y"]
    rows = [(rng.choice([None, 1, 1, 1, -(1 << 63), (1 << 63) - 1, rng.randrange(-50, 50)]), rng.choice(texts),
             rng.choice([None, 0.5, -1.5, float(rng.randrange(9))]), rng.random() < 0.5, i) for i in range(400)]
    df = spark.createDataFrame(rows, "a long, t string, d double, b boolean, i int")
    return df.withColumn("day", F.date_add(F.lit("1999-12-30").cast("date"), F.pmod("i", F.lit(9)).cast("int"))).withColumn(
        "at", F.timestamp_micros(F.col("i").cast("long") % 7 * 1_000_003 - 5)).withColumn(
        "ntz", F.col("at").cast("timestamp_ntz"))


@pytest.mark.parametrize("keys", [("a",), ("t",), ("d",), ("b", "t"), ("day", "a", "t"), ("at", "i"), ("ntz", "i")])
@pytest.mark.parametrize("n", [1, 57, 399])
def test_first_rows_equal_a_sort(mixed, keys, n):
    got = selection.first_rows(mixed, n, *keys).collect()
    expected, order = _first(mixed.collect(), n, *keys)
    assert sorted(map(order, got)) == expected
    assert len({r["i"] for r in got}) == n


def test_more_than_all_none_and_empty(mixed, spark):
    assert selection.first_rows(mixed, 400, "a").count() == 400
    assert selection.first_rows(mixed, 5000, "a").count() == 400
    assert selection.first_rows(mixed, 0, "a").count() == 0
    assert selection.exact_sample(mixed.limit(0), 5, "i").count() == 0


def test_repeated_rows_are_counted(spark, tmp_dir):
    spark.createDataFrame([(7, "same")] * 300 + [(8, "other")] * 10, "k long, v string").repartition(5).write.parquet(tmp_dir + "/r")
    df = spark.read.parquet(tmp_dir + "/r")
    for n in (1, 123, 305):
        assert selection.exact_sample(df, n, "k").count() == n
        assert selection.first_rows(df, n, "v", "k").count() == n
    again = [sorted(map(tuple, selection.exact_sample(df, 305, "k").collect())) for _ in range(2)]
    assert again[0] == again[1]


def test_sample_is_that_of_the_least_hashes(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    h = lambda k: (int(hashlib.md5(f"42:{k}".encode()).hexdigest()[:15], 16), k)
    order = sorted(range(5000), key=h)
    for n in (100, 2500):
        assert {r[0] for r in selection.exact_sample(df, n, "k").collect()} == set(order[:n])
    other = {r[0] for r in selection.exact_sample(df, 100, "k", seed=1).collect()}
    assert other != set(order[:100])


def test_no_sort_or_shuffle_of_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (selection.exact_sample(docs, 50, "doc_id"), selection.first_rows(docs, 50, "text")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrdered" not in plan and "Sort" not in plan and "Exchange" not in plan


def test_histograms_stay_small(spark, monkeypatch):
    monkeypatch.setattr(selection, "BUCKETS", 3)
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    assert sorted(r[0] for r in selection.first_rows(df, 10, "k").collect()) == list(range(10))


def test_job_takes_exact_sizes(spark):
    df = spark.range(1000).select("id", (F.col("id") % 3).alias("g"))
    assert jobs.make_subset(df, n=70, where=["g = 1"], order_by=["id"]).count() == 70
    assert jobs.make_subset(df, size=70, key="id").count() == 70
    assert subset.ordered_subset(df, 5, "id").count() == 5
