"""Distributed ordinals and frequency curves."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from valuescope.operators import ordered


def test_cumulation_fixture(spark):
    prof = spark.createDataFrame(
        [("f", "a", 1), ("f", "b", 1), ("f", "c", 2), ("f", "d", 4), ("f", "", 9), ("f", None, 3)],
        "field string, value string, count bigint")
    rows = ordered.cumulate(prof).orderBy("x").collect()
    assert [r["value"] for r in rows] == ["a", "b", "c", "d"]
    assert [r["cum_count"] for r in rows] == [1, 2, 4, 8]
    assert [r["cum_perc_pop"] for r in rows] == [12.5, 25.0, 50.0, 100.0]
    assert [r["x"] for r in rows] == [0, 1, 2, 3]
    assert [r["x_perc"] for r in rows] == [0.0, 25.0, 50.0, 75.0]


def test_field_without_values_has_no_curve(spark):
    prof = spark.createDataFrame([("f", "", 5), ("g", "x", 2)], "field string, value string, count bigint")
    assert {r["field"] for r in ordered.cumulate(prof).collect()} == {"g"}


def test_sorted_index_equals_row_number_with_a_hot_group(spark):
    # One group holds a third of the rows; it must spread over several range partitions.
    df = spark.range(0, 30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50).alias("g"),
        ((F.col("id") * 7919) % 1000).alias("v"), F.col("id"))
    got = ordered.sorted_index(df, ["v", "id"], ["g"], index_col="i", num_partitions=16)
    w = Window.partitionBy("g").orderBy("v", "id")
    want = df.withColumn("i", F.row_number().over(w) - 1)
    assert got.select("g", "v", "id", "i").exceptAll(want.select("g", "v", "id", "i")).count() == 0
    hot_parts = (got.where(F.col("g") == 0).select(F.spark_partition_id().alias("p")).distinct().count())
    assert hot_parts > 1


def test_sorted_index_ties_get_distinct_positions(spark):
    df = spark.createDataFrame([(1, 5)] * 7 + [(1, 3)] * 2, "g int, v int")
    got = ordered.sorted_index(df, ["v"], ["g"], index_col="i", num_partitions=4)
    assert sorted(r["i"] for r in got.collect()) == list(range(9))
    assert sorted(r["i"] for r in got.where("v = 3").collect()) == [0, 1]


def test_last_cum_equals_total_and_x_is_dense(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    from valuescope.operators import profile
    prof = profile.value_profile(li, ["l_partkey", "l_shipdate"])
    cur = ordered.cumulate(prof)
    agg = cur.groupBy("field").agg(F.max("cum_count").alias("last"), F.max("x").alias("mx"),
                                   F.count("*").alias("n"), F.max("cum_perc_pop").alias("p"))
    totals = {r["field"]: r["s"] for r in prof.groupBy("field").agg(F.sum("count").alias("s")).collect()}
    for r in agg.collect():
        assert r["last"] == totals[r["field"]] and r["mx"] == r["n"] - 1 and r["p"] == 100.0


def test_head_coverage_exact(spark):
    # counts 10, 5, 5, 1 -> total 21; 50 % = 11 records -> 2 values (10 + 5)
    prof = spark.createDataFrame([("f", "a", 10), ("f", "b", 5), ("f", "c", 5), ("f", "d", 1)],
                                 "field string, value string, count bigint")
    rows = {r["percent"]: r["values_needed"] for r in ordered.head_coverage(prof, [50.0, 100.0]).collect()}
    assert rows == {50.0: 2, 100.0: 4}


def test_compare_pairs_by_x(spark):
    raw = spark.createDataFrame([("f", "A", 1), ("f", "a", 2), ("g", "z", 1)], "field string, value string, count bigint")
    clean = spark.createDataFrame([("f", "a", 3)], "field string, value string, count bigint")
    rows = ordered.compare_profiles(clean, raw).orderBy("x").collect()
    assert [(r["x"], r["clean_cum_count"], r["raw_cum_count"]) for r in rows] == [(0, 3, 1), (1, None, 3)]
