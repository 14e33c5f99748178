"""Value profiles and cardinality."""

import re

from pyspark.sql import functions as F

from valuescope.operators import profile


def test_null_blank_value_are_three_groups(spark):
    df = spark.createDataFrame([(None,), ("",), ("x",)], "f string")
    p = profile.value_profile(df)
    got = sorted((r["value"] is None, r["value"], r["count"]) for r in p.collect())
    assert got == [(False, "", 1), (False, "x", 1), (True, None, 1)]
    assert profile.cardinality(p).first()["card"] == 3


def test_one_pass_equals_per_field_loop(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    one = profile.value_profile(li)
    loop = None
    for f in li.columns:
        part = profile.value_counts(li, f).select(F.lit(f).alias("field"),
                                                  F.col("value").cast("string").alias("value"), "count")
        loop = part if loop is None else loop.unionByName(part)
    assert one.exceptAll(loop).count() == 0 and loop.exceptAll(one).count() == 0


def test_counts_sum_to_rows(spark):
    cust = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    n = cust.count()
    sums = profile.value_profile(cust).groupBy("field").agg(F.sum("count").alias("s")).collect()
    assert len(sums) == len(cust.columns) and all(r["s"] == n for r in sums)


def test_nested_leaves_are_profiled_and_pruned(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_type", F.struct(F.col("user_id").alias("u"), F.col("value").alias("v")).alias("data"))
    assert profile.field_list(ev, nested=True) == ["event_type", "data.u", "data.v"]
    assert profile.field_list(ev) == ["event_type"]
    p = profile.value_profile(ev, ["data.u"])
    assert {r["field"] for r in p.collect()} == {"data.u"}


def test_cardinality_trim_is_strict(spark):
    cards = {"a": 100, "b": 101, "c": 950, "d": 951, "e": 1000}
    rows = [(f, str(i), 1) for f, n in cards.items() for i in range(n)]
    prof = spark.createDataFrame(rows, "field string, value string, count bigint")
    rep = profile.cardinality_report(prof).collect()
    assert [(r["field"], r["card"], r["x"]) for r in rep] == [("b", 101, 0)]


def test_value_counts_sql_form(spark):
    spark.createDataFrame([("a",), ("a",), (None,)], "country string").createOrReplaceTempView("t_vc")
    got = {(r["value"], r["count"]) for r in profile.value_counts_sql(spark, "t_vc", "country").collect()}
    assert got == {("a", 2), (None, 1)}


def test_cardinality_estimate_close_to_exact(spark):
    li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    exact = {r["field"]: r["card"] for r in profile.cardinality(profile.value_profile(li)).collect()}
    est = {r["field"]: r["card"] for r in profile.cardinality_estimate(li, rsd=0.01).collect()}
    assert set(est) == set(exact)
    for f, n in exact.items():
        assert abs(est[f] - n) <= max(2, 0.05 * n), (f, est[f], n)
    with_null = spark.createDataFrame([(None,), ("a",), ("b",)], "x string")
    assert profile.cardinality_estimate(with_null).first()["card"] == 3


def test_wide_profile_uses_generator_and_equals_narrow_passes(spark):
    from valuescope.operators.profile import WIDE_FIELDS
    base = spark.range(0, 3000, 1, 4)
    cols = [((F.col("id") * (i + 7)) % (i + 3)).cast("string").alias(f"dwc:f{i}") for i in range(WIDE_FIELDS + 30)]
    wide = base.select(*cols)
    grouped = profile.value_profile(wide)
    parts = [profile.value_profile(wide, wide.columns[i:i + 40]) for i in range(0, len(wide.columns), 40)]
    narrow = parts[0]
    for p in parts[1:]:
        narrow = narrow.unionByName(p)
    assert grouped.exceptAll(narrow).count() == 0 and narrow.exceptAll(grouped).count() == 0
    plan = grouped._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "Expand" not in plan


def test_complex_and_typed_values_profile_as_text(spark):
    df = spark.createDataFrame(
        [({"a": 1}, [1, 2], True, 1.5, {"x": {"y": 1}}), ({"a": 1}, [2], None, None, {"x": {"y": 2}})],
        "m map<string,int>, arr array<int>, b boolean, d double, s struct<x: struct<y: int>>")
    p = profile.value_profile(df, nested=True)
    got = {(r["field"], r["value"], r["count"]) for r in p.collect()}
    assert ("m", "{a -> 1}", 2) in got and ("arr", "[1, 2]", 1) in got
    assert ("b", "true", 1) in got and ("b", None, 1) in got and ("d", "1.5", 1) in got
    assert ("s.x", "{1}", 1) in got  # a deeper struct stays whole


def test_profile_by_group_equals_filtered_profiles(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    grouped = profile.value_profile(docs, ["lang"], by=["source"])
    for src in [r[0] for r in docs.select("source").distinct().limit(3).collect()]:
        one = profile.value_profile(docs.where(F.col("source") == src), ["lang"])
        mine = grouped.where(F.col("source") == src).drop("source")
        assert one.exceptAll(mine).count() == 0 and mine.exceptAll(one).count() == 0


def test_value_leads_the_counted_key(spark):
    """Full maps of counts are sorted by the first bytes of the key, which a field's name is not."""
    for n in (3, profile.WIDE_FIELDS + 2):
        df = spark.range(40).select(*[(F.col("id") % (i + 2)).alias(f"f.{i}") for i in range(n)])
        p = profile.value_profile(df)
        keys = re.findall(r"HashAggregate\(keys=\[(.*?)\]", p._jdf.queryExecution().executedPlan().toString())
        assert keys and all(k.startswith("value#") for k in keys)
        assert p.columns == ["field", "value", "count"]
        rows = p.collect()
        assert len(rows) == sum(min(i + 2, 40) for i in range(n))
        assert {f: sum(r["count"] for r in rows if r["field"] == f) for f in df.columns} == dict.fromkeys(df.columns, 40)
