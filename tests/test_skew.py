"""Hot-key join and size-checked broadcast."""

from pyspark.sql import functions as F

from valuescope.plans.skew import bounded_broadcast, hot_keys, salted_join


def test_salted_join_equals_plain_join(spark):
    # Key "1" holds a third of the right side.
    right = spark.range(0, 3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 97).cast("string")).alias("token"),
        F.col("id").alias("rid"))
    left = spark.range(0, 200).select((F.col("id") % 20).cast("string").alias("key"), F.col("id").alias("lid"))
    got = salted_join(left, right, "key", "token", salts=8, share=0.05, min_rows=10)
    want = left.join(right, left["key"] == right["token"])
    cols = ["key", "lid", "token", "rid"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0
    assert [r["token"] for r in hot_keys(right, "token", 0.05, 10).collect()] == ["1"]


def test_bounded_broadcast_respects_bound(spark):
    small = spark.range(10)
    big = bounded_broadcast(spark.range(100), max_bytes=50)
    plan = spark.range(1000).join(bounded_broadcast(small), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan
    assert big.count() == 100


def test_hot_key_rows_spread_over_tasks(spark):
    right = spark.range(0, 6000).select(
        F.when(F.col("id") % 3 == 0, F.lit("1")).otherwise((F.col("id") % 97).cast("string")).alias("token"),
        F.col("id").alias("rid"))
    left = spark.createDataFrame([("1", 0)], "key string, lid long")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = salted_join(left, right, "key", "token", salts=8, share=0.05, min_rows=10)
        tasks = joined.select(F.spark_partition_id().alias("p")).distinct().count()
        plain = left.join(right, left["key"] == right["token"]).count()
        assert joined.count() == plain and tasks > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_bounded_broadcast_counts_bytes_not_rows(spark):
    long = spark.range(300).select("id", F.repeat(F.sha2(F.col("id").cast("string"), 256), 50).alias("s"))
    assert "ResolvedHint" not in bounded_broadcast(long, max_bytes=10_000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" in bounded_broadcast(long.select("id"), max_bytes=10_000)._jdf.queryExecution().analyzed().toString()
    assert bounded_broadcast(long, max_bytes=10_000).count() == 300


def test_salted_join_spreads_identical_rows(spark):
    right = spark.range(0, 3000, 1, 2).select(F.lit("1").alias("token"), F.lit(7).alias("v"))  # all copies
    left = spark.createDataFrame([("1", 0)], "key string, lid long")
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = salted_join(left, right, "key", "token", salts=8, share=0.05, min_rows=10)
        assert got.count() == 3000
        assert got.select(F.spark_partition_id().alias("p")).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_frequent_tokens_of_a_known_hash_bit_are_not_shuffled(spark):
    # A very frequent token that is no identifier but has the hash bit of one.
    from valuescope.operators import xref
    ids = spark.range(3000).select(F.col("id").alias("record_uuid"), F.col("id").cast("string").alias("record_identifier"))
    words = spark.range(2000).select(F.concat(F.lit("w"), "id").alias("token"))
    alike = xref.maybe_known(words, "token", ids, "record_identifier").first()["token"]
    tokens = spark.range(20_000).select(F.col("id").alias("uuid"), F.when(F.col("id") % 50 == 0, F.lit("7")).when(
        F.col("id") % 50 == 1, (F.col("id") % 5000).cast("string")).otherwise(F.lit(alike)).alias("token"))
    got = xref.reduced(tokens, ids)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    want = sorted(map(tuple, tokens.where("token in (select cast(id as string) from range(3000))").collect()))
    assert sorted(map(tuple, got.collect())) == want
    # Too many identifiers for a broadcast: the same rows by the salted join.
    assert sorted(map(tuple, xref.reduced(tokens, ids, max_bytes=0).select("uuid", "token").collect())) == want
    notes = spark.range(20_000).select(F.col("id").alias("note_uuid"), F.lit("n").alias("note"))
    hist = xref.id_length_histogram(ids, tokens, notes)
    rows = xref.cross_reference(ids, tokens.withColumn("count", F.lit(1)), notes)
    grouped = {r[0]: r[1] for r in rows.groupBy("catalognumber_len").count().collect()}
    assert {r["catalognumber_len"]: r["count"] for r in hist.collect()} == grouped
    assert sum(grouped.values()) == len(want)
