"""Plan properties: pruning, one shuffle per aggregation, no shuffle after pins."""

import re

from pyspark.sql import functions as F

from valuescope.operators import ordered, profile, tf
from valuescope.plans.parallel import spread

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(plan: str) -> list[str]:
    return [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line
            and "ShuffleQueryStage" not in line and "ReusedExchange" not in line]


def test_tf_index_reads_two_columns_and_shuffles_once(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = _plan(tf.tf_index(docs, "doc_id", ["text"]))
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    assert schemas == ["struct<doc_id:bigint,text:string>"]
    assert "Generate" in plan
    shuffles = _shuffles(plan)
    # The aggregation shuffles on (doc_id, token); a row-id spread may precede it when
    # the input has fewer partitions than cores and is large enough to share out.
    assert 1 <= len(shuffles) <= 2 and "doc_id" in shuffles[0] and "token" in shuffles[0]


def test_value_profile_is_one_expand_and_one_shuffle(spark):
    wide = spark.range(0, 1000, 1, 16).select(
        (F.col("id") % 7).alias("a"), (F.col("id") % 11).cast("string").alias("b"), F.col("id").alias("c"))
    assert spread(wide) is wide  # enough partitions: nothing added
    plan = _plan(profile.value_profile(wide, ["a", "b"]))
    assert plan.count("Expand") == 1
    shuffles = _shuffles(plan)
    assert len(shuffles) == 1 and "field" in shuffles[0] and "value" in shuffles[0]


def test_nested_leaf_is_pruned(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    nested = ev.select(F.struct(F.col("user_id").alias("u"), F.col("value").alias("v")).alias("data"), "event_type")
    plan = _plan(profile.value_profile(nested, ["data.u"]))
    assert "ReadSchema: struct<user_id:bigint>" in plan


def test_cumulate_after_pins_has_no_shuffle(spark):
    prof = spark.createDataFrame([("f", str(i), i % 5 + 1) for i in range(200)],
                                 "field string, value string, count bigint")
    plan = _plan(ordered.cumulate(prof, num_partitions=4))
    assert _shuffles(plan) == []
    assert "BroadcastHashJoin" in plan


def test_filter_pushed_to_scan(spark):
    from valuescope.operators.subset import predicate_subset
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    plan = _plan(predicate_subset(orders, F.col("o_orderstatus") == "F").select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,F)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string>" in plan


def test_spread_balances_copies(spark):
    copies = spark.range(0, 4000, 1, 1).select(F.lit("same").alias("v"))  # one partition, all rows equal
    spread_df = spread(copies, min_partitions=8)
    sizes = [r["n"] for r in spread_df.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == 8 and max(sizes) <= 1.25 * (4000 / 8)  # hashed row ids: every task gets a share
