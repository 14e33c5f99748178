"""Streaming counts equal batch counts."""

from valuescope.operators import profile, tf
from valuescope.session import scratch_path
from valuescope.streaming.profile_stream import stream_tf_index, stream_value_profile

SRC = "/root/testdata/sf0.001"


def test_stream_profile_equals_batch(spark):
    docs = spark.read.parquet(f"{SRC}/documents.parquet")
    got = stream_value_profile(spark, f"{SRC}/documents.parque[t]", docs.schema, ["lang", "source"],
                               scratch_path(spark, "t-sp"), checkpoint=scratch_path(spark, "t-spc"))
    want = profile.value_profile(docs, ["lang", "source"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_tf_equals_batch(spark):
    docs = spark.read.parquet(f"{SRC}/documents.parquet")
    got = stream_tf_index(spark, f"{SRC}/documents.parque[t]", docs.schema, "doc_id", ["text"],
                          scratch_path(spark, "t-tf"), checkpoint=scratch_path(spark, "t-tfc"))
    want = tf.tf_index(docs, "doc_id", ["text"])
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_stream_profile_is_incremental(spark, tmp_dir):
    import os
    src = os.path.join(tmp_dir, "in")
    docs = spark.read.parquet(f"{SRC}/documents.parquet").select("doc_id", "lang", "source")
    docs.where("doc_id % 2 = 0").coalesce(1).write.parquet(os.path.join(src, "part=a"))
    out, ckpt = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt")
    first = stream_value_profile(spark, src + "/*", docs.schema, ["lang"], out, checkpoint=ckpt)
    assert first.agg({"count": "sum"}).first()[0] == docs.where("doc_id % 2 = 0").count()
    docs.where("doc_id % 2 = 1").coalesce(1).write.parquet(os.path.join(src, "part=b"))
    second = stream_value_profile(spark, src + "/*", docs.schema, ["lang"], out, checkpoint=ckpt)
    want = profile.value_profile(docs, ["lang"])
    assert second.exceptAll(want).count() == 0 and want.exceptAll(second).count() == 0


def test_streams_keep_apart_and_go_on_without_a_given_checkpoint(spark, tmp_dir):
    import os
    outs = {}
    for name in ("customer", "part"):
        src = os.path.join(tmp_dir, name)
        table = spark.read.parquet(f"{SRC}/{name}.parquet")
        table.coalesce(1).write.parquet(os.path.join(src, "part=a"))
        outs[name] = (src, table, os.path.join(tmp_dir, name + "-out"))
    for src, table, out in outs.values():
        got = stream_value_profile(spark, src + "/*", table.schema, table.columns[:1], out)
        assert got.agg({"count": "sum"}).first()[0] == table.count()
    src, table, out = outs["part"]
    again = stream_value_profile(spark, src + "/*", table.schema, table.columns[:1], out)   # nothing new
    assert again.agg({"count": "sum"}).first()[0] == table.count()
    table.coalesce(1).write.parquet(os.path.join(src, "part=b"))
    more = stream_value_profile(spark, src + "/*", table.schema, table.columns[:1], out)
    assert more.agg({"count": "sum"}).first()[0] == 2 * table.count()
