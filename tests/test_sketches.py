"""Sketches, heavy values and the identifier bitmap against exact counts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from valuescope.operators import profile, sketches, tf, xref


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    made = [(rng.choice("abc"), i % 4, rng.randrange(900) if rng.random() < 0.9 else None,
             "hot" if rng.random() < 0.3 else f"v{rng.randrange(5000)}") for i in range(12_000)]
    return spark.createDataFrame(made, "source string, epoch int, number int, value string")


def test_merged_sketches_equal_the_sketch_of_all(rows, spark, tmp_dir):
    sketches.field_sketches(rows, by=["source", "epoch"]).write.parquet(tmp_dir + "/s")
    stored = spark.read.parquet(tmp_dir + "/s")
    assert stored.select("source", "epoch").distinct().count() == 12
    merged = {r["field"]: r["card"] for r in sketches.sketched_cardinality(sketches.merge_sketches(stored)).collect()}
    exact = {r["field"]: r["card"] for r in profile.cardinality(profile.value_profile(rows, ["number", "value"])).collect()}
    assert set(merged) == {"number", "value"}
    for field, card in exact.items():
        assert abs(merged[field] - card) <= 0.05 * card
    by_source = sketches.sketched_cardinality(sketches.merge_sketches(stored, ["source"]), ["source"]).collect()
    assert len(by_source) == 6


@pytest.mark.parametrize("share", [0.0005, 0.01, 0.25])
def test_heavy_values_are_exact(rows, share, monkeypatch):
    monkeypatch.setattr(sketches, "BUCKETS_A_SHARE", 2)
    made = rows.collect()
    expected = set()
    for field in ("source", "number", "value"):
        count = Counter(r[field] for r in made)
        expected |= {(field, None if v is None else str(v), n, len(made)) for v, n in count.items() if n > share * len(made)}
    got = sketches.heavy_values(rows, share, ["source", "number", "value"])
    assert {tuple(r) for r in got.collect()} == expected


def test_kept_summaries_give_the_same(rows):
    values = rows.select(F.lit("value").alias("field"), "value", "epoch")
    kept = [sketches.value_buckets(values.where(F.col("epoch") == e), sketches.bucket_count(0.01)) for e in range(4)]
    summary = kept[0].unionByName(kept[1]).unionByName(kept[2]).unionByName(kept[3])
    whole = values.drop("epoch")
    assert set(map(tuple, sketches.heavy_of(whole, 0.01, summary).collect())) == set(
        map(tuple, sketches.heavy_of(whole, 0.01).collect()))


def test_bitmap_keeps_every_known_key(spark):
    ids = spark.createDataFrame([(f"id{i}",) for i in range(3000)] + [(None,)], "k string")
    rows = spark.createDataFrame([(f"id{i}", i) for i in range(6000)] + [(f"other{i}", i) for i in range(20_000)], "t string, i int")
    kept = {r["t"] for r in xref.maybe_known(rows, "t", ids, "k").collect()}
    assert {f"id{i}" for i in range(3000)} <= kept
    assert len(kept) < 3000 + 23_000 // 5
    assert xref.maybe_known(rows, "t", ids.limit(0), "k").count() == 0
    assert xref.maybe_known(rows, "t", ids, "k", max_bytes=10).count() == rows.count()


def test_bitmap_needs_no_shuffle_of_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    ids = xref.identifier_view(docs, "doc_id", "doc_id")
    tokens = tf.tokens(docs, "doc_id", ["text"], tokenizer="words")
    kept = xref.maybe_known(tokens, "token", ids, "record_identifier")
    assert kept.count() < tokens.count() / 10
    exact = tokens.join(ids, F.col("token") == F.col("record_identifier"), "left_semi")
    assert sorted(map(tuple, xref.reduced(tokens, ids).collect())) == sorted(map(tuple, exact.collect()))
