import random
import re

import pytest
from pyspark.sql import functions as F

from valuescope.llm import mixing

from .helpers import awkward, documents, empty


def _targets(sizes):
    """Water filling over {source: size}, sources by code point, null last."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, full = 1.5 * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        if not open_ or not total:
            return {s: 2.0 * sizes[s] if s in full else 0.0 for s in names}
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not above:
            return {s: 2.0 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= above


def _check(rows, got):
    size = {}
    for r in rows:
        size[r["source"]] = size.get(r["source"], 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    wanted = _targets(size)
    taken = {}
    for r in got:
        assert r["source_size"] == size[r["source"]] and r["target"] == pytest.approx(wanted[r["source"]])
        assert r["copies"] in (0, 1, 2) and r["taken"] == r["copies"] * r["size"]
        rate = r["target"] / r["source_size"] if r["source_size"] else 0
        assert not r["size"] or int(rate) <= r["copies"] <= -(-rate // 1)
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    return wanted, taken


def test_targets_and_taken_words(spark):
    rows = documents(spark, "/root/testdata/sf0.01")
    got = mixing.mix(rows).collect()
    assert len(got) == rows.count()
    wanted, taken = _check(rows.collect(), got)
    longest = max(r["size"] for r in got)
    assert all(abs(taken[s] - wanted[s]) <= longest for s in wanted)
    assert abs(sum(taken.values()) - sum(wanted.values())) < 0.03 * sum(wanted.values())


def test_hot_source_meets_its_target_through_several_levels(spark):
    rng = random.Random(1)
    docs = [(i, "w " * rng.randrange(1, 90), "hot" if i % 3 else f"s{i % 17}") for i in range(6000)]
    rows = spark.createDataFrame(docs, "doc_id long, text string, source string")
    sizes = mixing.sizes(rows)
    plan = mixing.decide(sizes)
    again = mixing.decide(sizes.repartition(7))
    assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, again.collect()))    # reruns agree
    fractions = sizes.distinct().withColumn("_p", F.lit(0.3))
    decided = mixing.round_fractions(fractions, block=8).collect()
    assert len(decided) == 6000
    for source in ("hot", "s0"):
        own = [r for r in decided if r["_s"] == source]
        words, got = sum(r["_z"] for r in own), sum(r["_z"] for r in own if r["_take"])
        assert abs(got - 0.3 * words) < 200 and abs(sum(r["_take"] for r in own) - 0.3 * len(own)) <= 12


def test_every_document_has_its_chance(spark):
    rows = spark.createDataFrame([("s", k, 1 + k % 5, 0.25) for k in range(60)], "_s string, _k long, _z long, _p double")
    taken = {}
    for seed in range(25):
        for r in mixing.round_fractions(rows, block=8, seed=seed).collect():
            taken[r["_k"]] = taken.get(r["_k"], 0) + r["_take"]
    assert sum(taken.values()) / (60 * 25) == pytest.approx(0.25, abs=0.02)
    assert max(taken.values()) <= 16 and sum(v == 0 for v in taken.values()) <= 2


def test_mixed_rows_follow_the_decisions(spark):
    rows = documents(spark)
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(rows).collect()}
    out = mixing.mixed(rows)
    assert out.columns == rows.columns
    count = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert count == {k: c for k, c in copies.items() if c}


def test_awkward_rows(spark):
    rows = awkward(spark)
    got = mixing.mix(rows).collect()
    assert len(got) == rows.count()
    _check(rows.collect(), got)
    assert len({r["copies"] for r in got if r["doc_id"] == 1}) == 1
    assert mixing.mixed(rows).columns == rows.columns
    assert mixing.mixed(rows).count() == sum(r["copies"] for r in got)
    assert mixing.mix(empty(spark)).count() == 0
