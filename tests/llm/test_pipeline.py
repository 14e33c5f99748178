import corpus_pipeline as cp
import pytest

import __spark_entry__ as entry
from valuescope.llm import mixing, queries, simhash, substring, toxicity

from .helpers import awkward

SF = "/root/testdata/sf0.001"


def _keys(df):
    return sorted((r["doc_id"], r["text"]) for r in df.collect())


def test_every_operator_and_the_pipeline_are_registered():
    names = set(entry.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert set(entry.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_return_a_row_for_every_row_of_their_table(spark, name):
    got = queries.QUERIES[name](spark, SF)
    if name.startswith(("op1_", "op9_", "op12_")):  # rows of their own
        assert got.count() > 0
        return
    table, key = ("pages", "page_id") if name.startswith("op10_") else ("documents", "doc_id")
    given = spark.read.parquet(f"{SF}/{table}.parquet")
    assert sorted(r[0] for r in got.select(key).collect()) == sorted(r[0] for r in given.select(key).collect())


def test_stages_equal_the_operators_step_by_step(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{k}")
        held.append((before, docs))
        if k < len(cp.STAGES) - 1:
            assert docs.columns == before.columns
    toxic = {r["doc_id"] for r in toxicity.score(held[0][0], labels).where("predicted = 1").collect()}
    assert _keys(held[0][1]) == [x for x in _keys(held[0][0]) if x[0] not in toxic]
    groups = simhash.near_duplicates(held[1][0]).collect()
    assert {k for k, _ in _keys(held[1][1])} == {r["component_id"] for r in groups} and held[1][1].count() == len(
        {r["component_id"] for r in groups})
    assert _keys(held[2][1]) == _keys(substring.dedup(held[2][0]))
    assert all(r["n_chars"] == len(r["text"]) for r in held[2][1].collect())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(held[3][0]).collect()}
    assert [k for k, _ in _keys(held[3][1])] == sorted(k for k, n in copies.items() for _ in range(n))
    assert docs.where("not lossless").count() == 0 and docs.count() == held[3][1].count()
    assert sorted(map(str, cp.run(spark, SF).collect())) == sorted(map(str, docs.collect()))


def test_stages_take_awkward_rows(spark, tmp_path):
    docs = awkward(spark)
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert docs.count() > 0
    for _, stage in cp.STAGES:
        assert stage(spark, awkward(spark).limit(0), SF).count() == 0
