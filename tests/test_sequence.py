"""Number-sequence study on the literal fixture."""

import pandas as pd
from pyspark.sql import functions as F

from valuescope.operators import sequence


def _numbers(spark):
    df = spark.createDataFrame([("r", v) for v in ["1", "2", "2", "3", "7", "8", "x"]],
                               "recordset string, catalognumber string")
    return sequence.with_numbers(df, "catalognumber", "recordset")


def test_bad_rank_repeats_gaps(spark):
    nums = _numbers(spark)
    bad = sequence.bad_counts(nums).first()
    assert (bad["n"], bad["n_bad"], bad["n_zero_text"]) == (7, 1, 0)
    ranked = sequence.rank_numbers(nums, num_partitions=3)
    assert [(r["rank"], r["number"]) for r in ranked.orderBy("rank").collect()] == \
        [(0, 0), (1, 1), (2, 2), (3, 2), (4, 3), (5, 7), (6, 8)]
    assert [(r["number"], r["count"]) for r in sequence.repeats(nums).collect()] == [(2, 2)]
    gaps = sorted((r["number"], r["next_number"]) for r in sequence.gaps(ranked).collect())
    assert gaps == [(3, 7)]
    assert [r["number"] for r in sequence.tail(ranked, 2).orderBy("rank").collect()] == [7, 8]
    assert [r["rank"] for r in sequence.rank_slice(ranked, 0, None, drop_last=3).orderBy("rank").collect()] == [0, 1, 2, 3]


def test_describe_matches_pandas(spark):
    nums = _numbers(spark)
    d = sequence.describe(sequence.rank_numbers(nums)).first()
    want = pd.Series([0, 1, 2, 2, 3, 7, 8]).describe()
    assert d["count"] == want["count"]
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"),
                         ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert abs(float(d[ours]) - float(want[theirs])) < 1e-12, ours


def test_zoom_window(spark):
    ranked = sequence.rank_numbers(_numbers(spark))
    z = sequence.zoom(ranked, 1, 5, 2, 3).orderBy("rank").collect()
    assert [(r["rank"], r["number"]) for r in z] == [(2, 2), (3, 2), (4, 3)]


def test_or_predicate_string(spark):
    df = spark.createDataFrame([("r-70049",), ("70049",), ("1",)], "catalognumber string")
    from valuescope.operators.subset import predicate_subset
    got = predicate_subset(df, "catalognumber='r-70049' OR catalognumber='70049'").count()
    assert got == 2
    assert df.where(F.col("catalognumber") == "0").count() == 0


def test_describe_single_row_group(spark):
    df = spark.createDataFrame([("solo", "5"), ("pair", "1"), ("pair", "4")], "g string, c string")
    nums = sequence.with_numbers(df, "c", "g")
    rows = {r["grp"]: r for r in sequence.describe(sequence.rank_numbers(nums)).collect()}
    assert rows["solo"]["std"] is None and rows["solo"]["p50"] == 5.0 and rows["solo"]["count"] == 1
    assert rows["pair"]["p25"] == 1.75 and abs(rows["pair"]["std"] - 2.1213203435596424) < 1e-12
