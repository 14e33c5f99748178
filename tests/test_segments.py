"""Segments and islands against one-task versions."""

import random

import pytest

from valuescope.operators import segments, sequence


def _curve(rng, n):
    """Nondecreasing numbers with straight stretches of several slopes, jumps and noise."""
    out, at = [], 0
    while len(out) < n:
        slope, jump = rng.choice([0, 1, 1, 1, 2, 7]), rng.choice([0, 0, 50, 1000])
        at += jump
        for _ in range(rng.randrange(1, 90)):
            at += slope + (rng.random() < 0.05)
            out.append(at)
    return out[:n]


def _feasible(points, x0, y0, error):
    low = max(((y - error - y0) / (x - x0) for x, y in points if x > x0), default=-float("inf"))
    high = min(((y + error - y0) / (x - x0) for x, y in points if x > x0), default=float("inf"))
    return low <= high, low, high


def _brute(numbers, error, block, fan):
    """[(first rank, last rank)]: growing by single points within blocks, then joining at
    block borders, level by level, testing every point each time."""
    points = list(enumerate(numbers))
    blocks = []
    for b in range(0, len(points), block):
        cut = []
        for p in points[b:b + block]:
            if cut and _feasible([*cut[-1], p], *cut[-1][0], error)[0]:
                cut[-1].append(p)
            else:
                cut.append([p])
        blocks.append(cut)
    while len(blocks) > 1:
        wider = []
        for k in range(0, len(blocks), fan):
            made = blocks[k]
            for b in blocks[k + 1:k + fan]:
                both = made[-1] + b[0]
                if _feasible(both, *both[0], error)[0]:
                    made = made[:-1] + [both] + b[1:]
                else:
                    made = made + b
            wider.append(made)
        blocks = wider
    return [(s[0][0], s[-1][0], *_feasible(s, *s[0], error)[1:]) for s in blocks[0]] if blocks else []


@pytest.mark.parametrize("block,fan", [(1000, 4), (64, 1000), (16, 3)])
def test_segments_equal_one_task(spark, block, fan):
    rng = random.Random(block)
    groups = {g: sorted(_curve(rng, n)) for g, n in (("a", 700), ("b", 1), ("c", 64), ("d", 333))}
    groups["line"] = list(range(10, 900))
    rows = [(g, i, y, len(v)) for g, v in groups.items() for i, y in enumerate(v)]
    rng.shuffle(rows)
    ranked = spark.createDataFrame(rows, "grp string, rank long, number long, n long")
    got = {}
    for r in segments.linear_segments(ranked, 3.0, block, fan).collect():
        got.setdefault(r["grp"], []).append((r["first_rank"], r["last_rank"], r["slope"]))
        v = groups[r["grp"]]
        assert (r["first_number"], r["last_number"]) == (v[r["first_rank"]], v[r["last_rank"]])
        if r["slope"] is not None:
            for x in range(r["first_rank"], r["last_rank"] + 1):
                assert abs(v[r["first_rank"]] + r["slope"] * (x - r["first_rank"]) - v[x]) <= 3.0 + 1e-9
    for g, v in groups.items():
        expected = [(a, b, (lo + hi) / 2 if b > a else None) for a, b, lo, hi in _brute(v, 3.0, block, fan)]
        assert sorted(got[g]) == expected, g
    assert got["line"] == [(0, 889, pytest.approx(1.0))]


def test_empty_and_null_groups(spark):
    ranked = spark.createDataFrame([(None, 0, 5, 2), (None, 1, 6, 2)], "grp string, rank long, number long, n long")
    assert [tuple(r)[:3] for r in segments.linear_segments(ranked, 0.0).collect()] == [(None, 0, 1)]
    assert segments.linear_segments(ranked.limit(0), 1.0).count() == 0


def test_islands_equal_one_task(spark):
    rng = random.Random(6)
    rows = [(g, rng.randrange(0, 400)) for g in ("a", "b", None) for _ in range(300)] + [("one", 5)] * 4 + [("neg", -1), ("neg", 0)]
    rows += [("long", i) for i in range(3000)]
    rng.shuffle(rows)
    numbers = spark.createDataFrame(rows, "grp string, number int")
    expected = set()
    for g in {g for g, _ in rows}:
        values = sorted(n for h, n in rows if h == g)
        runs = []
        for v in values:
            if runs and v <= runs[-1][1] + 1:
                runs[-1][1], runs[-1][2] = v, runs[-1][2] + 1
            else:
                runs.append([v, v, 1])
        expected |= {(g, *r) for r in runs}
    assert {tuple(r) for r in sequence.islands(numbers).collect()} == expected
    assert {tuple(r) for r in sequence.islands(numbers, 3).collect()} == {r for r in expected if r[2] - r[1] + 1 >= 3}
