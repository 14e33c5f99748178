"""Piecewise-linear segments of ranked numbers, within a stated error.

The curve number(rank) of each group is cut into segments; a line through a segment's
first point misses none of its numbers by more than ``error``. A segment grows as long as
the feasible slopes (the cone from its first point) are not empty.

Groups are cut by rank into blocks of ``BLOCK`` rows, each cut into segments by one task.
Then the segments on both sides of a block border become one if a line from the first
point of the left one serves both. For that a border segment carries the convex hull of
its points, which stands for all of them. Borders are joined ``FAN`` blocks at a time,
those of the larger blocks so made next, and so on: a group of any size needs
log_FAN(rows / BLOCK) such rounds, and no task holds more than a block, or 2 FAN
segments. As blocks are made by rank, the result doesn't depend on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin

BLOCK = 65_536
FAN = 1024
_POINTS = "array<bigint>"
_SEGMENT = (f"first_rank bigint, last_rank bigint, first_number bigint, last_number bigint, low double, high double, "
            f"lower_x {_POINTS}, lower_y {_POINTS}, upper_x {_POINTS}, upper_y {_POINTS}")
_NAMES = [part.split()[0] for part in _SEGMENT.split(", ")]


def cone_segments(x: np.ndarray, y: np.ndarray, error: float) -> list[tuple[int, int, float, float]]:
    """(begin, end, lowest, highest feasible slope) of the segments of the points (x, y)."""
    out, i, n = [], 0, len(x)
    while i < n:
        low, high, j, width = -np.inf, np.inf, i + 1, 16
        while j < n:
            k = min(j + width, n)
            run = x[j:k] - x[i]
            highs = np.minimum(np.minimum.accumulate((y[j:k] + error - y[i]) / run), high)
            lows = np.maximum(np.maximum.accumulate((y[j:k] - error - y[i]) / run), low)
            outside = np.flatnonzero(lows > highs)
            good = outside[0] if len(outside) else k - j
            if good:
                low, high = float(lows[good - 1]), float(highs[good - 1])
            j += good
            if len(outside):
                break
            width *= 2
        out.append((i, j, low, high))
        i = j
    return out


def _hull(x: list[int], y: list[int], sign: int) -> tuple[list[int], list[int]]:
    """Lower (sign 1) or upper (sign -1) convex hull of points in order of x."""
    hx: list[int] = []
    hy: list[int] = []
    for px, py in zip(x, y):
        while len(hx) > 1 and sign * ((hx[-1] - hx[-2]) * (py - hy[-2]) - (hy[-1] - hy[-2]) * (px - hx[-2])) <= 0:
            hx.pop()
            hy.pop()
        hx.append(px)
        hy.append(py)
    return hx, hy


def _block_segments(ranked: DataFrame, error: float, block: int) -> DataFrame:
    """Segments of every (grp, rank block); border segments of cut groups with their hulls."""
    kind = dict(ranked.dtypes)["grp"]
    rows = ranked.select("grp", "rank", F.col("number").cast("bigint").alias("number"), "n").repartition(
        "grp", F.floor(F.col("rank") / block)).sortWithinPartitions("grp", "rank")

    def made(rows: pa.Table) -> pa.RecordBatch:
        x, y, n = (rows.column(c).to_numpy() for c in ("rank", "number", "n"))
        # Ranks of a group are 0, 1, 2, ...: a block begins at each multiple.
        starts = np.flatnonzero(x % block == 0)
        picked, out = [], []
        for a, b in zip(starts, [*starts[1:], len(x)]):
            found = cone_segments(x[a:b], y[a:b], error)
            for k, (i, j, low, high) in enumerate(found):
                i, j = i + a, j + a
                hulls: list = [None] * 4
                if n[a] > block and k in (0, len(found) - 1):
                    xs, ys = x[i:j].tolist(), y[i:j].tolist()
                    hulls = [*_hull(xs, ys, 1), *_hull(xs, ys, -1)]
                picked.append(i)
                out.append((int(x[i]), int(x[j - 1]), int(y[i]), int(y[j - 1]), low, high, *hulls))
        columns = list(zip(*out)) or [()] * len(_NAMES)
        types = [pa.int64()] * 4 + [pa.float64()] * 2 + [pa.list_(pa.int64())] * 4
        grp = rows.column("grp").combine_chunks().take(pa.array(picked, pa.int64()))
        return pa.RecordBatch.from_arrays([grp, *(pa.array(c, t) for c, t in zip(columns, types))], names=["grp", *_NAMES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            # Whole blocks only: rows from the batch's last block start on wait.
            starts = np.flatnonzero(batch.column(1).to_numpy() % block == 0)
            cut = int(starts[-1]) if len(starts) else 0
            if len(starts) and (held or cut):
                held.append(batch.slice(0, cut))
                yield made(pa.Table.from_batches(held))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield made(pa.Table.from_batches(held))

    return rows.mapInArrow(run, f"grp {kind}, {_SEGMENT}")


def _merged(items: list[dict], error: float) -> list[dict]:
    """Neighbours in rank order joined wherever one line serves both."""
    out: list[dict] = []
    for s in items:
        last = out[-1] if out else None
        if last is not None and last["last_rank"] + 1 == s["first_rank"]:
            x0, y0 = last["first_rank"], last["first_number"]
            high = min(last["high"], ((np.asarray(s["lower_y"]) + error - y0) / (np.asarray(s["lower_x"]) - x0)).min())
            low = max(last["low"], ((np.asarray(s["upper_y"]) - error - y0) / (np.asarray(s["upper_x"]) - x0)).max())
            if low <= high:
                last["low"], last["high"] = float(low), float(high)
                last["last_rank"], last["last_number"] = s["last_rank"], s["last_number"]
                for side, sign in (("lower", 1), ("upper", -1)):
                    last[side + "_x"], last[side + "_y"] = _hull(
                        [*last[side + "_x"], *s[side + "_x"]], [*last[side + "_y"], *s[side + "_y"]], sign)
                continue
        out.append(dict(s))
    return out


def linear_segments(ranked: DataFrame, error: float, block: int | None = None, fan: int | None = None) -> DataFrame:
    """(grp, first_rank, last_rank, first_number, last_number, n, slope) of every segment.

    ``ranked`` is the output of ``rank_numbers``. ``slope`` is the middle of the feasible
    slopes: first_number + slope * (rank - first_rank) is within ``error`` of every number
    of the segment; null for a segment of one row.
    """
    block, fan = block or BLOCK, fan or FAN
    segments = pin(_block_segments(ranked, error, block))
    kind = dict(segments.dtypes)["grp"]
    done, open_ = segments.where("lower_x is null"), segments.where("lower_x is not null")
    span = block

    def join(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("first_rank")
        grp = part["grp"].iloc[0]
        out = pd.DataFrame(_merged(part[_NAMES].to_dict("records"), error), columns=_NAMES)
        out.insert(0, "grp", [grp] * len(out))
        # What borders another block goes on.
        out["border"] = [k in (0, len(out) - 1) for k in range(len(out))]
        return out

    while not open_.isEmpty():
        span *= fan
        top = open_.agg(F.max("last_rank")).first()[0]
        joined = pin(open_.groupBy("grp", F.floor(F.col("first_rank") / span)).applyInPandas(
            join, f"grp {kind}, {_SEGMENT}, border boolean"))
        if top < span:
            done = done.unionByName(joined.drop("border"))
            break
        done = done.unionByName(joined.where(~F.col("border")).drop("border"))
        open_ = joined.where("border").drop("border")
    slope = F.when(F.col("last_rank") > F.col("first_rank"), (F.col("low") + F.col("high")) / 2)
    return done.select("grp", "first_rank", "last_rank", "first_number", "last_number",
                       (F.col("last_rank") - F.col("first_rank") + 1).alias("n"), slope.alias("slope"))
