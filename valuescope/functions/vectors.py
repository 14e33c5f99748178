"""Median-threshold bit fingerprints of numeric vectors (array columns).

A vector becomes one bit per element: element > median of the vector. The bits
are folded into a 64-bit integer (bit i at position i mod 64, XOR-folded for
vectors longer than 64) and, for compatibility, into the lossy 8-bit-position
sum sum(2^(i mod 8)) over set bits (range 0..2040 for 64 elements).

The median is placed in the start value of ``aggregate`` so it is evaluated once
per row; a median referenced inside a per-element lambda would be re-evaluated
for every element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vector_median(vec: Column | str) -> Column:
    """Median of the elements (mean of the two middle ones for even lengths), double."""
    v = F.array_sort(F.transform(_as_col(vec), lambda x: x.cast("double")))
    n = F.size(v)
    lo = F.get(v, F.floor((n - 1) / 2).cast("int"))
    hi = F.get(v, F.floor(n / 2).cast("int"))
    return (lo + hi) / F.lit(2.0)


def _fold(vec: Column | str, period: int, combine: str, zero: Column, one: Column) -> Column:
    c = _as_col(vec)
    start = F.struct(vector_median(c).alias("m"), zero.alias("acc"), F.lit(0).alias("i"))

    def step(s, x):
        bit = F.call_function("shiftleft", one, s["i"] % period)
        add = F.when(x.cast("double") > s["m"], bit).otherwise(zero)
        acc = s["acc"].bitwiseXOR(add) if combine == "xor" else s["acc"] + add
        return F.struct(s["m"].alias("m"), acc.alias("acc"), (s["i"] + 1).alias("i"))

    return F.aggregate(c, start, step, lambda s: s["acc"])


def median_bits(vec: Column | str) -> Column:
    """array<boolean>: element > median."""
    c = _as_col(vec)
    start = F.struct(vector_median(c).alias("m"), F.array().cast("array<boolean>").alias("bits"))
    return F.aggregate(
        c, start,
        lambda s, x: F.struct(s["m"].alias("m"),
                              F.array_append(s["bits"], x.cast("double") > s["m"]).alias("bits")),
        lambda s: s["bits"])


def fingerprint64(vec: Column | str) -> Column:
    """64-bit fingerprint: bit (i mod 64) XOR-set when element i exceeds the median."""
    return _fold(vec, 64, "xor", F.lit(0).cast("bigint"), F.lit(1).cast("bigint"))


def fold8(vec: Column | str) -> Column:
    """Lossy compatibility hash: sum of 2^(i mod 8) over set bits."""
    return _fold(vec, 8, "sum", F.lit(0), F.lit(1))
