"""Document fingerprints: threshold-scaled sketches of word shingles (native).

The sketch of a text keeps every distinct shingle hash below a fixed fraction
(1 / ``SCALE``) of the hash space, and never fewer than its ``FLOOR`` smallest
hashes (all of them, if it has no more), so that short texts are kept exactly. With
it goes ``bound``, the hash up to which the sketch is complete. Two sketches are
complete up to the smaller bound; below it they are samples of the two shingle sets
by the same rule, so containment is estimated well between very unequal texts, and
the sketch of a union is the merge of the sketches.

Shingles are ``SHINGLE`` lower-cased words; a text with fewer words is one shingle,
a text without words has an empty sketch. Two empty sketches are alike (1), an empty
and a filled one are not (0).

Defined cases: a null text is an empty text; documents follow one another by key,
nulls first, equal keys by text; a single row follows itself; repeated rows are kept;
an empty table gives an empty result; only ``key`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.ordered import sorted_index
from ..session import pin
from .common import col, words

SHINGLE = 5
SCALE = 16
FLOOR = 32
# Hashes are signed: the fraction lies at the lower end.
LIMIT = -(1 << 63) + (1 << 64) // SCALE
TOP = (1 << 63) - 1
ROWS_PER_BUCKET = 4_000
MAX_BUCKETS = 20_000
START = 64  # characters of a text that place it among rows of one key


def _hashes(w: Column) -> Column:
    """Distinct hashes of the word shingles of a word array."""
    many = F.transform(F.slice(w, 1, F.greatest(F.size(w) - (SHINGLE - 1), F.lit(1))),
                       lambda x, i: F.xxhash64(x, *[w[i + j] for j in range(1, SHINGLE)]))
    whole = F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(
        F.array().cast("array<bigint>"))
    return F.array_distinct(F.when(F.size(w) >= SHINGLE, many).otherwise(whole))


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """``df`` with column ``out``: struct(hashes ascending, bound)."""
    w, h, low = "_w_" + out, "_h_" + out, "_l_" + out
    limit, floor = F.lit(LIMIT), F.lit(FLOOR)
    df = df.withColumn(w, words(F.lower(F.col(text)))).withColumn(h, _hashes(F.col(w)))
    df = df.withColumn(low, F.filter(F.col(h), lambda x: x < limit))
    kept = F.when(F.size(low) >= floor, F.sort_array(low)).otherwise(F.slice(F.sort_array(h), 1, FLOOR))
    bound = (F.when(F.size(h) <= floor, F.lit(TOP)).when(F.size(low) >= floor, limit)
             .otherwise(F.element_at(F.sort_array(h), FLOOR)))
    return df.withColumn(out, F.struct(kept.alias("hashes"), bound.alias("bound"))).drop(w, h, low)


def merged(a: Column, b: Column) -> Column:
    """Sketch of the union of two texts' shingle sets, from their sketches."""
    bound = F.least(a["bound"], b["bound"])
    both = F.sort_array(F.array_union(a["hashes"], b["hashes"]))
    return F.struct(F.filter(both, lambda x: x <= bound).alias("hashes"), bound.alias("bound"))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the smaller shingle set that the other holds, 0 to 1."""
    bound = F.least(a["bound"], b["bound"])

    def cut(s: Column) -> Column:
        return F.filter(s["hashes"], lambda x: x <= bound)

    common = F.size(F.array_intersect(cut(a), cut(b)))
    least = F.least(F.size(cut(a)), F.size(cut(b)))
    empty = (F.size(a["hashes"]) == 0) & (F.size(b["hashes"]) == 0)
    return F.when(empty, 1.0).when(least > 0, common / least).otherwise(0.0)


def text_form(s: Column) -> Column:
    """The sketch as text: its hashes as 16 hex digits each, joined by blanks."""
    return F.array_join(F.transform(s["hashes"], lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), " ")


def _bucket(table: Column, place: Column) -> Column:
    """How many entries of the ascending array ``table`` are up to ``place``, by binary search."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(table) + 1)).cast("int"))

    def halve(a: Column, _: Column) -> Column:
        mid = F.floor((a["lo"] + a["hi"]) / 2).cast("int")
        below = F.get(table, mid) <= place
        return F.when(a["lo"] >= a["hi"], a).otherwise(F.struct(
            F.when(below, mid + 1).otherwise(a["lo"]).alias("lo"), F.when(below, a["hi"]).otherwise(mid).alias("hi")))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(table).alias("hi")), halve)["lo"]


def with_next(df: DataFrame, key: str, text: str, carried: list[str]) -> DataFrame:
    """``df`` with ``next_<c>``: the ``carried`` columns of the next row by (key, text).

    After the last row comes the first. Rows are cut into ranges of (key, start of the
    text) at places that exist, found by the distributed ordinal, and the rows at each cut also go to the
    range before, so every range sees its successor and no window spans the table, a
    key's rows or those without key. Keys are of any orderable type.
    """
    place = F.struct(F.col(key).alias("k"), F.substring(text, 1, START).alias("h"))
    places = pin(df.select(F.col(key).alias("k"), F.substring(text, 1, START).alias("h")))
    n = places.count()
    wanted = min(MAX_BUCKETS, -(-n // ROWS_PER_BUCKET))
    at = sorted_index(places, ["k", "h"], index_col="at") if wanted > 1 else places.withColumn("at", F.lit(0))
    cuts = at.where((F.col("at") > 0) & (F.col("at") % -(-n // max(wanted, 1)) == 0))
    # At most MAX_BUCKETS places, in one row.
    bounds = pin(cuts.agg(F.sort_array(F.collect_set(F.struct("k", "h"))).alias("bounds")))
    first = places.agg(F.min(F.struct("k", "h")).alias("first"))
    rows = df.withColumn("_place", place).withColumn("_bounds", bounds.scalar()).withColumn(
        "_own", _bucket(F.col("_bounds"), F.col("_place")))
    none = F.array().cast("array<struct<b:int,ghost:int>>")
    at_cut = F.get("_bounds", F.col("_own") - 1).eqNullSafe(F.col("_place")) & (F.col("_own") > 0)
    copies = F.concat(
        F.array(F.struct(F.col("_own").alias("b"), F.lit(0).alias("ghost"))),
        F.when(F.col("_place").eqNullSafe(first.scalar()), F.array(F.struct(F.size("_bounds").alias("b"), F.lit(2).alias("ghost")))).otherwise(none),
        F.when(at_cut, F.array(F.struct((F.col("_own") - 1).alias("b"), F.lit(1).alias("ghost")))).otherwise(none))
    rows = rows.withColumn("_at", F.explode(copies)).select(
        *df.columns, F.col("_place.h").alias("_h"), F.col("_at.b").alias("_b"), F.col("_at.ghost").alias("_ghost"))
    # Plain partition columns and one select: all leads share one exchange and sort.
    order = Window.partitionBy("_b").orderBy("_ghost", F.col(key).asc_nulls_first(), "_h", text)
    rows = rows.select("*", *[F.lead(c).over(order).alias("next_" + c) for c in carried])
    return rows.where("_ghost = 0").drop("_b", "_ghost", "_h")


def compare_with_edits(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its sketch, that of an edited text, and their likeness.

    The edited text has its last quarter replaced by the start of the next document.
    Columns: key, n_chars, edited_text, sketch, edited_sketch, near_edited, near_next.
    """
    rows = df.select(col(key).alias("_k"), F.coalesce(col(text), F.lit("")).alias("_t"))
    rows = with_next(with_sketch(rows, "_t", "_sk"), "_k", "_t", ["_t", "_sk"])
    n = F.char_length("_t")
    cut = F.floor(n / 4).cast("int")
    rows = rows.withColumn("_n", n).withColumn("_edited", F.concat(
        F.substring("_t", F.lit(1), n - cut), F.substring("next__t", F.lit(1), cut)))
    rows = with_sketch(rows, "_edited", "_esk")
    return rows.select(
        F.col("_k").alias(key), F.col("_n").cast("long").alias("n_chars"), F.col("_edited").alias("edited_text"),
        F.col("_sk").alias("sketch"), F.col("_esk").alias("edited_sketch"),
        containment(F.col("_sk"), F.col("_esk")).alias("near_edited"),
        containment(F.col("_sk"), F.col("next__sk")).alias("near_next"))
