"""N-gram Jaccard join: documents whose sets of word shingles are alike, as components.

A document's set holds its distinct ``shingle``-word runs (fewer words: the whole
sequence). Two sets x, y link when 100 |x & y| >= ``percent`` |x | y|, so each must share
at least need(x) = ceil(percent |x| / 100) of its members with the other. In any order
that all sets agree on, the first |x| - need(x) + m members of x and the same of y have
at least m members in common ("m-match prefixes"); with m_x and m_y chosen separately,
at least min(m_x, m_y). Every step below uses this, so no link is lost:

1. Screen, in the order of the hashes: of each set's prefix at least m members must
   occur in another row. One count by hash and one join; most documents end here, and
   only the others' whole sets are built.
2. Prefixes, rarest member first: members that occur once can match nothing, so they are
   never written, and a set with fewer than need(x) other members ends here. Each
   document lengthens its prefix to the m of least estimated cost: postings met, and
   candidates times the price of verifying one. A candidate uses up m postings, so there
   are at most (postings met) / m of them.
3. Pivots: the members of a prefix token's list are compared with one of them, not with
   each other, and each set with only one pivot a round. Rounds go on while they link
   many and much is left to meet, so groups of near copies become components at a cost
   linear in their size. Each round's links join the
   components so far, not the sets, so every round's closure starts where the last ended.
4. What is left: pairs from two components that share min(m_x, m_y) prefix members are
   verified by exact intersection. Before that, each meeting of two sets in a list must
   leave room for the overlap that their sizes ask for: by the places of the shared
   member in both, and by the sets' parities (of ``PARITY_BITS`` classes of hashes, how
   many recurring members each holds, modulo 2; every class that differs is a member
   that one set alone has). So near copies that are not near enough don't meet as pairs.

Scale: equal sets are one node from step 2 on. Counts are partially aggregated, lists of
hot tokens are split (``salted_join``), each join is on a hash or node. Members are
64-bit hashes of the words' hashes; equal sets have equal 128-bit digests.

Defined cases: null, empty and wordless texts have an empty set, size 0, and are linked
with nothing; rows repeating a key stay rows; a null key is component_id only where its
whole component has no other; an empty table gives an empty result; only key and text
are read, so further columns can't clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.skew import bounded_broadcast, salted_join
from ..session import pin, unpin
from .common import chunked, col
from .components import component_roots

SHINGLE = 5
PERCENT = 80
SCREEN_SHARE = 20       # the screen asks for a twentieth of the set as matches
PIECE_BYTES = 1 << 20   # very long texts are split into words piece by piece
CACHED_WORDS = 1 << 16
PAIR_COST, MEMBER_COST = 10.0, 0.1   # verifying a pair, in postings: fixed and per member
LINKING_SHARE = 0.1     # pivot rounds go on while this share of their tests links,
MEETINGS = 2            # and pairs of two components in the open lists exceed this many times their rows
PARITY_BITS = 256
_PARITY = [f"p{i}" for i in range(PARITY_BITS // 64)]
_SHOWN = ["c", "root", "n", "k", "at", *_PARITY]   # what a pivot is judged by

_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_M = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Word -> 64-bit hash, computed once a worker (emptied when large)."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh64_intdigest(word)
        if len(self) < CACHED_WORDS:
            self[word] = value
        return value


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(data: bytes, known: _WordHashes) -> np.ndarray:
    """Hashes of the words of a text; A-Z are lower-cased, other letters stay."""
    found, start = [], 0
    while start < len(data):
        cut = _SPACE.search(data, start + PIECE_BYTES)
        end = cut.end() if cut else len(data)
        words = data[start:end].lower().split()
        found.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
        start = end
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def shingle_set(text: str | None, known: _WordHashes, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the word shingles of a text."""
    words = _word_hashes((text or "").encode("utf-8", "surrogatepass"), known)
    if not len(words):
        return words
    size = min(shingle, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)  # short sequences differ from shingles
    for k in range(size):
        total = _mix(total * _M + words[k:len(words) - size + 1 + k])
    return np.unique(total)


def _need(n: int, percent: int) -> int:
    """The fewest members a set of n shares with any set it links to."""
    return -(-n * percent // 100)


def _digest(members: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(members.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _screened(rows: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(_k, n, s1, s2, least, probe): set size, digest, matches asked for, screen prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in chunked(batches, 1):
            n, s1, s2, least, probe = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                members = shingle_set(text, known, shingle)
                m = max(1, len(members) // SCREEN_SHARE)
                n.append(len(members))
                a, b = _digest(members)
                s1.append(a)
                s2.append(b)
                least.append(m)
                probe.append(members[:len(members) - _need(len(members), percent) + m].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(s1, pa.int64()), pa.array(s2, pa.int64()),
                 pa.array(least, pa.int64()), pa.array(probe, pa.list_(pa.int64()))],
                names=["_k", "n", "s1", "s2", "least", "probe"])

    kind = dict(rows.dtypes)["_k"]
    return rows.mapInArrow(run, f"_k {kind}, n long, s1 long, s2 long, least long, probe array<long>")


def _survivors(marked: DataFrame) -> DataFrame:
    """(s1, s2, _k): one row a distinct set of which enough of the screen prefix recurs."""
    rows = marked.where("n > 0").withColumn("rid", F.monotonically_increasing_id())
    probes = rows.select("rid", "least", F.explode("probe").alias("h"))
    again = probes.groupBy(F.col("h").alias("h2")).count().where("count > 1").select("h2")
    enough = (probes.join(again, F.col("h") == F.col("h2")).groupBy("rid", "least").count()
              .where("count >= least").select(F.col("rid").alias("rid2")))
    kept = rows.select("rid", "s1", "s2", "_k").join(enough, F.col("rid") == F.col("rid2"), "left_semi")
    return kept.groupBy("s1", "s2").agg(F.min("_k").alias("_k"))


def _sets(rows: DataFrame, kept: DataFrame, shingle: int) -> DataFrame:
    """(c, s1, s2, n, members) of the surviving distinct sets; c numbers them."""
    wanted = bounded_broadcast(kept.select(F.col("_k").alias("_k2")).distinct())
    texts = rows.join(wanted, F.col("_k").eqNullSafe(F.col("_k2")), "left_semi").select("_t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in chunked(batches, 0):
            sets = [s for s in (shingle_set(t, known, shingle) for t in batch.column(0).to_pylist()) if len(s)]
            digests = [_digest(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in digests], pa.int64()), pa.array([b for _, b in digests], pa.int64()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["s1", "s2", "n", "members"])

    built = texts.mapInArrow(run, "s1 long, s2 long, n long, members array<long>").dropDuplicates(["s1", "s2"])
    once = pin(built)
    sets = pin(once.withColumn("c", F.monotonically_increasing_id()))
    unpin(once)
    return sets


def choose_matches(counts: np.ndarray, n: int, percent: int = PERCENT) -> tuple[int, int]:
    """(m, prefix members that recur) of least cost for a set of n members.

    ``counts``: in how many sets each of its recurring members occurs, ascending.
    """
    need, k = _need(n, percent), len(counts)
    met = np.cumsum(counts)
    m = np.arange(1, need + 1)
    used = k - need + m           # recurring members among the first n - need + m
    m, used = m[used > 0], used[used > 0]
    postings = met[used - 1]
    cost = postings + (PAIR_COST + MEMBER_COST * n) * (postings - used) / m
    best = int(np.argmin(cost))
    return int(m[best]), int(used[best])


def parity(members: np.ndarray) -> np.ndarray:
    """Per class of hashes, whether an odd number of ``members`` is in it, as 64-bit words."""
    odd = np.bincount(members.view(np.uint64) % np.uint64(PARITY_BITS), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _postings(sets: DataFrame, percent: int) -> DataFrame:
    """(h, c, n, m, k, at, central, parity): the recurring prefix members of every set that
    can link, with their place ``at`` among its ``k`` recurring members."""
    members = sets.select("c", "n", F.explode("members").alias("h"))
    counts = members.groupBy(F.col("h").alias("h2")).agg(F.count("*").alias("df")).where("df > 1")
    recurring = (members.join(counts, F.col("h") == F.col("h2")).groupBy("c", "n")
                 .agg(F.collect_list(F.struct("df", "h")).alias("shared"))
                 .where(F.size("shared") * 100 >= F.col("n") * percent)
                 .select("c", "n", F.array_sort("shared").alias("shared")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            df, h = (lists.values.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            at = lists.offsets.to_numpy()
            out: list[list[np.ndarray]] = [[] for _ in names]
            for c, n, a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), at[:-1], at[1:]):
                m, used = choose_matches(df[a:b], n, percent)
                row = (h[a:a + used], np.full(used, c), np.full(used, n), np.full(used, m), np.full(used, b - a),
                       np.arange(used), *(np.full(used, p) for p in parity(h[a:b])), np.full(used, df[a:b].sum() / n))
                for part, values in zip(out, row):
                    part.append(values)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(x), t) for x, t in zip(out, [pa.int64()] * (len(names) - 1) + [pa.float64()])],
                    names=names)

    names = ["h", "c", "n", "m", "k", "at", *_PARITY, "central"]
    return recurring.mapInArrow(run, ", ".join(f"{x} long" for x in names[:-1]) + ", central double")


def _could_link(a: str, b: str, percent: int) -> Column:
    """Two sets that meet in a list may reach the threshold; ``a`` and ``b`` go before
    their columns' names. Lossless: true for every shared prefix member of a link."""
    x, y = ({c: F.col(p + c) for c in ("n", "k", "at", *_PARITY)} for p in (a, b))
    # |x & y| >= overlap, from 100 |x & y| >= percent (|x| + |y| - |x & y|).
    overlap = F.ceil((x["n"] + y["n"]) * percent / (100 + percent) - 1e-9)
    room = F.least(x["at"], y["at"]) + F.least(x["k"] - x["at"], y["k"] - y["at"])
    alone = sum((F.bit_count(x[p].bitwiseXOR(y[p])) for p in _PARITY), F.lit(0))
    return (room >= overlap) & (alone <= x["k"] + y["k"] - 2 * overlap)


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``pairs`` (a, b, ...) whose sets reach the threshold, by exact intersection."""
    # Only the sets of some pair move.
    named = pairs.select(F.col("a").alias("c0")).unionByName(pairs.select(F.col("b").alias("c0"))).distinct()
    needed = sets.join(bounded_broadcast(named), F.col("c") == F.col("c0"), "left_semi")
    left = needed.select(F.col("c").alias("c1"), F.col("n").alias("n1"), F.col("members").alias("x1"))
    right = needed.select(F.col("c").alias("c2"), F.col("n").alias("n2"), F.col("members").alias("x2"))
    both = pairs.join(left, F.col("a") == F.col("c1")).join(right, F.col("b") == F.col("c2"))
    common = F.size(F.array_intersect("x1", "x2"))
    return both.where(common * 100 >= (F.col("n1") + F.col("n2") - common) * percent).select(*pairs.columns)


def _joins(edges: DataFrame) -> DataFrame:
    """(node, new): what the components that ``edges`` (root_a, root_b) link become."""
    roots = component_roots(edges.select(F.col("root_a").alias("a"), F.col("root_b").alias("b")))
    return bounded_broadcast(roots.select("node", F.col("root").alias("new")))


def _joined(rows: DataFrame, joins: DataFrame) -> DataFrame:
    """``rows`` with the component each ``root`` has become."""
    return rows.join(joins, F.col("root") == F.col("node"), "left").withColumn(
        "root", F.coalesce("new", "root")).drop("node", "new")


def _met(postings: DataFrame, step: int) -> DataFrame:
    """The postings, as a_..., of lists that hold more than one component, each with its
    list's pivot, as b_...."""
    # The most central set first (the text others were copied from), then any by hash.
    order = -F.col("central") if step == 0 else F.xxhash64(F.lit(step), "c").cast("double")
    heads = postings.groupBy(F.col("h").alias("h2")).agg(
        F.min(F.struct(order.alias("o"), *(F.col(x).alias("b_" + x) for x in _SHOWN))).alias("p"),
        F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("h2", "p")
    met = postings.join(heads, F.col("h") == F.col("h2"))
    return met.select(*(F.col(x).alias("a_" + x) for x in postings.columns), "p.*")


def _pivot_tests(met: DataFrame, percent: int) -> DataFrame:
    """(a, b, root_a, root_b): every set with one pivot of another component, that of most shared lists."""
    met = met.where((F.col("a_root") != F.col("b_root")) & _could_link("a_", "b_", percent))
    tests = met.groupBy("a_c", "b_c", "a_root", "b_root").count()
    return tests.groupBy("a_c", "a_root").agg(F.max(F.struct("count", "b_c", "b_root")).alias("best")).select(
        F.col("a_c").alias("a"), F.col("best.b_c").alias("b"), F.col("a_root").alias("root_a"),
        F.col("best.b_root").alias("root_b"))


def _meetings(met: DataFrame) -> tuple[int, int]:
    """(rows, pairs of rows of two components) of the lists."""
    parts = met.groupBy("a_h", "a_root").agg(F.count("*").alias("n"))
    lists = parts.groupBy("a_h").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("own"))
    rows, pairs = lists.agg(F.sum("n"), F.sum(F.expr("(n * n - own) div 2"))).first()
    return rows or 0, pairs or 0


def _remaining_pairs(postings: DataFrame, percent: int) -> DataFrame:
    """(a, b, root_a, root_b): pairs of two components with enough shared prefix members."""
    shown = [x for x in postings.columns if x != "central"]
    left, right = (postings.select(*(F.col(x).alias(p + x) for x in shown)) for p in ("a_", "b_"))
    met = salted_join(left, right, "a_h", "b_h").where("a_c < b_c and a_root <> b_root").where(
        _could_link("a_", "b_", percent))
    return (met.groupBy(F.col("a_c").alias("a"), F.col("b_c").alias("b"), F.col("a_root").alias("root_a"),
                        F.col("b_root").alias("root_b"), F.least("a_m", "b_m").alias("m")).count()
            .where("count >= m").select("a", "b", "root_a", "root_b"))


def set_roots(sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(c, root): the component, by links, of every one of ``sets`` (c, n, members)."""
    # Each round's lists replace those of the round before, which are deleted.
    held = pin(_postings(sets, percent))
    columns = [*held.columns, "root"]
    postings = held.withColumn("root", F.col("c"))
    named = sets.select("c", F.col("c").alias("root"))
    step, linking = 0, True
    while True:
        # A list of one component stays one: only open lists go on.
        met = pin(_met(postings, step))
        unpin(held)
        held, (rows, pairs) = met, _meetings(met)
        if step and (not linking or pairs <= MEETINGS * rows):
            break
        tests = pin(_pivot_tests(met, percent))
        new = pin(_verified(tests, sets, percent))
        n_tests, n_new = tests.count(), new.count()
        unpin(tests)
        postings = met.select(*(F.col("a_" + x).alias(x) for x in columns))
        if n_new:
            joins = _joins(new)
            postings, named = _joined(postings, joins), _joined(named, joins)
        step, linking = step + 1, n_new > LINKING_SHARE * n_tests
    if rows:
        pairs = pin(_remaining_pairs(met.select(*(F.col("a_" + x).alias(x) for x in columns)), percent))
        new = pin(_verified(pairs, sets, percent))
        if new.count():
            named = _joined(named, _joins(new))
    unpin(held)
    return named


def join_components(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id) for every row: set size, least key reachable by links."""
    rows = df.select(col(key).alias("_k"), col(text).alias("_t"))
    marked = pin(_screened(rows, shingle, percent))
    kept = pin(_survivors(marked))
    sets = _sets(rows, kept, shingle)
    roots = set_roots(sets, percent).withColumnRenamed("c", "node")
    named = sets.select("c", F.col("s1").alias("d1"), F.col("s2").alias("d2")).join(
        roots, F.col("c") == F.col("node")).select("d1", "d2", "root")
    # A set's key is its least; a component's that of its sets.
    least = marked.where("n > 0").groupBy(F.col("s1").alias("d1"), F.col("s2").alias("d2")).agg(F.min("_k").alias("least"))
    least = pin(least.join(named, ["d1", "d2"], "left"))
    tops = least.where("root is not null").groupBy(F.col("root").alias("root2")).agg(F.min("least").alias("top"))
    classes = least.join(tops, F.col("root") == F.col("root2"), "left").select(
        "d1", "d2", F.when(F.col("root").isNull(), F.col("least")).otherwise(F.col("top")).alias("least"))
    empty = marked.where("n = 0").select(F.col("_k").alias(key), F.col("n").alias("n_shingles"),
                                         F.col("_k").alias("component_id"))
    full = marked.where("n > 0").select("_k", "n", "s1", "s2").join(
        classes, (F.col("s1") == F.col("d1")) & (F.col("s2") == F.col("d2")))
    return full.select(F.col("_k").alias(key), F.col("n").alias("n_shingles"),
                       F.col("least").alias("component_id")).unionByName(empty)
