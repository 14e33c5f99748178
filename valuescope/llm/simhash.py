"""SimHash near-duplicates, found by the generalised pigeonhole principle.

Fingerprint: word shingles are hashed to 64 bits, a fingerprint bit is set when it
is set in over half of the hashes. Two texts are linked when their fingerprints
differ in at most ``radius`` bits, and components are the transitive closure.

Search: the 64 bits are cut into m parts. If thresholds t_1..t_m sum to
radius - m + 1 (each at least -1, "skip the part"), two fingerprints within the
radius agree within t_i bits on some part i. Bits that go together are put into the
same part, so parts differ in how selective they are, and every fingerprint gets its
own thresholds: a dynamic programme picks those with the least estimated cost, from
the bit frequencies over all fingerprints. Its probes (all part values within t_i
bits) meet the part values of the others, and the full distance decides.

Scale: equal fingerprints are one node from the start, so copies cost one row. The
nodes of a probed part value are compared in blocks of at most about ``BLOCK``
nodes, a pair of blocks per task row; each emits a spanning forest of its links, not
all pairs. The part count m is the one whose estimated cost over all fingerprints is
least; the links found are the same for each m.

Defined cases: a null or empty text, and one without words, has fingerprint 0 and is
linked like any other; fewer words than a shingle make one shingle; rows repeating a
key stay rows; a null key is no candidate for component_id unless its whole component
has no other; an empty table gives an empty result; only key and text are read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import chunked, col, numbered, tidied
from .components import component_roots

SHINGLE = 3
RADIUS = 3
SEED = 42
BITS = 64
BLOCK = 512
PIECE = 1 << 20
# Relative costs for the choice of thresholds: a probe row, a candidate to verify.
PROBE_COST = 1.0
CANDIDATE_COST = 0.02

_LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))


def _pieces(data: bytes) -> Iterator[bytes]:
    """Cut a text into pieces of about ``PIECE`` bytes between words."""
    start = 0
    while start < len(data):
        end = min(start + PIECE, len(data))
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        yield data[start:end]
        start = end


def fingerprint(data: bytes, shingle: int = SHINGLE) -> int:
    """64-bit SimHash of a UTF-8 text, in bounded memory."""
    counts, total, tail = np.zeros(BITS, np.int64), 0, []
    for piece in _pieces(data.translate(_LOWER)):
        words = tail + piece.split()
        if len(words) >= shingle:
            joined = b" ".join(words)
            ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1))
            starts = [0, *(e + 1 for e in ends)]
            digest = xxhash.xxh64_intdigest
            hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[shingle - 1:])], np.uint64)
            for k in range(0, len(hashes), 8192):
                bits = np.unpackbits(hashes[k:k + 8192].astype("<u8").view(np.uint8).reshape(-1, 8),
                                     axis=1, bitorder="little")
                counts += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        tail = words[-(shingle - 1):] if shingle > 1 else []
    if total == 0:
        return xxhash.xxh64_intdigest(b" ".join(tail), SEED) if tail else 0
    return int((1 << np.arange(BITS, dtype=np.uint64))[counts * 2 > total].sum(dtype=np.uint64))


def with_fingerprint(df: DataFrame, text: str, out: str, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the fingerprint of column ``text`` as bigint column ``out``."""
    names, at = df.columns, df.columns.index(text)
    schema = df.withColumn(out, F.lit(0).cast("bigint")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, at):
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            got = np.array([fingerprint(t or b"", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], names=[*names, out])

    return df.mapInArrow(tidied(run), schema)


def _pair_counts(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """(number of fingerprints, 64 x 64 counts of bits set together) over all nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            fps = batch.column(0).to_numpy().astype("<i8")
            for k in range(0, len(fps), 65536):
                bits = np.unpackbits(fps[k:k + 65536].view(np.uint8).reshape(-1, 8), axis=1,
                                     bitorder="little").astype(np.float32)
                both += np.rint(bits.T @ bits).astype(np.int64)
        i = np.repeat(np.arange(BITS), BITS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i), pa.array(np.tile(np.arange(BITS), BITS)), pa.array(both.ravel())], names=["i", "j", "n"])

    # Fixed size: 4096 counts.
    got = nodes.select("fp").mapInArrow(run, "i long, j long, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    both = np.zeros((BITS, BITS))
    for r in got.collect():
        both[r["i"], r["j"]] = r["n"]
    return nodes.count(), both


def plan_parts(n: int, both: np.ndarray, m: int) -> list[np.ndarray]:
    """Cut the bits into m parts of about equal width, correlated bits together."""
    p = np.diag(both) / max(n, 1)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0.0)
    left, parts = list(range(BITS)), []
    for k in range(m):
        width = len(left) // (m - k)
        part = [max(left, key=lambda b: (corr[b, left].sum(), -b))]
        left.remove(part[0])
        while len(part) < width:
            best = max(left, key=lambda b: (corr[b, part].mean(), -b))
            part.append(best)
            left.remove(best)
        parts.append(np.array(sorted(part), np.uint64))
    return parts


def _ball(width: int, t: int) -> int:
    return sum(_choose(width, k) for k in range(t + 1))


def _choose(n: int, k: int) -> int:
    out = 1
    for i in range(k):
        out = out * (n - i) // (i + 1)
    return out


def _differences(fps: np.ndarray, part: np.ndarray, p: np.ndarray, radius: int) -> np.ndarray:
    """(len(fps), radius + 1): chance that a random fingerprint differs in exactly k bits of the part."""
    dist = np.zeros((len(fps), radius + 1))
    dist[:, 0] = 1.0
    for b in part:
        q = np.where((fps >> b) & np.uint64(1), 1 - p[int(b)], p[int(b)])[:, None]
        moved = dist * (1 - q)
        moved[:, 1:] += dist[:, :-1] * q
        dist = moved
    return dist


def thresholds(fps: np.ndarray, parts: list[np.ndarray], p: np.ndarray, n: int,
               radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Thresholds of least estimated cost, (len(fps), m), and these costs.

    Dynamic programme over the parts: best cost of the first i parts with the sum of
    (threshold + 1) equal to s; the sum over all parts must be radius + 1.
    """
    total = radius + 1
    best = np.full((len(fps), total + 1), np.inf)
    best[:, 0] = 0.0
    picks = []
    for part in parts:
        near = np.cumsum(_differences(fps, part, p, radius), axis=1)
        cost = np.zeros((len(fps), total + 1))
        for t in range(radius + 1):
            cost[:, t + 1] = PROBE_COST * _ball(len(part), t) + CANDIDATE_COST * n * near[:, t]
        options = np.full((len(fps), total + 1, total + 1), np.inf)  # [:, s, c]: c spent on this part
        for s in range(total + 1):
            for c in range(s + 1):
                options[:, s, c] = best[:, s - c] + cost[:, c]
        picks.append(options.argmin(axis=2))
        best = options.min(axis=2)
    chosen = np.zeros((len(fps), len(parts)), np.int64)
    s = np.full(len(fps), total)
    for i in range(len(parts) - 1, -1, -1):
        chosen[:, i] = picks[i][np.arange(len(fps)), s]
        s = s - chosen[:, i]
    return chosen - 1, best[:, total]


def _part_values(fps: np.ndarray, part: np.ndarray) -> np.ndarray:
    out = np.zeros(len(fps), np.uint64)
    for k, b in enumerate(part):
        out |= ((fps >> b) & np.uint64(1)) << np.uint64(k)
    return out


def _keys(fps: np.ndarray, parts: list[np.ndarray], chosen: np.ndarray) -> Iterator[tuple]:
    """(part, values, fingerprints): each fingerprint's own part values and its probes."""
    for i, part in enumerate(parts):
        own = _part_values(fps, part)
        yield i, own, fps
        for t in range(1, int(chosen[:, i].max(initial=-1)) + 1):
            some = chosen[:, i] >= t
            for flips in itertools.combinations(range(len(part)), t):
                mask = np.uint64(sum(1 << f for f in flips))
                yield i, own[some] ^ mask, fps[some]


def _forest(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """Spanning forest (root, member) of the links among ``fps``."""
    n = len(fps)
    if n <= 24:
        values, root = fps.tolist(), list(range(n))
        for a in range(n):
            for b in range(a + 1, n):
                if root[a] != root[b] and (values[a] ^ values[b]).bit_count() <= radius:
                    low, high = min(root[a], root[b]), max(root[a], root[b])
                    root = [low if r == high else r for r in root]
        yield from ((values[r], values[k]) for k, r in enumerate(root) if r != k)
        return
    open_ = np.ones(n, bool)
    for a in range(n):
        if not open_[a]:
            continue
        open_[a] = False
        front = np.array([a])
        while len(front):
            rest = np.flatnonzero(open_)
            if not len(rest):
                break
            hit = np.zeros(len(rest), bool)
            for f in front:
                hit |= np.bitwise_count(fps[rest] ^ fps[f]) <= radius
            front = rest[hit]
            open_[front] = False
            yield from ((int(fps[a]), int(fps[m])) for m in front)


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) between distinct fingerprints ``nodes`` (fp) whose transitive
    closure equals that of all pairs within ``radius`` bits."""
    n, both = _pair_counts(nodes)
    p = np.diag(both) / max(n, 1)
    # Part count by the cost of an average fingerprint; each count finds the same links.
    typical = np.array([int((1 << np.arange(BITS, dtype=np.uint64))[p > 0.5].sum(dtype=np.uint64))], np.uint64)
    plans = [plan_parts(n, both, m) for m in range(1, radius + 2)]
    costs = [float(thresholds(typical, plan, np.full(BITS, 0.5), n, radius)[1][0]) for plan in plans]
    parts = plans[int(np.argmin(costs))]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy().view(np.uint64)
            for k in range(0, len(every), 16384):
                fps = every[k:k + 16384]
                chosen, _ = thresholds(fps, parts, p, n, radius)
                for i, values, owners in _keys(fps, parts, chosen):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(values), i, np.int32)), pa.array(values.view(np.int64)),
                         pa.array(owners.view(np.int64))], names=["part", "value", "fp"])

    keys = nodes.select("fp").mapInArrow(probe, "part int, value long, fp long")
    size = keys.groupBy("part", "value").agg(F.count("*").alias("n")).where("n > 1").select(
        F.col("part").alias("part2"), F.col("value").alias("value2"), F.ceil(F.col("n") / BLOCK).alias("blocks"))
    keys = keys.join(size, (F.col("part") == F.col("part2")) & (F.col("value") == F.col("value2")))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    keys = keys.withColumn("own", own).withColumn("other", other)
    groups = (keys.groupBy("part", "value", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
              .agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1).select("fps"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            values, at = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
            found = [e for s, t in zip(at[:-1], at[1:]) for e in _forest(values[s:t], radius)]
            if found:
                got = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(got[:, 0]), pa.array(got[:, 1])], names=["a", "b"])

    return groups.mapInArrow(verify, "a long, b long").distinct()


def _grouped(rows: DataFrame, radius: int) -> DataFrame:
    """(fp, rep): for every fingerprint of ``rows`` (_k, fp) the least (key, fp) of its component."""
    first = F.min_by(F.struct("_k", "fp"), F.struct(F.col("_k").isNull(), F.col("_k"), F.col("fp")))
    nodes = pin(rows.groupBy("fp").agg(first.alias("first")))
    roots = pin(component_roots(links(nodes, radius)))
    linked = nodes.join(roots, F.col("fp") == F.col("node"))
    order = F.struct(F.col("first._k").isNull(), F.col("first._k"), F.col("first.fp"))
    reps = linked.groupBy("root").agg(F.min_by("first", order).alias("rep")).withColumnRenamed("root", "root2")
    named = roots.join(reps, F.col("root") == F.col("root2")).select("node", "rep")
    return nodes.join(named, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("rep", "first").alias("rep"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS) -> DataFrame:
    """(key, fingerprint, component_id) for every row: 16 hex digits, least key of the component."""
    rows = df.select(col(key).alias("_k"), col(text).alias("_t"))
    rows = pin(with_fingerprint(rows, "_t", "fp", shingle).select("_k", "fp"))
    groups = _grouped(rows, radius).withColumnRenamed("fp", "fp2")
    return rows.join(groups, F.col("fp") == F.col("fp2")).select(
        F.col("_k").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("rep._k").alias("component_id"))


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """The rows of ``df`` with one row left of each component: that of its least key."""
    rows = df.select(col(key).alias("_k"), col(text).alias("_t"))
    rows = pin(with_fingerprint(rows, "_t", "fp", shingle).select("_k", "fp"))
    kept = _grouped(rows, radius).select(F.col("rep._k").alias("_k2"), F.col("rep.fp").alias("_fp2")).distinct()
    inner, (k, t) = numbered(df, key, text)
    marked = with_fingerprint(inner, t, "_fp", shingle)
    found = marked.join(kept, F.col(k).eqNullSafe(F.col("_k2")) & (F.col("_fp") == F.col("_fp2")), "left_semi")
    return found.dropDuplicates([k, "_fp"]).drop("_fp").toDF(*df.columns)
