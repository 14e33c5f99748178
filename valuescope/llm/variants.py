"""Spelling variants: words one edit apart, and the common form each leads to.

Counting: runs of Latin letters are lower-cased (A-Z only). One in 31 pairs of document
and run, by a checksum, loses a code point at a place the checksum picks, which plants
slips of the pen at a known rate. Words of at least ``MIN_CHARS`` code points found
``MIN_COUNT`` times are the vocabulary.

Near words, by dense prefix-suffix tiling: two words differ by one inserted, deleted or
replaced code point exactly if their common prefix and common suffix together reach the
longer length minus one. A word of that length is cut into ``SEGMENTS`` segments, and the
edit lies in one of them, so the pair agrees on all before and after it: words are brought
together by (longer length, segment, text before, text after), once as the longer (or
equal) word and once as the shorter. Within such a list padded code-point matrices are
compared block against block. A pair counts only in the list of the segment in which its
common prefix ends, so every pair is found exactly once and needs no ``distinct``.

Forms: of a word's near words the most frequent (ties: the least in code-point order), if
at least ``RATIO`` times as frequent. Chains of forms end after log_RATIO(occurrences)
steps; their last word is found by pointer doubling.

Scale: counts are summed in the worker, then partially aggregated. Lists longer than
``BLOCK`` are cut into blocks, each pair of blocks is a row of its own; a task holds a
bounded number of them. Rows a word: 2 x SEGMENTS.

Defined cases: null, empty and letterless texts have no words; a null key is the empty
text in the checksum; rows repeating a key count again; an empty table, or one without
words frequent enough, gives an empty result; only key and text are read, so further
columns can't clash.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import chunked, col

MIN_CHARS = 7
MIN_COUNT = 2
RATIO = 10
SLIP = 31               # one in so many (document, run) pairs loses a code point
SEGMENTS = 3
BLOCK = 256             # words of a block; a list of more words is compared block by block
PAIRS_AT_ONCE = 1 << 19
HELD_WORDS = 1 << 17    # words a worker sums up before it hands them on
PIECE_CHARS = 1 << 20

# Latin-1 code points: letters (A-Z lower-cased) stay, all others part the runs.
_RUNS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def _utf8(run: bytes) -> bytes:
    return run if run.isascii() else run.decode("latin-1").encode()


def _pieces(text: str) -> Iterator[bytes]:
    """The runs' text in pieces of about ``PIECE_CHARS``, cut where no run is."""
    held = b""
    for start in range(0, len(text), PIECE_CHARS):
        # Code points beyond Latin-1 become "?", one each, and part runs like it.
        piece = held + text[start:start + PIECE_CHARS].encode("latin-1", "replace").translate(_RUNS)
        cut = piece.rfind(b" ") + 1
        yield piece[:cut]
        held = piece[cut:]
    yield held


def add_words(total: Counter, key: str | None, text: str | None) -> None:
    """Add the words of one document, slips included, to ``total`` (Latin-1 bytes -> count)."""
    runs: Counter = Counter()
    for piece in _pieces(text or ""):
        runs.update(piece.split())
    seed = zlib.crc32(f"{key or ''}:".encode("utf-8", "surrogatepass"))
    for run, n in runs.items():
        if len(run) >= MIN_CHARS:
            h = zlib.crc32(_utf8(run), seed)
            if h % SLIP == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
                if len(run) < MIN_CHARS:
                    continue
            total[run] += n


def word_counts(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): the vocabulary with its occurrences."""
    rows = df.select(col(key).cast("string").alias("_k"), col(text).alias("_t"))

    def handed(total: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())],
            names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for batch in chunked(batches, 1):
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                add_words(total, k, t)
            if len(total) > HELD_WORDS:
                yield handed(total)
                total = Counter()
        yield handed(total)

    counts = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= MIN_COUNT)


def _bounds(longer: int) -> list[int]:
    """Where the segments of a word of ``longer`` code points begin, and its end."""
    return [longer * q // SEGMENTS for q in range(SEGMENTS + 1)]


def _keys() -> Column:
    """(longer, q, before, after): the lists a word is in, as an array."""
    out = []
    for more in (0, 1):
        longer = F.length("word") + more
        for q in range(SEGMENTS):
            begin, end = F.floor(longer * q / SEGMENTS).cast("int"), F.floor(longer * (q + 1) / SEGMENTS).cast("int")
            out.append(F.struct(
                longer.alias("longer"), F.lit(q).alias("q"), F.substring("word", F.lit(1), begin).alias("before"),
                F.when(longer > end, F.substring("word", F.length("word") - (longer - end) + 1, longer - end))
                .otherwise("").alias("after")))
    return F.array(*out)


def _tiles(words: DataFrame) -> DataFrame:
    """(longer, q, words, own): the words of a block, or of two blocks, of a list."""
    rows = words.select("word", F.explode(_keys()).alias("k")).select("word", "k.*")
    keys = ["longer", "q", "before", "after"]
    sizes = rows.groupBy(*keys).count().where("count > 1")
    sizes = sizes.select(*[F.col(k).alias(k + "2") for k in keys], F.ceil(F.col("count") / BLOCK).alias("blocks"))
    joined = rows.join(sizes, [F.col(k) == F.col(k + "2") for k in keys]).select("word", *keys, "blocks")
    placed = joined.withColumn("own", F.pmod(F.xxhash64("word"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    tiles = placed.groupBy(*keys, F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")).agg(
        F.collect_list(F.struct("word", "own")).alias("w")).where(F.size("w") > 1)
    return tiles.select("longer", "q", F.col("w.word").alias("words"),
                        F.transform("w.own", lambda o: o == F.col("low")).alias("first"),
                        (F.col("low") == F.col("high")).alias("one"))


def _matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points padded with zeros at the end, lengths)."""
    length = np.array([len(w) for w in words])
    flat = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    # Vocabulary words are Latin-1; wider code points would need a wider matrix.
    codes = np.zeros((len(words), int(length.max()) + 1), np.uint8 if flat.max() < 256 else np.uint32)
    codes[np.arange(codes.shape[1])[None, :] < length[:, None]] = flat
    return codes, length


def single_edits(codes: np.ndarray, length: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether the words a, b are one edit apart, their common prefix) for index arrays."""
    la, lb = length[a], length[b]
    longer, shorter = np.maximum(la, lb), np.minimum(la, lb)
    width = np.arange(int(longer.max()))
    x, y = codes[a][:, :len(width)], codes[b][:, :len(width)]
    # A place beyond the shorter word never agrees.
    prefix = np.argmin(np.concatenate([(x == y) & (width < shorter[:, None]), np.zeros((len(a), 1), bool)], axis=1), axis=1)
    x = np.take_along_axis(codes[a], np.maximum(la[:, None] - 1 - width, 0), axis=1)
    y = np.take_along_axis(codes[b], np.maximum(lb[:, None] - 1 - width, 0), axis=1)
    suffix = np.argmin(np.concatenate([(x == y) & (width < shorter[:, None]), np.zeros((len(a), 1), bool)], axis=1), axis=1)
    return (longer - shorter <= 1) & (prefix + suffix >= longer - 1) & (prefix < longer), prefix


def near_words(words: DataFrame) -> DataFrame:
    """(a, b): every pair of ``words`` (word) one edit apart, once."""

    def compared(longer, q, texts: list[list[str]], first, one) -> Iterator[tuple[list[str], list[str]]]:
        """All tiles of a batch at once: one matrix, index pairs within the tiles."""
        codes, length = _matrix([w for t in texts for w in t])
        size = np.array([len(t) for t in texts])
        start = np.cumsum(size) - size
        marks = np.concatenate([np.array(f, bool) for f in first])
        names = [w for t in texts for w in t]
        held_a, held_b, held_t, held = [], [], [], 0
        for k in range(len(size) + 1):
            if held > PAIRS_AT_ONCE or (k == len(size) and held):
                a, b, tile = np.concatenate(held_a), np.concatenate(held_b), np.concatenate(held_t)
                held_a, held_b, held_t, held = [], [], [], 0
                # The longer word of the pair must have the list's length.
                fits = np.maximum(length[a], length[b]) == longer[tile]
                a, b, tile = a[fits], b[fits], tile[fits]
                if len(a):
                    near, prefix = single_edits(codes, length, a, b)
                    begin, end = longer[tile] * q[tile] // SEGMENTS, longer[tile] * (q[tile] + 1) // SEGMENTS
                    hit = np.flatnonzero(near & (prefix >= begin) & (prefix < end))
                    yield [names[i] for i in a[hit]], [names[i] for i in b[hit]]
            if k < len(size):
                if one[k]:
                    a, b = np.triu_indices(size[k], 1)
                else:
                    mark = marks[start[k]:start[k] + size[k]]
                    a, b = (x.ravel() for x in np.meshgrid(np.flatnonzero(mark), np.flatnonzero(~mark)))
                held_a.append(a + start[k])
                held_b.append(b + start[k])
                held_t.append(np.full(len(a), k))
                held += len(a)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longer, q = batch.column(0).to_numpy().astype(np.int64), batch.column(1).to_numpy().astype(np.int64)
            texts, first, one = (batch.column(i).to_pylist() for i in (2, 3, 4))
            if texts:
                for a, b in compared(longer, q, texts, first, one):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string())], names=["a", "b"])

    return _tiles(words).mapInArrow(run, "a string, b string")


def _last_forms(forms: DataFrame) -> DataFrame:
    """(word, root) of ``forms`` (word, form): the end of each chain, by pointer doubling."""
    ends = pin(forms.select("word", F.col("form").alias("root")))
    while True:
        step = ends.select(F.col("word").alias("w2"), F.col("root").alias("r2"))
        new = pin(ends.join(step, F.col("root") == F.col("w2"), "left").select(
            "word", F.coalesce("r2", "root").alias("root"), F.col("r2").isNotNull().alias("moved")))
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        ends = new.select("word", "root")


def group_variants(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary."""
    words = pin(word_counts(df, key, text))
    pairs = pin(near_words(words))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("w2"), F.col("n").alias("n2"))
    best = both.join(other, F.col("b") == F.col("w2")).groupBy(F.col("a").alias("w3")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("n2")).alias("o"), F.col("b").alias("near"))).alias("best"))
    rows = words.join(best, F.col("word") == F.col("w3"), "left")
    frequent = -F.col("best.o") >= RATIO * F.col("n")
    rows = pin(rows.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(frequent, F.col("best.near")).alias("form"),
                           F.when(frequent, -F.col("best.o")).alias("form_n")))
    ends = _last_forms(rows.where("form is not null")).withColumnRenamed("word", "w4")
    return rows.join(ends, F.col("word") == F.col("w4"), "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
