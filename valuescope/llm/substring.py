"""Substring dedup by sliding sentence spans.

A text is cut into sentences; from every sentence a span runs over the following
ones until it holds at least ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words. The
128-bit hashes of all spans (words only, so white space does not matter) are joined
over the whole corpus. The first occurrence of a span, by (key, position), stays; the
sentences that any other occurrence covers are cut out of their text. What remains is
kept character by character, so a text without repeats does not change.

Sentences end after . ! ? (and their full-width forms) before white space, and at line
ends. Inside them a cut falls after the word of least hash of every ``WINDOW`` words in
a row that hold no sentence end. So no part has more than ``WINDOW`` words, and where a
cut falls depends on fewer than ``WINDOW`` words to either side, not on where the
sentence began: two texts that share 3 * WINDOW + MIN_WORDS - 1 = 49 words in a row
share a span, wherever in their sentences the words start and end. "Sentence" below
means such a part.

Scale: spans are a few per hundred characters and cross one shuffle; nothing else of
their number is written. Each partition is sorted by span first and keeps one row of a
span to be compared with the other partitions', so a passage in a third of all documents
is a row a task there; its other places are known repeats and are dealt out by document.
Only the spans to cut are written and travel back to their documents, and the texts
cross one shuffle.

Defined cases: a null text stays null, an empty one empty; a text wholly covered
becomes empty, its row stays; rows that repeat key and text are one document with the
same result; null keys come first, rows with equal keys but other texts are ordered by a
hash; an empty table gives an empty result; other columns are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from ..session import pin
from .common import chunked, col, numbered, tidied

MIN_SENTENCES = 2
MIN_WORDS = 20
WINDOW = 10

_END = re.compile(r"\n[\x20\x09-\x0D]*|(?<=[.!?。！？])[\x20\x09-\x0D]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _chosen(words: list[str]) -> list[int]:
    """Words of a sentence after which it is cut: the last one of least hash in every
    ``WINDOW`` words in a row before the sentence's last word."""
    hashes = [xxhash.xxh32_intdigest(w) for w in words[:-1]]
    out, at = [], -1
    for i in range(len(hashes) - WINDOW + 1):
        last = i + WINDOW - 1
        if at < i:
            held = hashes[i:last + 1][::-1]
            at = last - held.index(min(held))
        elif hashes[last] <= hashes[at]:
            at = last
        else:
            continue
        out.append(at)
    return out


def sentences(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, number of words, words joined by blanks) of every sentence; they
    cover the text without gaps, white space belongs to the sentence before it."""
    out, start = [], 0
    ends = [m.end() for m in _END.finditer(text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    for end in ends:
        words = _WORD.findall(text, start, end)
        if len(words) > WINDOW and (chosen := _chosen(words)):
            begins = [m.start() for m in _WORD.finditer(text, start, end)]
            first = 0
            for at in chosen:
                out.append((start, begins[at + 1], at + 1 - first, " ".join(words[first:at + 1])))
                start, first = begins[at + 1], at + 1
            words = words[first:]
        if start < end:
            out.append((start, end, len(words), " ".join(words)))
        start = end
    return out


def spans(parts: list[tuple[int, int, int, str]]) -> Iterator[tuple[int, int, bytes]]:
    """(first, last, hash) of the span that starts at each sentence, where one fits."""
    parts = [(i, n, s) for i, (_, _, n, s) in enumerate(parts) if n]
    end = held = 0
    for first, (i, n, _) in enumerate(parts):
        while end < len(parts) and (held < MIN_WORDS or end - first < MIN_SENTENCES):
            held += parts[end][1]
            end += 1
        if held < MIN_WORDS or end - first < MIN_SENTENCES:
            return
        run = " ".join([p[2] for p in parts[first:end]])
        yield i, parts[end - 1][0], xxhash.xxh3_128_digest(run)
        held -= n


def _span_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(_k, d, _t) -> a row for every span: _k, d, first, h1, h2."""
    for batch in chunked(batches, 2):
        owner, first, digests = [], [], []
        for i, text in enumerate(batch.column(2).to_pylist()):
            for a, _, digest in spans(sentences(text)) if text else ():
                owner.append(i)
                first.append(a)
                digests.append(digest)
        both = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
        at = pa.array(owner, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(1).take(at), pa.array(first, pa.int32()),
             pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], names=["_k", "d", "first", "h1", "h2"])


def _told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Span rows of one partition, sorted by h1, h2, _k, d, first: a span's first place in
    the partition stays as it is. The others are repeats whatever else the corpus holds;
    only their document and sentence go on: _k, d and h2 are null, h1 holds d."""
    held = None   # h1, h2, d, first of the span's first row, which may be in a batch before
    for batch in batches:
        if not batch.num_rows:
            continue
        d, first, h1, h2 = (batch.column(i).to_numpy() for i in range(1, 5))
        new = np.ones(len(h1), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        head = np.maximum.accumulate(np.where(new, np.arange(len(h1)), 0))
        home_d, home_first = d[head], first[head]
        if held and held[:2] == (h1[0], h2[0]):
            home_d[head == 0], home_first[head == 0] = held[2:]
        again = (d != home_d) | (first != home_first)
        held = h1[-1], h2[-1], home_d[-1], home_first[-1]
        known = pa.array(again)
        nothing = pa.nulls(len(again), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.compute.if_else(known, pa.scalar(None, batch.column(0).type), batch.column(0)),
             pa.compute.if_else(known, nothing, batch.column(1)), batch.column(2),
             pa.array(np.where(again, d, h1)), pa.compute.if_else(known, nothing, batch.column(4))],
            names=batch.schema.names)


def covered(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(d, cuts): the repeated spans of each document that has some, by first sentence.

    ``d`` is the hash of key and text; ``cuts`` is at most one number per sentence.
    """
    docs = df.select(col(key).alias("_k"), F.xxhash64(col(key), col(text)).alias("d"), col(text).alias("_t"))
    shape = f"_k {docs.schema['_k'].dataType.simpleString()}, d long, first int, h1 long, h2 long"
    rows = docs.mapInArrow(tidied(_span_rows), shape).sortWithinPartitions("h1", "h2", "_k", "d", "first")
    # At most one row a span and partition is left under the span's hash.
    place = F.rank().over(Window.partitionBy("h1", "h2").orderBy("_k", "d", "first"))
    again = rows.mapInArrow(tidied(_told_apart), shape).withColumn("place", place).where("h2 is null or place > 1")
    return again.groupBy(F.coalesce("d", "h1").alias("d")).agg(F.collect_set("first").alias("cuts"))


def dedup(df: DataFrame, key: str = "doc_id", text: str = "text", n_cut: str | None = None) -> DataFrame:
    """``df`` with repeated spans cut out of ``text``; ``n_cut`` names an optional
    column for the number of sentences cut."""
    cuts = pin(covered(df, key, text)).select(F.col("d").alias("_d2"), F.col("cuts").alias("_cuts2"))
    inner, (k, t) = numbered(df, key, text)
    marked = inner.withColumn("_d", F.xxhash64(F.col(k), F.col(t)))
    joined = marked.join(cuts, F.col("_d") == F.col("_d2"), "left").select(*inner.columns, "_cuts2")
    at, cut_at = df.columns.index(text), len(df.columns)
    wanted = [*inner.columns, *(["n_cut"] if n_cut else [])]
    schema = joined.drop("_cuts2").schema
    if n_cut:
        schema = schema.add("n_cut", IntegerType())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunked(batches, at):
            texts, counts = [], []
            for t, firsts in zip(batch.column(at).to_pylist(), batch.column(cut_at).to_pylist()):
                gone: set[int] = set()
                if firsts:
                    parts, starts = sentences(t), set(firsts)
                    for a, b, _ in spans(parts):
                        if a in starts:
                            gone.update(range(a, b + 1))
                    t = "".join(t[p[0]:p[1]] for i, p in enumerate(parts) if i not in gone)
                texts.append(t)
                counts.append(len(gone))
            columns = [batch.column(i) for i in range(cut_at)]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            if n_cut:
                columns.append(pa.array(counts, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=wanted)

    return joined.mapInArrow(tidied(cut), schema).toDF(*df.columns, *([n_cut] if n_cut else []))
