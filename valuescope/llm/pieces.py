"""SentencePiece encoding with sampled segmentations, and lossless decoding.

Every way to cut a text into vocabulary pieces is a path through a lattice. Forward
filtering sums the weights of all paths up to each character; backward sampling walks
from the end and draws each piece with its exact conditional probability. The random
numbers are a hash of a seed, the row key and the place in the text, so a row is cut
the same way on every run, whatever task it is in.

No piece spans the start of a word (a blank after something else) or a line end, so the
lattice falls apart there: the filter runs once for each distinct word of a chunk of
text, and only the drawing runs for every occurrence. All of it is numpy over arrays.

A byte-pair model has no piece probabilities; a piece of rank r weighs 1 / (r + SHIFT)
to the power ``alpha`` (the vocabulary is in order of merging). Characters that are no
piece are spelled in bytes, and so is a literal U+2581, which stands for a blank in the
pieces: decoding returns exactly the text that was encoded.

Defined cases: a null text gives null ids and decodes to null, an empty one gives no
ids; rows with equal key and text are cut alike; a null key is a key; words of more than
``LONG_WORD`` characters (unbroken scripts, encoded data) are filtered and drawn character
by character with one number kept for each; an empty table gives an empty result; only the
named columns are read.
"""

from __future__ import annotations

import itertools
import math
import re
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunked, col, spare_name, tidied

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.0
SHIFT = 10.0
SEED = 17
BLANK = 0x2581
LITERAL = 0x110000       # stands for U+2581 itself: no piece holds it
GROUP_CELLS = 1 << 16    # characters filtered at once
LONG_WORD = 256          # longer words are walked one by one
TEXT_BYTES = 2 << 20     # text of one chunk: words that repeat in it are filtered once
_SEGMENT = re.compile(r"\n| +[^ \n]*|[^ \n]+")
_M = np.uint64(0x9E3779B97F4A7C15)


def load(model_file: str = MODEL, alpha: float = ALPHA) -> dict:
    """Vocabulary tables of a SentencePiece model with byte fallback (a fixed size)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n = sp.get_piece_size()
    text: list[bytes] = [b""] * n
    byte_ids = np.zeros(256, np.int32)
    keys, ids, weights, longest = [], [], [], 1
    for i in range(n):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[3:5], 16)
            byte_ids[value], text[i] = i, bytes([value])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            if "▁" in piece.lstrip("▁") or "\n" in piece:
                raise ValueError(f"piece {piece!r} spans the start of a word or a line end")
            codes = [ord(c) for c in piece]
            keys.append(codes)
            ids.append(i)
            weights.append(-alpha * np.log(len(ids) + SHIFT))
            longest = max(longest, len(codes))
            text[i] = piece.replace("▁", " ").encode()
    hashes = np.array([_hash_codes(k) for k in keys], np.uint64)
    order = np.argsort(hashes)
    size = np.array([len(t) for t in text], np.int64)
    table = {"".join(map(chr, k)): (i, w) for k, i, w in zip(keys, ids, weights)}
    return {"table": table, "hashes": hashes[order], "ids": np.array(ids, np.int32)[order], "weights": np.array(weights)[order],
            "longest": longest, "byte_ids": byte_ids, "byte_weight": -alpha * np.log(n + SHIFT),
            "bytes": np.frombuffer(b"".join(text), np.uint8), "size": size, "start": np.cumsum(size) - size}


def _hash_codes(codes: list[int]) -> int:
    h = 0
    for c in codes:
        h = (h * int(_M) + c + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _utf8(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the code points one after another, bytes of each)."""
    text = "".join(chr(c) for c in np.where(codes == LITERAL, BLANK, codes))
    n = 1 + (codes >= 0x80) + (codes >= 0x800) + ((codes >= 0x10000) & (codes != LITERAL))
    return np.frombuffer(text.encode(), np.uint8), n.astype(np.int64)


def _pieces_at(codes: np.ndarray, left: np.ndarray, vocab: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per piece length 1, 2, ...: the places of ``codes`` where such a piece starts and
    its rank in the tables; ``left`` is how many characters a place's word has from there."""
    out = []
    at, h = np.arange(len(codes)), np.zeros(len(codes), np.uint64)
    for k in range(vocab["longest"]):
        if k:
            # Only runs that may go on to a piece are followed.
            at, h = at[on], h[on]
            on = left[at] > k
            at, h = at[on], h[on]
        h = h * _M + codes[at + k] + np.uint64(1)
        kind = vocab["filter"][h >> np.uint64(42)]
        maybe = np.flatnonzero(kind & 1)
        rank = np.searchsorted(vocab["hashes"], h[maybe]).clip(0, len(vocab["hashes"]) - 1)
        hit = vocab["hashes"][rank] == h[maybe]
        out.append((at[maybe[hit]], rank[hit]))
        on = np.flatnonzero(kind & 2)
    return out


def _filtered(found: list[tuple[np.ndarray, np.ndarray]], row: np.ndarray, place: np.ndarray, length: np.ndarray,
              vocab: dict) -> tuple[np.ndarray, np.ndarray]:
    """Forward filter of segments of the lengths ``length`` (n): ``found`` has their pieces
    as (character, rank) by piece length, ``row`` and ``place`` say where a character is.

    Returns cumulative chances (width + 1, n, longest) of the piece lengths 1, 2, ...
    that end at a place, and the id of the piece of each length that starts at a place
    (n, width, longest; -1: spelled in bytes).
    """
    n, width = len(length), int(length.max())
    longest = max([k for k, (at, _) in enumerate(found, 1) if len(at)], default=1)
    ids = np.full((n, width, longest), -1, np.int32)
    # By the end of the piece, so that one step reads a stretch of memory.
    weight = np.full((width + 1, longest, n), -np.inf)
    weight[1:, 0][np.arange(width)[:, None] < length] = vocab["byte_weight"]
    for k, (at, rank) in enumerate(found[:longest]):
        rows, cols = row[at], place[at]
        ids[rows, cols, k] = vocab["ids"][rank]
        weight[cols + k + 1, k, rows] = vocab["weights"][rank]
    total = np.full((width + 1, n), -np.inf)
    total[0] = 0.0
    chances = np.full((width + 1, n, longest), 2.0)
    for j in range(1, width + 1):
        m = min(longest, j)
        # Pieces of length 1..m that end at j: starts j-1 .. j-m.
        paths = total[j - m:j][::-1] + weight[j, :m]
        top = paths.max(axis=0)
        safe = np.where(np.isfinite(top), top, 0.0)
        paths -= safe
        part = np.cumsum(np.exp(paths, out=paths), axis=0, out=paths)
        with np.errstate(divide="ignore", invalid="ignore"):
            total[j] = safe + np.log(part[-1])
            chances[j, :, :m] = (part / part[-1]).T
    return chances, ids


def _drawn(chances: np.ndarray, ids: np.ndarray, length: np.ndarray, unit: np.ndarray,
           key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Backward sampling: (occurrence, start, piece id) of the pieces of every occurrence;
    ``unit`` is its segment, ``key`` its random key."""
    place = length[unit].copy()
    active = np.flatnonzero(place > 0)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(active):
        draw = (_mix(key[active] + place[active].astype(np.uint64) * _M) >> np.uint64(11)) * 2.0 ** -53
        u, j = unit[active], place[active]
        # The first length whose cumulative chance exceeds the draw; rounding at the
        # upper end falls back to the longest with a chance.
        row = chances[j, u]
        size = (row <= draw[:, None]).sum(axis=1) + 1
        size = np.minimum(size, np.minimum(row.shape[1], j))
        out.append((active, j - size, ids[u, j - size, size - 1]))
        place[active] = j - size
        active = active[place[active] > 0]
    if not out:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*out))


def _walked(word: str, vocab: dict, keys: list[int]) -> list[tuple[list[int], list[int]]]:
    """(starts, piece ids) of one long word for each random key: filtered and drawn like
    ``_filtered`` and ``_drawn``, with the pieces looked up again where the walk back comes by."""
    table, longest, spelled = vocab["table"], vocab["longest"], (-1, vocab["byte_weight"])
    word = word.replace("▁", "\0").replace(" ", "▁")  # a literal blank mark is in no piece
    n = len(word)
    total = array("d", [-math.inf]) * (n + 1)
    total[0] = 0.0
    for s in range(n):
        at = total[s]
        for k in range(1, min(longest, n - s) + 1):
            found = table.get(word[s:s + k]) or (spelled if k == 1 else None)
            if found:
                new, old = at + found[1], total[s + k]
                top, low = (new, old) if new > old else (old, new)
                total[s + k] = top + math.log1p(math.exp(low - top))
    out = []
    for key in keys:
        starts, ids, j = [], [], n
        while j:
            draw = float(_mix(np.uint64([(key + j * int(_M)) & 0xFFFFFFFFFFFFFFFF]))[0] >> np.uint64(11)) * 2.0 ** -53
            chance, pick = 0.0, None
            for k in range(1, min(longest, j) + 1):
                found = table.get(word[j - k:j]) or (spelled if k == 1 else None)
                if found:
                    pick = (j - k, found[0])
                    chance += math.exp(total[j - k] + found[1] - total[j])
                    if chance > draw:
                        break
            j = pick[0]
            starts.append(j)
            ids.append(pick[1])
        out.append((starts, ids))
    return out


def encode_texts(texts: list[str | None], keys: np.ndarray, vocab: dict, seed: int = SEED) -> list[np.ndarray | None]:
    """Sampled piece ids of each text; ``keys`` (uint64) seed the rows."""
    words, owner, number = [], [], []
    for i, text in enumerate(texts):
        if text:
            found = _SEGMENT.findall(" " + text)
            words += found
            owner.append(np.full(len(found), i))
            number.append(np.arange(len(found)))
    if not words:
        return [None if t is None else np.zeros(0, np.int32) for t in texts]
    unit_of: defaultdict[str, int] = defaultdict(itertools.count().__next__)
    unit = np.fromiter(map(unit_of.__getitem__, words), np.int64, len(words))
    names = list(unit_of)
    owner, number = np.concatenate(owner), np.concatenate(number)
    key = _mix(keys[owner] + _mix(np.uint64(seed) + number.astype(np.uint64) * _M))
    length = np.array([len(s) for s in names])
    codes = np.frombuffer("".join(names).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    codes = np.where(codes == BLANK, np.uint64(LITERAL), np.where(codes == 32, np.uint64(BLANK), codes))
    begin = np.cumsum(length) - length
    by_length = np.argsort(length, kind="stable")
    slot_of = np.zeros(len(names), np.int64)
    occurrences = np.argsort(unit)
    first_use = np.append(0, np.cumsum(np.bincount(unit)))
    found = []
    k = 0
    while k < len(by_length):
        # Segments of like length (up to a quarter more) share a padded array.
        low = length[by_length[k]]
        if low > LONG_WORD:
            one = by_length[k]
            uses = occurrences[first_use[one]:first_use[one + 1]]
            for use, (starts, ids) in zip(uses, _walked(names[one], vocab, key[uses].tolist())):
                found.append((np.full(len(ids), use), np.array(starts, np.int64), np.array(ids, np.int64)))
            k += 1
            continue
        end = np.searchsorted(length[by_length], max(low + low // 4, low), side="right")
        end = min(end, k + max(1, GROUP_CELLS // (low + low // 4)),
                  max(k + 1, np.searchsorted(length[by_length], LONG_WORD, side="right")))
        group = by_length[k:end]
        size = length[group]
        row = np.repeat(np.arange(len(group)), size)
        place = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
        starts = _pieces_at(codes[begin[group][row] + place], size[row] - place, vocab)
        chances, ids = _filtered(starts, row, place, size, vocab)
        count = first_use[group + 1] - first_use[group]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        uses = occurrences[np.repeat(first_use[group], count) + within]
        slot_of[group] = np.arange(len(group))
        occ, start, piece = _drawn(chances, ids, length[group], slot_of[unit[uses]], key[uses])
        found.append((uses[occ], start, piece))
        k = end
    occ, start, piece = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(occ * (int(length.max()) + 1) + start)
    occ, start, piece = occ[order], start[order], piece[order]
    # Characters that are no piece: one id per byte.
    spelled = np.flatnonzero(piece < 0)
    if len(spelled):
        data, count = _utf8(codes[begin[unit[occ[spelled]]] + start[spelled]])
        repeat = np.ones(len(piece), np.int64)
        repeat[spelled] = count
        at = np.cumsum(repeat) - repeat
        out = np.repeat(piece, repeat)
        within = np.arange(len(data)) - np.repeat(np.cumsum(count) - count, count)
        out[np.repeat(at[spelled], count) + within] = vocab["byte_ids"][data]
        rows = np.repeat(owner[occ], repeat)
    else:
        out, rows = piece, owner[occ]
    cuts = np.searchsorted(rows, np.arange(len(texts) + 1))
    return [None if t is None else out[a:b].astype(np.int32) for t, a, b in zip(texts, cuts[:-1], cuts[1:])]


def decode_ids(ids: list[np.ndarray | None], vocab: dict) -> list[str | None]:
    """The text of each row of piece ids."""
    out: list[str | None] = []
    for row in ids:
        if row is None:
            out.append(None)
            continue
        size, start = vocab["size"][row], vocab["start"][row]
        at = np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())
        text = vocab["bytes"][at].tobytes().decode("utf-8", "replace")
        out.append(text[1:] if text.startswith(" ") else text)
    return out


def _prepared(vocab: dict) -> dict:
    """``vocab`` with the filter that most character runs fail, by 22 bits of the hash:
    1 for pieces, 2 for what longer pieces begin with."""
    table = np.zeros(1 << 22, np.uint8)
    begins = {piece[:k] for piece in vocab["table"] for k in range(1, len(piece))}
    hashes = np.array([_hash_codes([ord(c) for c in s]) for s in begins] or [0], np.uint64)
    table[hashes >> np.uint64(42)] = 2
    table[vocab["hashes"] >> np.uint64(42)] |= 1
    return vocab | {"filter": table}


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", out: str = "ids", model_file: str = MODEL,
           alpha: float = ALPHA, seed: int = SEED) -> DataFrame:
    """``df`` with the sampled piece ids of ``text`` as array<int> column ``out``."""
    vocab = df.sparkSession.sparkContext.broadcast(load(model_file, alpha))
    seeded = spare_name(df, "_rowseed")
    rows = df.withColumn(seeded, F.xxhash64(F.lit(seed), col(key)))
    at, names = df.columns.index(text), [*df.columns, out]
    schema = df.withColumn(out, F.lit(None).cast("array<int>")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _prepared(vocab.value)
        for batch in chunked(batches, at, TEXT_BYTES):
            keys = batch.column(len(names) - 1).to_numpy().view(np.uint64)
            got = encode_texts(batch.column(at).to_pylist(), keys, tables, seed)
            ids = pa.array(got, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(names) - 1)] + [ids], names=names)

    return rows.mapInArrow(tidied(run), schema)


def decode(df: DataFrame, ids: str = "ids", out: str = "decoded", model_file: str = MODEL) -> DataFrame:
    """``df`` with the text of the piece ids as string column ``out``."""
    vocab = df.sparkSession.sparkContext.broadcast(load(model_file))
    at, names = df.columns.index(ids), [*df.columns, out]
    schema = df.withColumn(out, F.lit(None).cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1000):
                part = batch.slice(k, 1000)
                rows = [None if x is None else x.values.to_numpy() for x in
                        (y if y.is_valid else None for y in part.column(at))]
                texts = pa.array(decode_ids(rows, vocab.value), pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=names)

    return df.mapInArrow(run, schema)


def round_trip(df: DataFrame, key: str = "doc_id", text: str = "text", model_file: str = MODEL) -> DataFrame:
    """(key, text, ids, n_pieces, decoded, lossless) of every row."""
    vocab = df.sparkSession.sparkContext.broadcast(load(model_file))
    rows = df.select(col(key).alias("_k"), col(text).alias("_t"), F.xxhash64(F.lit(SEED), col(key)).alias("_s"))
    kinds = dict(rows.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _prepared(vocab.value)
        for batch in chunked(batches, 1, TEXT_BYTES):  # both ways in one worker
            ids = encode_texts(batch.column(1).to_pylist(), batch.column(2).to_numpy().view(np.uint64), tables, SEED)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32())),
                 pa.array(decode_ids(ids, tables), pa.string())], names=["_k", "_t", "ids", "decoded"])

    back = rows.mapInArrow(tidied(run), f"_k {kinds['_k']}, _t {kinds['_t']}, ids array<int>, decoded string")
    lossless: Column = F.col("decoded").eqNullSafe(F.col("_t"))
    return back.select(F.col("_k").alias(key), F.col("_t").alias(text), "ids",
                       F.when(F.col("ids").isNotNull(), F.size("ids")).alias("n_pieces"), "decoded",
                       lossless.alias("lossless"))
