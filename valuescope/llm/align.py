"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes.

Tokenizer A is a byte-level BPE, B a SentencePiece BPE with byte fallback. Each text,
with one space before it, is cut into tokens by both. Where tokens of both end at the
same byte, a group ends; tokens whose byte ranges overlap are linked.

Lockstep: one state vector holds, for every open text stretch of a batch, the place of
its current A token and its current B token. Each step links the two current tokens of
all stretches at once, moves on the token that ends first (both where they end together,
which is a cut) and drops the finished stretches. A stretch begins at a space between two
characters that are no white space: both tokenizers always end a token there (no piece of
B holds a space but at its front, checked when it is loaded), so stretches of one spelling
are merged once, and the merge of a very long text takes no more steps than its longest
stretch has tokens.

Corpus counts: every document is reduced to its distinct pairs of ids with their
numbers of links; they are summed by pair, partially aggregated, and met again by a join
in which the pair table is broadcast only if small (``bounded_broadcast``).

Defined cases: null and empty texts, and those whose tokens don't spell the space and the
text again (U+2581, which B takes for a space), have no tokens: zeros and ''. Special
tokens' strings are plain text. Rows repeating a key are counted again; null keys stay;
an empty table gives an empty result; only key and text are read, so further columns
can't clash.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.skew import bounded_broadcast
from ..session import pin
from .common import chunked, col

MODEL_A = "/opt/tokenizers/byte_bpe_50k.json"
MODEL_B = "/opt/tokenizers/piece_bpe_32k.model"
HELD_STRETCHES = 1 << 18   # merged stretches a worker keeps
# Fixed value: how byte-level BPE parts a text before merging.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

_START = re.compile(r"(?<=\S) (?=\S)")
# Characters on whose class (letter, digit, space) all Unicode versions agree.
_SETTLED = re.compile(r"[\n\t -~¡-ɏ]*")


def _byte_of_char() -> dict[str, int]:
    """Byte-level BPE writes printable bytes as themselves, the others from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers of a worker, with the bytes of every id."""

    def __init__(self, model_a: str = MODEL_A, model_b: str = MODEL_B):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(model_a)
        self.a.encode_special_tokens = True
        byte_of = _byte_of_char()
        with open(model_a, encoding="utf-8") as f:
            described = json.load(f)
        special = {t["id"] for t in described.get("added_tokens", [])}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = token.encode() if i in special else bytes(byte_of[c] for c in token)
        # Ids in order of merging are ranks, which the faster encoder takes.
        ranks = {b: i for i, b in enumerate(self.bytes_a) if b and i not in special}
        merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in described["model"]["merges"]]
        in_order = all(vocab[m] == 256 + k for k, m in enumerate(merges))
        self.fast = tiktoken.Encoding("a", pat_str=PRE_TOKEN, mergeable_ranks=ranks, special_tokens={}) if in_order else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=model_b)
        self.bytes_b = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {piece!r} spans the start of a word")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.size_a = np.array([len(b) for b in self.bytes_a])
        self.size_b = np.array([len(b) for b in self.bytes_b])
        # What a token adds to the groups: its id and what follows, in a group and at its end.
        self.shown = ([f"{i}{end}" for i in range(len(self.size_a)) for end in ",|"]
                      + [f"{i}{end}" for i in range(len(self.size_b)) for end in ",;"])

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        out: list[list[int] | None] = [
            self.fast.encode_ordinary(t) if self.fast and _SETTLED.fullmatch(t) else None for t in texts]
        rest = [k for k, ids in enumerate(out) if ids is None]
        for k, found in zip(rest, self.a.encode_batch([texts[k] for k in rest], add_special_tokens=False)):
            out[k] = found.ids
        return out

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """Texts begin with a space; the tokenizer adds that space itself."""
        return self.b.encode([t[1:] for t in texts], num_threads=1) if texts else []


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(all ids, where each row begins and the last ends)."""
    at = np.zeros(len(rows) + 1, np.int64)
    np.cumsum([len(r) for r in rows], out=at[1:])
    return np.fromiter(chain.from_iterable(rows), np.int64, int(at[-1])), at


def lockstep(size_a: np.ndarray, at_a: np.ndarray, size_b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links (stretch, A place, B place, whether both tokens end there) of all stretches.

    ``size_*`` are the byte lengths of the tokens of one stretch after another, those of
    stretch u at places at_*[u] to at_*[u + 1]. Both cover the same bytes.
    """
    open_ = np.flatnonzero(at_a[1:] > at_a[:-1])
    a, b = at_a[open_].copy(), at_b[open_].copy()
    last = at_a[open_ + 1]
    end_a, end_b = size_a[a], size_b[b]
    found = []
    while len(open_):
        step_a, step_b = end_a <= end_b, end_b <= end_a
        found.append((open_, a, b, step_a & step_b))
        a, b = a + step_a, b + step_b
        left = np.flatnonzero(a < last) if step_a.any() else np.arange(len(a))
        open_, a, b, last = open_[left], a[left], b[left], last[left]
        end_a = end_a[left] + np.where(step_a[left], size_a[a], 0)
        end_b = end_b[left] + np.where(step_b[left], size_b[b], 0)
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    unit, a, b, cut = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(unit, kind="stable")  # steps of a stretch stay in order
    return unit[order], a[order], b[order], cut[order]


def group_texts(tok: Tokenizers, flat_a: np.ndarray, flat_b: np.ndarray, last_a: np.ndarray, last_b: np.ndarray,
                tokens: np.ndarray) -> list[str]:
    """The groups of each stretch as text, each group with ``;`` behind it.

    ``last_*``: the places of the groups' last tokens; ``tokens``: how many tokens of both
    kinds each stretch has. A group shows its A tokens, then its B tokens.
    """
    size_a, size_b = np.diff(last_a, prepend=-1), np.diff(last_b, prepend=-1)
    shown = np.zeros(len(flat_a) + len(flat_b), np.int64)
    # An A token comes after all B tokens of the groups before, a B token after its group's A tokens.
    at_a = np.arange(len(flat_a)) + np.repeat(last_b + 1 - size_b, size_a)
    at_b = np.arange(len(flat_b)) + np.repeat(last_a + 1, size_b)
    shown[at_a], shown[at_b] = 2 * flat_a, 2 * (flat_b + len(tok.size_a))
    shown[at_a[last_a]] += 1
    shown[at_b[last_b]] += 1
    parts = list(map(tok.shown.__getitem__, shown.tolist()))
    ends = np.cumsum(tokens).tolist()
    return ["".join(parts[i:j]) for i, j in zip([0, *ends], ends)]


class Merged:
    """Stretches merged so far, as one row each: numbers, groups and linked pairs."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.row: dict[str, int] = {}
        self.groups: list[str] = []
        self.ok = np.zeros(0, bool)
        self.counts = np.zeros((0, 4), np.int64)   # A tokens, B tokens, groups, links
        self.at = np.zeros(1, np.int64)
        self.pairs = np.zeros(0, np.int64)

    def add(self, stretches: list[str]) -> None:
        """Merge new stretches (distinct, each begins with a space)."""
        tok = self.tok
        ids_a, ids_b = tok.encode_a(stretches), tok.encode_b(stretches)
        ok = np.array([b"".join([tok.bytes_a[i] for i in x]) == t and b"".join([tok.bytes_b[i] for i in y]) == t
                       for t, x, y in zip((s.encode("utf-8", "surrogatepass") for s in stretches), ids_a, ids_b)], bool)
        ids_a, ids_b = ([r if k else [] for r, k in zip(x, ok)] for x in (ids_a, ids_b))
        flat_a, at_a = _flat(ids_a)
        flat_b, at_b = _flat(ids_b)
        unit, a, b, cut = lockstep(tok.size_a[flat_a], at_a, tok.size_b[flat_b], at_b)
        n = len(stretches)
        links = np.bincount(unit, minlength=n)
        counts = np.stack([np.diff(at_a), np.diff(at_b), np.bincount(unit[cut], minlength=n), links], axis=1)
        self.groups += group_texts(tok, flat_a, flat_b, a[cut], b[cut], counts[:, 0] + counts[:, 1])
        for s in stretches:
            self.row[s] = len(self.row)
        self.ok = np.concatenate([self.ok, ok])
        self.counts = np.concatenate([self.counts, counts])
        self.at = np.concatenate([self.at, self.at[-1] + np.cumsum(links)])
        self.pairs = np.concatenate([self.pairs, (flat_a[a] << 32) | flat_b[b]])


def stretches(text: str) -> list[str]:
    """A space and the text, cut before every space between two other characters."""
    first, *rest = _START.split(" " + text)
    return [first, *(" " + r for r in rest)]


def _spelled(tok: Tokenizers, text: str) -> bool:
    """Whether the tokens of both, over the whole text, spell it."""
    whole = " " + text
    want = whole.encode("utf-8", "surrogatepass")
    return (b"".join([tok.bytes_a[i] for i in tok.encode_a([whole])[0]]) == want
            and b"".join([tok.bytes_b[i] for i in tok.encode_b([whole])[0]]) == want)


def align_texts(texts: list[str | None], merged: Merged) -> tuple[list, ...]:
    """(counts (n, 4), sha256 of the groups, distinct pairs, their links) of every text."""
    cut = [stretches(t) if t else [] for t in texts]
    merged.add(list(dict.fromkeys(s for c in cut for s in c if s not in merged.row)))
    counts = np.zeros((len(texts), 4), np.int64)
    digests, units, owners = [], [], []
    for k, c in enumerate(cut):
        rows = np.fromiter(map(merged.row.__getitem__, c), np.int64, len(c))
        if len(c) and not merged.ok[rows].all():
            # A stretch isn't spelled; were the whole text, it would be one stretch.
            if _spelled(merged.tok, texts[k]):
                merged.add([" " + texts[k]] if " " + texts[k] not in merged.row else [])
                rows = np.array([merged.row[" " + texts[k]]])
            else:
                rows = rows[:0]
        counts[k] = merged.counts[rows].sum(axis=0)
        groups = "".join([merged.groups[i] for i in rows.tolist()])[:-1]
        digests.append(hashlib.sha256(groups.encode()).hexdigest() if len(rows) else "")
        units.append(rows)
        owners.append(np.full(len(rows), k))
    if not units:
        return counts, digests, [], []
    unit, owner = np.concatenate(units), np.concatenate(owners)
    # Distinct stretches of each text first, then their pairs.
    seen, times = np.unique((owner << 32) | unit, return_counts=True)
    unit, owner = seen & 0xFFFFFFFF, seen >> 32
    size = merged.at[unit + 1] - merged.at[unit]
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    pair = merged.pairs[np.repeat(merged.at[unit], size) + inside]
    owner, times = np.repeat(owner, size), np.repeat(times, size)
    order = np.lexsort((pair, owner))
    pair, owner, times = pair[order], owner[order], times[order]
    new = np.ones(len(pair), bool)
    new[1:] = (pair[1:] != pair[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    total = np.add.reduceat(times, first) if len(first) else times
    bounds = np.searchsorted(owner[first], np.arange(len(texts) + 1))
    pair = pair[first]
    return (counts, digests, [pair[a:b] for a, b in zip(bounds[:-1], bounds[1:])],
            [total[a:b] for a, b in zip(bounds[:-1], bounds[1:])])


def aligned(df: DataFrame, key: str = "doc_id", text: str = "text", model_a: str = MODEL_A,
            model_b: str = MODEL_B) -> DataFrame:
    """(_k, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times) of every row; a pair
    is A id x 2^32 + B id, ``times`` how many links of the text hold it."""
    rows = df.select(col(key).alias("_k"), col(text).alias("_t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = Tokenizers(model_a, model_b)
        merged = Merged(tok)
        for batch in chunked(batches, 1):
            if len(merged.row) > HELD_STRETCHES:
                merged = Merged(tok)
            counts, digests, pairs, times = align_texts(batch.column(1).to_pylist(), merged)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(counts[:, i]) for i in range(4)), pa.array(digests, pa.string()),
                 pa.array(pairs, pa.list_(pa.int64())), pa.array(times, pa.list_(pa.int64()))],
                names=["_k", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])

    kind = dict(rows.dtypes)["_k"]
    return rows.mapInArrow(run, f"_k {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
                                "pairs array<long>, times array<long>")


def pair_counts(rows: DataFrame) -> DataFrame:
    """(pair, links, best): corpus-wide links of every id pair, and whether no other pair
    of its B id has more."""
    links = rows.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("p.*")
    counts = pin(links.groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("links")))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    tops = counts.groupBy(F.col("b").alias("b2")).agg(F.max("links").alias("top"))
    return counts.join(tops, F.col("b") == F.col("b2")).select("pair", "links", (F.col("links") == F.col("top")).alias("best"))


def align(df: DataFrame, key: str = "doc_id", text: str = "text", model_a: str = MODEL_A,
          model_b: str = MODEL_B) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    rows = pin(aligned(df, key, text, model_a, model_b)).withColumn("rid", F.monotonically_increasing_id())
    counts = bounded_broadcast(pair_counts(rows))
    links = rows.select("rid", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("rid", "p.*")
    sums = links.join(counts, F.col("pairs") == F.col("pair")).groupBy(F.col("rid").alias("rid2")).agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("links")).alias("count_sum"))
    return rows.join(sums, F.col("rid") == F.col("rid2"), "left").select(
        F.col("_k").alias(key), "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
