"""Toxicity: noisy-channel deobfuscation, then a learned score of the restored text.

1. Character language model: counts of character 1- to 4-grams over the words of
   all documents, hashed to ``LM_SLOTS`` counters (a fixed size, so it can be sent to
   every task).
2. Channel: a written word with digits or symbols among its letters, separators
   between them, or letters repeated three times and more becomes a lattice -- each
   character is itself, a letter it may stand for, or nothing; a run of equal letters
   is one or two of them. Single letters written apart are joined first, also
   where punctuation stands beside them. The Viterbi
   path under language model and channel costs is the restored word. Plain words are
   their own restoration.
3. Score: each start and inner 5-gram of the restored words has a
   weight, the lower bound of its log odds in toxic against other labelled texts, so
   rare sequences count little. A word counts by its best sequence, a text by its best
   words; logistic regression turns these into a probability. Sequence weights used to
   fit the regression come from the other half of the labelled rows.

The classifier is fitted on at most ``FIT_ROWS`` labelled keys (those with the least
hash); the language model covers all documents.

Defined cases: null and empty texts score as texts without a toxic word; without
labels of both kinds every text scores the share of toxic labels; rows repeating a key
are scored each; labels that are null, or whose key is null, are not used; an empty
table gives an empty result; only key, text and the label columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunked, col, spare_name, tidied

LM_SLOTS = 1 << 18
SLOTS = 1 << 20
FIT_ROWS = 100_000
THRESHOLD = 0.7
Z = 2.5            # standard errors taken off a sequence's log odds
TOP_WORDS = 3
SHORT = 64         # texts of fewer distinct words count as of so many
CACHE = 120_000    # words a task remembers

# What a character may stand for in disguised writing.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SUBSTITUTE_COST = 1.0
KEEP_ODD_COST = 6.0     # a digit or symbol that really is one
DROP_COST = 1.5         # a separator inside a word
DOUBLE_COST = 0.5
# Words have any length: these take time in proportion to it.
_ODD = re.compile(r"[^\W\d_][\d_\W]++[^\W\d_]|[\d@$!|+(€£¡][^\W\d_]|[^\W\d_][\d@$!|+(€£¡]")
_RUN = re.compile(r"([^\W\d_])\1\1")
# A character written apart, perhaps with punctuation around it.
_SINGLE = re.compile(r"(?:[^\w\s]|_)*+[^\W_](?:[^\w\s]|_)*+(?!\S)"
                     r"|(?:[^\w\s@$!|+(€£¡]|_)*+[@$!|+(€£¡](?:[^\w\s]|_)*+(?!\S)|\S(?!\S)")
_TRAIL = re.compile(r"(?<![^\w@$!|+(€£¡])(?<!_)(?:[^\w@$!|+(€£¡]|_)++\Z")
_LEAD = re.compile(r"^(?:[^\w@$!|+(€£¡]|_)+")


# --- language model -------------------------------------------------------------

def _gram_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, index of the word) of every 1- to 4-gram of the words, with word ends."""
    line = "".join("\x02" + w + "\x03" for w in words)
    codes = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    owner = np.cumsum(codes == 2) - 1
    slots, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, 5):
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        inside = owner[: len(h)] == owner[n - 1:]
        mixed = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        slots.append((mixed >> np.uint64(46))[inside])
        owners.append(owner[: len(h)][inside])
    return np.concatenate(slots).astype(np.int64), np.concatenate(owners)


def _letters(word: str) -> str:
    """The word without the usual marks at its end if only letters are left, else ''."""
    core = word if word.isalpha() else word.rstrip(".,;:?")
    return core if core.isalpha() else ""


def _lm_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(LM_SLOTS)
    seen: Counter = Counter()

    def settle() -> None:
        counts: Counter = Counter()
        for word, n in seen.items():
            if word.isalpha():
                counts[word] += n
            elif word[0].isalpha():  # any other has no letters alone at its front
                counts[_letters(word) or _TRAIL.sub("", word)] += n
        plain = [w for w in counts if w.isalpha()]
        for k in range(0, len(plain), 20_000):
            part = plain[k:k + 20_000]
            slots, owners = _gram_slots(part)
            weights = np.array([counts[w] for w in part], float)[owners]
            np.add(total, np.bincount(slots, weights, minlength=LM_SLOTS), out=total)
        seen.clear()

    for batch in chunked(batches, 0):
        for text in batch.column(0).to_pylist():
            if text:
                seen.update(text.lower().split())
        if len(seen) >= CACHE:
            settle()
    settle()
    used = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used].astype(np.int64))], names=["slot", "n"])


def language_model(df: DataFrame, text: str = "text") -> np.ndarray:
    """Counts of the hashed 1- to 4-grams over all rows: ``LM_SLOTS`` numbers."""
    rows = df.select(col(text).alias("t")).mapInArrow(tidied(_lm_counts), "slot long, n long").groupBy("slot").agg(
        F.sum("n").alias("n")).toArrow()
    counts = np.zeros(LM_SLOTS, np.float32)
    counts[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return counts


def _slot(h: int) -> int:
    return (((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF) >> 46


class Costs:
    """-log P(character | up to three characters before) under a language model,
    interpolated over the orders; remembers what it has worked out."""

    def __init__(self, lm: np.ndarray) -> None:
        self.count = lm.item
        self.known: dict[str, dict[str, float]] = {}
        self.size = 0
        self.contexts: dict[str, list[tuple[int, float]]] = {}
        self.words = max(self.count(_slot(2)), 1.0)

    def __call__(self, context: str, c: str) -> float:
        after = self.known.get(context)
        if after is None:
            after = self.known[context] = {}
        found = after.get(c)
        if found is None:
            if self.size >= CACHE:
                self.known.clear()
                self.contexts.clear()
                self.size, after = 0, {}
                self.known[context] = after
            self.size += 1
            found = after[c] = self._cost(context, c)
        return found

    def _tails(self, context: str) -> list[tuple[int, float]]:
        """(rolling hash, count) of the last 0, 1, 2 and 3 characters, while they occur."""
        out = [(0, 8.0 * self.words)]
        for k in range(1, len(context) + 1):
            h = 0
            for c in context[len(context) - k:]:
                h = (h * 0x9E3779B97F4A7C15 + ord(c)) & 0xFFFFFFFFFFFFFFFF
            below = self.count(_slot(h))
            if below <= 0:
                break
            out.append((h, below))
        return out

    def _cost(self, context: str, c: str) -> float:
        tails = self.contexts.get(context)
        if tails is None:
            tails = self.contexts[context] = self._tails(context)
        p, own = 1e-5, 0.9
        code = ord(c)
        for h, below in tails:
            h = (h * 0x9E3779B97F4A7C15 + code) & 0xFFFFFFFFFFFFFFFF
            joint = self.count((((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF) >> 46)
            p = own * (joint / below if joint < below else 1.0) + (1.0 - own) * p
            own = 0.8
        return -math.log(max(p, 1e-12))


# --- channel --------------------------------------------------------------------

def _lattice(word: str) -> list[list[tuple[str, float]]]:
    """Per place of the written word: (what was meant, channel cost)."""
    places: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(word):
        j = i
        while j < len(word) and word[j] == word[i]:
            j += 1
        c, n = word[i], j - i
        if c.isalpha():
            if n >= 3:
                places.append([(c, 0.0), (c + c, DOUBLE_COST)])
            else:
                places += [[(c, 0.0)]] * n
        else:
            options = [("", DROP_COST if not c.isdigit() else KEEP_ODD_COST), (c, KEEP_ODD_COST)]
            options += [(s, SUBSTITUTE_COST) for s in STANDS_FOR.get(c, "")]
            places += [options] if n >= 3 else [options] * n
        i = j
    return places


def restore(word: str, cost: Costs) -> str:
    """Viterbi path through the word's lattice; states are the last three characters."""
    known = cost.known
    best: dict[str, tuple[float, tuple]] = {"\x02": (0.0, ())}     # paths as (path before, meant)
    for options in [*_lattice(word), [("\x03", 0.0)]]:
        if len(best) == 1 and len(options) == 1:
            # One path and one way on: its cost would be the same for all that follow.
            [(state, (so_far, path))], [(meant, _)] = best.items(), options
            best = {(state + meant)[-3:]: (so_far, (path, meant))}
            continue
        step: dict[str, tuple[float, tuple]] = {}
        for state, (so_far, path) in best.items():
            for meant, channel in options:
                total, context = so_far + channel, state
                for c in meant:
                    after = known.get(context)
                    found = after.get(c) if after else None
                    total += cost(context, c) if found is None else found
                    context = (context + c)[-3:]
                held = step.get(context)
                if held is None or total < held[0]:
                    step[context] = (total, (path, meant) if meant else path)
        best = step
    path, out = min(best.values(), key=lambda b: b[0])[1], []
    while path:
        path, meant = path
        out.append(meant)
    return "".join(reversed(out)).rstrip("\x03")


def single_characters(words: set[str]) -> set[str]:
    """The words that are a character written apart."""
    # A word that starts with two letters or digits is none.
    return {w for w in words if (len(w) == 1 or not (w.isalpha() or w[:2].isalnum())) and _SINGLE.match(w)}


def written_words(text: str, singles_of: Callable[[set[str]], set[str]] = single_characters) -> set[str]:
    """Distinct lower-case words; three or more single characters in a row, with or without
    punctuation around them, also joined: the whole run and its parts between punctuation."""
    words = text.lower().split()
    out = set(words)
    singles = singles_of(out)
    if singles:
        for single, run in groupby(words, singles.__contains__):
            if single and len(run := list(run)) >= 3:
                out.add("".join(run))
                part: list[str] = []
                for w in run:
                    if part and len(w) > 1 and not w[0].isalnum():
                        out.update(["".join(part)] if len(part) >= 3 else [])
                        part = []
                    part.append(w)
                    if len(w) > 1 and not w[-1].isalnum():
                        out.update(["".join(part)] if len(part) >= 3 else [])
                        part = []
                if len(part) >= 3:
                    out.add("".join(part))
    return out


def plain_word(word: str, cost: Costs) -> str:
    """The word without outer punctuation, restored where it looks disguised."""
    if word.isalpha():
        return restore(word, cost) if _RUN.search(word) else word
    core = _LEAD.sub("", _TRAIL.sub("", word))
    if not (_ODD.search(core) or _RUN.search(core)):
        return core
    return restore(core, cost)


def _runs(words: list[str]) -> np.ndarray:
    """Which words hold three equal characters in a row."""
    codes = np.frombuffer("\n".join([*words, ""]).encode("utf-32-le", "replace"), np.uint32)
    at = np.flatnonzero((codes[:-2] == codes[1:-1]) & (codes[:-2] == codes[2:])) if len(codes) > 2 else np.zeros(0, int)
    held = np.zeros(len(words), bool)
    held[np.searchsorted(np.flatnonzero(codes == 10), at)] = True
    return held


# --- score ----------------------------------------------------------------------

def sequence_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(slot, index of the word), ascending by word: the 5-grams of each word with its
    two ends marked, its starts of 5 to 7 characters, and the whole word."""
    line = "".join("\x02" + w + "\x03" for w in words)
    codes = np.frombuffer(line.encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    start = np.flatnonzero(codes == 2)
    size = np.diff(np.append(start, len(codes)))
    owner = np.repeat(np.arange(len(words)), size)
    slots, owners = [], []
    h = np.zeros(len(codes), np.uint64)
    for n in range(1, 9):
        h = h[: len(codes) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1:]
        if n == 5:
            at = np.flatnonzero(owner[: len(h)] == owner[n - 1:])
        elif n > 5:
            at = start[size >= n]
        else:
            at = start[size == n]  # shorter words: the whole
        slots.append(_scatter(h[at], n))
        owners.append(owner[at])
    slots, owners = np.concatenate(slots), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return slots[order], owners[order]


def _scatter(h: np.ndarray, n: int) -> np.ndarray:
    h = (h + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(44)).astype(np.int64)


class Words:
    """What a task remembers of the words it has met: which are single characters, the
    meaning of each written form (an index) and the sequence slots of each meaning."""

    def __init__(self, lm: np.ndarray) -> None:
        self.cost = Costs(lm)
        self.clear()

    def clear(self) -> None:
        self.tried: set[str] = set()
        self.singles: set[str] = set()
        self.meaning: dict[str, int] = {}
        self.index: dict[str, int] = {}
        self.slots = [np.zeros(0, np.int32)]
        self.count = [np.zeros(0, np.int64)]
        self.bests: dict[int, np.ndarray] = {}

    def written(self, text: str | None) -> set[str]:
        """``written_words`` of a text, each word tried as a single character once."""
        return written_words(text or "", self._singles_of)

    def _singles_of(self, words: set[str]) -> set[str]:
        new = words.difference(self.tried)
        self.tried |= new
        self.singles |= single_characters(new)
        return words & self.singles

    def meet(self, texts: list[set[str]]) -> list[np.ndarray]:
        """Indexes of the distinct meanings of each text's words."""
        if len(self.meaning) >= CACHE:
            self.clear()
        new = list(set().union(*texts).difference(self.meaning))
        index = self.index
        cores = [word if not run and word.isalpha() else (not run and _letters(word)) or plain_word(word, self.cost)
                 for word, run in zip(new, _runs(new).tolist())]
        fresh = [core for core in dict.fromkeys(cores) if core not in index]
        index.update(zip(fresh, range(len(index), len(index) + len(fresh))))
        self.meaning.update(zip(new, map(index.__getitem__, cores)))
        for k in range(0, len(fresh), 20_000):
            slots, owners = sequence_slots(fresh[k:k + 20_000])
            self.slots.append(slots.astype(np.int32))
            self.count.append(np.bincount(owners, minlength=len(fresh[k:k + 20_000])))
        known, last, out = self.meaning, np.zeros(len(self.index), np.int64), []
        for text in texts:
            ids = np.fromiter(map(known.__getitem__, text), np.int64, len(text))
            place = np.arange(len(ids))
            last[ids] = place  # of written forms with one meaning, one stays
            out.append(ids[last[ids] == place])
        return out

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """(slots of all meanings one after another, where each begins)."""
        self.slots, self.count = [np.concatenate(self.slots)], [np.concatenate(self.count)]
        return self.slots[0], np.append(0, np.cumsum(self.count[0]))

    def best(self, which: int, table: np.ndarray) -> np.ndarray:
        """The greatest weight of each meaning's sequences in a table, worked out once."""
        slots, begins = self.flat()
        have = self.bests.get(which, np.zeros(0))
        done = len(have)
        if done < len(begins) - 1:
            # Every meaning has a sequence, so each stretch of slots has a best weight.
            new = np.maximum.reduceat(table[slots[begins[done]:]], begins[done:-1] - begins[done])
            have = self.bests[which] = np.concatenate([have, new])
        return have


def _sequence_counts(batches: Iterator[pa.RecordBatch], lm: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(text, toxic, half) -> (slot, counts of labelled texts that hold a sequence)."""
    held = np.zeros((4, SLOTS), np.int32)
    last = np.zeros(SLOTS, np.int32)
    words = Words(lm)
    for batch in chunked(batches, 0):
        texts, toxic, half = (c.to_pylist() for c in batch.columns)
        met = words.meet([words.written(t) for t in texts])
        slots, begins = words.flat()
        for ids, y, h in zip(met, toxic, half):
            if len(ids):
                n = begins[ids + 1] - begins[ids]
                within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                met_slots = slots[np.repeat(begins[ids], n) + within]
                place = np.arange(len(met_slots), dtype=np.int32)
                last[met_slots] = place  # of equal slots, one counts
                held[2 * h + y, met_slots[last[met_slots] == place]] += 1
    used = np.flatnonzero(held.any(axis=0))
    for k in range(0, len(used), 100_000):
        part = used[k:k + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part)] + [pa.array(held[kind, part].astype(np.int64)) for kind in range(4)],
            names=["slot", "n0", "n1", "n2", "n3"])


def _weight(toxic: Column, other: Column, n_toxic: float, n_other: float) -> Column:
    """Lower bound of a sequence's log odds, 0 where it says nothing for toxic."""
    a, b = toxic + 0.5, other + 0.5
    odds = F.log(a / F.lit(n_toxic + 1.0)) - F.log(b / F.lit(n_other + 1.0))
    return F.greatest(F.lit(0.0), odds - F.lit(Z) * F.sqrt(1 / a + 1 / b))


def _features(texts: list[str | None], weights: list[np.ndarray], words: Words) -> list[np.ndarray]:
    """Per weight table: the best ``TOP_WORDS`` word weights of every text, and the log
    of its distinct words (the more words, the better the best is by chance)."""
    met = words.meet([words.written(t) for t in texts])
    out = []
    for which, table in enumerate(weights):
        best = words.best(which, table)
        got = np.zeros((len(texts), TOP_WORDS + 1))
        for i, ids in enumerate(met):
            got[i, -1] = np.log(max(len(ids), SHORT))
            top = best[ids]
            if len(top) > TOP_WORDS:
                top = np.partition(top, -TOP_WORDS)[-TOP_WORDS:]
            got[i, :len(top)] = np.sort(top)[::-1]
        out.append(got)
    return out


def _feature_rows(batches: Iterator[pa.RecordBatch], halves: list[np.ndarray], lm: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = Words(lm)
    for batch in chunked(batches, 0):
        texts, toxic, half = (c.to_pylist() for c in batch.columns)
        by_half = _features(texts, halves, words)
        # Weights for a row of one half were counted on the other.
        got = np.where(np.array(half)[:, None] == 0, by_half[1], by_half[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(toxic, pa.int32())] + [pa.array(got[:, i]) for i in range(got.shape[1])],
            names=["toxic"] + [f"f{i}" for i in range(got.shape[1])])


def _fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last coefficient is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    beta = np.zeros(x.shape[1])
    ridge = np.eye(x.shape[1]) * 0.1
    ridge[-1, -1] = 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


# Language model counts, sequence weights and regression: all of fixed size.
Model = tuple[np.ndarray, np.ndarray, np.ndarray]


def scores(model: Model, texts: list[str | None], words: Words) -> np.ndarray:
    _, weights, beta = model
    got = _features(texts, [weights], words)[0]
    return 1 / (1 + np.exp(-np.clip(got @ beta[:-1] + beta[-1], -30, 30)))


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          fit_rows: int = FIT_ROWS) -> Model:
    """Language model from all of ``docs``, weights and regression from its labelled rows."""
    lm = language_model(docs, text)
    marks = labels.select(col(key).alias("_k"), col(label).cast("int").alias("toxic")).where(
        "_k is not null and toxic in (0, 1)").groupBy("_k").agg(F.max("toxic").alias("toxic"))
    # At most FIT_ROWS labels (those with the least key hash): a proven bound, so they are
    # sent to the texts and no text crosses a shuffle.
    marks = F.broadcast(marks.orderBy(F.xxhash64("_k"), "_k").limit(fit_rows))
    half = F.pmod(F.xxhash64(F.lit(7), F.col("_k")), F.lit(2)).cast("int")
    rows = docs.select(col(key).alias("_k"), col(text).alias("t")).join(marks, "_k").select(
        "t", "toxic", half.alias("half"))
    size = {(r["half"], r["toxic"]): float(r["n"]) for r in rows.groupBy("half", "toxic").agg(F.count("*").alias("n")).collect()}
    n = [size.get((h, y), 0.0) for h in (0, 1) for y in (0, 1)]
    weights = [np.zeros(SLOTS, np.float32) for _ in range(3)]
    beta = np.zeros(TOP_WORDS + 2)
    toxic, other = n[1] + n[3], n[0] + n[2]
    share = min(max((toxic + 0.5) / (toxic + other + 1.0), 1e-6), 1 - 1e-6)
    beta[-1] = np.log(share / (1 - share))
    if not (toxic and other):
        return lm, weights[2], beta
    counts = rows.mapInArrow(
        tidied(partial(_sequence_counts, lm=lm)), "slot long, n0 long, n1 long, n2 long, n3 long").groupBy("slot").agg(
        *[F.sum(f"n{k}").alias(f"n{k}") for k in range(4)])
    found = counts.select(
        "slot", _weight(F.col("n1"), F.col("n0"), n[1], n[0]).alias("w0"),
        _weight(F.col("n3"), F.col("n2"), n[3], n[2]).alias("w1"),
        _weight(F.col("n1") + F.col("n3"), F.col("n0") + F.col("n2"), toxic, other).alias("w2"),
    ).where("w0 > 0 or w1 > 0 or w2 > 0").toArrow()
    at = found.column("slot").to_numpy()
    for k in range(3):
        weights[k][at] = found.column(f"w{k}").to_numpy()
    got = rows.mapInArrow(
        tidied(partial(_feature_rows, halves=weights[:2], lm=lm)),
        "toxic int, " + ", ".join(f"f{i} double" for i in range(TOP_WORDS + 1))).toArrow()
    x = np.column_stack([got.column(i).to_numpy() for i in range(1, got.num_columns)])
    y = got.column(0).to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        beta = _fit(x, y)
    return lm, weights[2], beta


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the score, 0 to 1, as double column ``out``."""
    at, names = df.columns.index(text), [*df.columns, out]
    schema = df.withColumn(out, F.lit(0.0)).schema
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(shared.value[0])
        for batch in chunked(batches, at):
            got = scores(shared.value, batch.column(at).to_pylist(), words)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], names=names)

    return df.mapInArrow(tidied(run), schema)


def held_out(key: Column) -> Column:
    """Rows kept apart from training: crc32 of the key as text leaves remainder 1 by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
          threshold: float = THRESHOLD) -> DataFrame:
    """(key, held_out, score, predicted) for every row of ``docs``; held-out labels are not read."""
    model = train(docs, labels.where(~held_out(col(key))), key, text, label)
    rows = docs.select(col(key).alias("_k"), col(text).alias("_t"))
    return with_score(rows, model, "_t", "score").select(
        F.col("_k").alias(key), held_out(F.col("_k")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
                  threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, trained as in ``score``."""
    model = train(docs, labels.where(~held_out(col(key))), key, text, label)
    out = spare_name(docs, "_score")
    return with_score(docs, model, text, out).where(F.col(out) < threshold).drop(out)
