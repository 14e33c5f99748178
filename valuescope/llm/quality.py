"""Quality rules by weak supervision (native DataFrame work only).

Each rule looks at one measure of a text and votes keep, drop or abstains. The
accuracies of the rules are not given: expectation-maximisation estimates, for a
hidden class good/bad, how often each rule votes each way in either class. Only
the counts of the vote patterns over *all* documents enter it -- at most
3 ** len(RULES) rows, whatever the corpus size -- and every iteration is one
aggregation of that table. A document is kept when its posterior probability of
being good reaches ``threshold``; a hard base rule (too short, mostly repeated)
overrides that. An abstention is no evidence either way.

Defined cases: a null or empty text has zero words, so it fails the base rule; an
empty table gives an empty result; repeated rows are judged alike and all
returned; only ``key`` and ``text`` are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import pin
from .common import col, words

SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_ITERATIONS = 20
TOLERANCE = 1e-3

# measure -> (keep up to, drop from): between the two bounds the rule abstains.
# All measures are shares of words, lines or letters.
RULES = {
    "symbols": (0.02, 0.25),       # symbol characters per word
    "repeats": (0.10, 0.40),       # words inside repeated 3-word windows
    "dup_lines": (0.00, 0.50),     # lines equal to an earlier line
    "capitals": (0.20, 0.50),      # upper-case letters per character of words
    "bare": (0.05, 0.25),          # words of up to 4 bytes without letter or digit
    "odd_length": (0.00, 1.00),    # distance of the mean word length from 2.5..12
}


# Window keys: the upper 40 bits of a hash over the lower 24 bits of the position.
POSITION_BITS = 24


def _windows(w: Column) -> Column:
    """Sorted keys of the 3-word windows of ``w``: equal windows are neighbours."""
    mask = F.lit((1 << POSITION_BITS) - 1)
    return F.sort_array(F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]).bitwiseAND(F.bitwise_not(mask)).bitwiseOR(i.cast("long"))))


def _covered(w: Column, keys: Column) -> Column:
    """Words of ``w`` inside 3-word windows that occur twice or more.

    Neighbours with equal hash bits are compared word by word. Should two different
    windows share their hash bits (or a text exceed 2**24 words), the row falls back
    to sorting the windows themselves: always exact, n log n, no pairs.
    """
    mask = F.lit((1 << POSITION_BITS) - 1)

    def place(x: Column) -> Column:
        return x.bitwiseAND(mask).cast("int")

    def alike(x: Column, y: Column) -> Column:
        return F.coalesce(F.shiftright(x.bitwiseXOR(y), POSITION_BITS) == 0, F.lit(False))

    def equal(x: Column, y: Column) -> Column:
        p, q = place(x), place(y)
        return alike(x, y) & (w[p] == w[q]) & (w[p + 1] == w[q + 1]) & (w[p + 2] == w[q + 2])

    def count(positions: Column) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(positions, lambda p: F.array(p, p + 1, p + 2)))))

    fast = F.transform(F.filter(keys, lambda x, k: equal(x, F.get(keys, k - 1)) | equal(x, F.get(keys, k + 1))), place)
    clash = F.exists(F.transform(keys, lambda x, k: F.when(
        alike(x, F.get(keys, k - 1)), ~equal(x, F.get(keys, k - 1))).otherwise(F.lit(False))), lambda x: x)
    spelled = F.array_sort(F.transform(
        F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))),
        lambda x, i: F.struct(F.array(x, w[i + 1], w[i + 2]).alias("g"), i.alias("i"))))
    # Bound once through a one-element array, so that the sort is not repeated.
    slow = F.flatten(F.transform(F.array(spelled), lambda s: F.transform(F.filter(
        s, lambda x, k: F.coalesce(F.get(s, k - 1)["g"] == x["g"], F.lit(False))
        | F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False))), lambda x: x["i"])))
    return F.when((F.size(w) >= 1 << POSITION_BITS) | clash, count(slow)).otherwise(count(fast))


def measures(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key (as ``key``), the base measures and the share each rule looks at."""
    t, w, lines = F.col("_t"), F.col("_w"), F.col("_lines")
    base = (df.select(col(key).alias("_k"), F.coalesce(col(text), F.lit("")).alias("_t"))
            .withColumn("_w", words(t))
            .withColumn("_lines", F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
            .withColumn("_keys", _windows(w)))
    base = base.select(
        "_k",
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        _covered(w, F.col("_keys")).cast("long").alias("n_repeat_words"),
        F.size(lines).alias("n_lines"),
        (F.length(t) - F.length(F.regexp_replace(t, r"\p{Lu}", ""))).alias("n_upper"),
        F.size(F.filter(w, lambda x: (F.octet_length(x) <= 4) & ~x.rlike(r"[\p{L}\p{N}]"))).alias("n_bare"))

    def share(part: str, whole: Column) -> Column:
        return F.coalesce(F.col(part) / F.when(whole > 0, whole), F.lit(0.0))

    n = F.col("n_words")
    mean = share("word_chars", n)
    return base.select(
        "_k", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        share("n_symbols", n).alias("symbols"), share("n_repeat_words", n).alias("repeats"),
        share("n_dup_lines", F.col("n_lines")).alias("dup_lines"),
        share("n_upper", F.col("word_chars")).alias("capitals"), share("n_bare", n).alias("bare"),
        F.greatest(F.lit(0.0), F.lit(2.5) - mean, mean - F.lit(12.0)).alias("odd_length"))


def vote(measure: str) -> Column:
    """1 keep, -1 drop, 0 abstain."""
    keep, drop = RULES[measure]
    return (F.when(F.col(measure) <= keep, 1).when(F.col(measure) >= drop, -1)
            .otherwise(0).cast("tinyint"))


def _log_odds(params: dict) -> Column:
    """Log posterior odds of good against bad, as an expression of the votes."""
    odds = F.lit(math.log(params["prior"]) - math.log1p(-params["prior"]))
    for rule in RULES:
        good, bad = params["votes"][rule]
        terms = {v: math.log(good[v]) - math.log(bad[v]) for v in (1, -1)}
        v = F.col(f"v_{rule}")
        odds = odds + F.when(v == 1, terms[1]).when(v == -1, terms[-1]).otherwise(0.0)
    return odds


def posterior(params: dict) -> Column:
    """Probability of the class good given the votes v_<rule> of a row."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_log_odds(params)))


# A rule's error rates are bounded: on good texts it votes drop this often at most,
# on bad ones this often at least. Faults of different kinds rarely come together,
# so without the bounds the larger kinds alone would make up the class bad.
MAX_FALSE_ALARM = 0.01
MIN_RECALL = 0.05


def _start() -> dict:
    """Start: a drop vote is forty times likelier in the class bad, a keep vote weak evidence."""
    good, bad = {1: 0.995, -1: 0.005}, {1: 0.80, -1: 0.20}
    return {"prior": 0.8, "votes": {r: (dict(good), dict(bad)) for r in RULES}}


def estimate(patterns: DataFrame) -> dict:
    """EM over the vote-pattern table (v_<rule>..., n): prior and vote rates by class.

    One aggregation per iteration; the driver holds the parameters only (two
    numbers a rule, vote and class). An empty table returns the start values.
    """
    params = _start()
    for _ in range(MAX_ITERATIONS):
        good = posterior(params) * F.col("n")
        sums = [F.sum("n").alias("all"), F.sum(good).alias("good")]
        for r in RULES:
            for v, name in ((1, "k"), (-1, "d")):
                hit = F.col(f"v_{r}") == v
                sums += [F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"a_{r}_{name}"),
                         F.sum(F.when(hit, good).otherwise(0.0)).alias(f"g_{r}_{name}")]
        s = patterns.agg(*sums).first()
        if not s["all"]:
            return params
        total, ngood = float(s["all"]), float(s["good"])

        def rates(k: float, d: float, least: float, most: float) -> dict:
            # Among the votes cast; add-one smoothing keeps every rate above zero.
            drop = min(max((d + 1.0) / (k + d + 2.0), least), most)
            return {1: 1.0 - drop, -1: drop}

        new = {"prior": (ngood + 1.0) / (total + 2.0), "votes": {}}
        for r in RULES:
            gk, gd, ak, ad = (float(s[f"{p}_{r}_{q}"]) for p, q in (("g", "k"), ("g", "d"), ("a", "k"), ("a", "d")))
            new["votes"][r] = (rates(gk, gd, 0.0, MAX_FALSE_ALARM),
                               rates(ak - gk, ad - gd, MIN_RECALL, 0.9))
        change = max([abs(new["prior"] - params["prior"])]
                     + [abs(new["votes"][r][c][v] - params["votes"][r][c][v])
                        for r in RULES for c in (0, 1) for v in (1, -1)])
        params = new
        if change < TOLERANCE:
            break
    return params


def judge(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, base measures, base_failed, quality, kept, v_<rule>...) for every row of ``df``.

    ``quality`` is the posterior probability of the class good. The measures are
    written once to the shared folder (a few numbers a document), so the texts are
    read once.
    """
    m = measures(df, key, text)
    rows = pin(m.select("_k", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                        *[vote(r).alias(f"v_{r}") for r in RULES]))
    patterns = pin(rows.groupBy(*[f"v_{r}" for r in RULES]).agg(F.count("*").alias("n")).coalesce(1))
    params = estimate(patterns)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    quality = posterior(params)
    return rows.select(
        F.col("_k").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), quality.alias("quality"),
        (~failed & (quality >= threshold)).alias("kept"), *[f"v_{r}" for r in RULES])
