"""Mixing sources to target weights by pivotal rounding (native DataFrame work only).

Every source gets a target number of words: its share by weight of a multiple of
all words, at most ``cap`` times its own size, the excess shared out again. The
documents of a source then have the same expected number of copies, a whole part
and a fraction. Pivotal rounding turns the fractions into whole copies without
losing mass: two fractions meet, mass moves at random from one to the other until
one is integral, and the other meets the next. Documents meet neighbours of about
their own size, so the words taken stay near the target and not only the copies.

The meeting order is a tree. Documents are hashed into blocks of about ``BLOCK``
within (source, size class); a block folds to at most one undecided document, and
these go up level by level (blocks of a class, classes of a source). No task holds
more than a block, however large a source is. All randomness is a hash of the seed
and the document, so reruns agree.

Defined cases: a null or empty text has size 0 and is taken 0 words; a null source
is a source, the last one; a source of size 0 has target 0; rows that repeat key,
source and size are one document with one decision, returned for each row; an empty
table gives an empty result; columns other than key, text and source are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import sorted_index
from ..session import pin
from .common import col, numbered, words

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
BLOCK = 128
CLASSES_PER_DOUBLING = 8
SEED = 20240229


def sizes(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(_k, _s, _z): key, source and number of words of every row."""
    return df.select(col(key).alias("_k"), col(source).alias("_s"),
                     F.size(words(col(text))).cast("long").alias("_z"))


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            cap: float = CAP) -> DataFrame:
    """(_s, source_size, target) of every source of ``rows`` (_s, _z).

    Weights repeat over the sources in code-point order, null last. The level
    ``words per weight`` rises until no source is above its cap; each step is one
    aggregation over the sources, the driver holds three numbers.
    """
    per = rows.groupBy("_s").agg(F.sum("_z").alias("source_size"))
    ranked = sorted_index(per, [F.col("_s").isNull(), F.col("_s")], index_col="_rank", unique=True)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("_rank") % len(weights) + 1).cast("int"))
    ranked = pin(ranked.select("_s", "source_size", weight.alias("_w")))
    limit = F.col("source_size") * F.lit(float(cap))
    level = -1.0
    while True:
        above = F.lit(level) * F.col("_w") > limit
        s = ranked.agg(F.sum("source_size").alias("all"),
                       F.sum(F.when(above, limit).otherwise(0.0)).alias("full"),
                       F.sum(F.when(~above, F.col("_w")).otherwise(0.0)).alias("open")).first()
        if not s["all"] or not s["open"]:
            break
        new = (share * s["all"] - s["full"]) / s["open"]
        if new <= level * (1 + 1e-12):
            break
        level = new
    return ranked.select("_s", "source_size", F.least(limit, F.lit(max(level, 0.0)) * F.col("_w")).alias("target"))


def _fold(members: str, key_type: str) -> str:
    """SQL: a block's members, each (key, z, p, u), folded by pivotal rounding.

    The state carries at most one undecided member (``open``, with mass ``p``) and
    the decided ones. The newcomer's own random number decides each meeting.
    """
    done = f"array<struct<key:{key_type},z:bigint,take:boolean>>"
    state = f"struct<open:boolean,key:{key_type},z:bigint,p:double,done:{done}>"

    def put(who: str, take: str) -> str:
        return (f"concat(a.done, array(cast(named_struct('key', {who}.key, 'z', {who}.z, 'take', {take}) "
                f"AS struct<key:{key_type},z:bigint,take:boolean>)))")

    def keep(who: str, mass: str, decided: str) -> str:
        # Mass that is integral up to rounding is settled by the next meeting or at the root.
        return (f"cast(named_struct('open', true, 'key', {who}.key, 'z', {who}.z, 'p', {mass}, "
                f"'done', {decided}) AS {state})")

    return f"""aggregate({members},
      cast(named_struct('open', false, 'key', null, 'z', 0, 'p', 0.0D, 'done', array()) AS {state}),
      (a, e) -> CASE
        WHEN NOT a.open THEN {keep('e', 'e.p', 'a.done')}
        WHEN a.p + e.p < 1 AND e.u * (a.p + e.p) < a.p THEN {keep('a', 'a.p + e.p', put('e', 'false'))}
        WHEN a.p + e.p < 1 THEN {keep('e', 'a.p + e.p', put('a', 'false'))}
        WHEN e.u * (2 - a.p - e.p) < 1 - e.p THEN {keep('e', 'a.p + e.p - 1', put('a', 'true'))}
        ELSE {keep('a', 'a.p + e.p - 1', put('e', 'true'))} END)"""


def _level(rows: DataFrame, by: Sequence[str], level: int, seed: int) -> DataFrame:
    """One level of the tree: (by..., done, open member's _k, _z, _p) for each block."""
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), F.col("_k"), F.col("_z")), F.lit(1 << 52)) / float(1 << 52)
    # Largest first: what stays open to the end is small.
    member = F.struct((-F.col("_z")).alias("o"), F.col("_z").alias("z"), F.xxhash64(F.lit(seed), F.col("_k")).alias("h"),
                      F.col("_k").alias("key"), F.col("_p").alias("p"), draw.alias("u"))
    key_type = dict(rows.dtypes)["_k"]
    blocks = rows.groupBy(*by).agg(F.array_sort(F.collect_list(member)).alias("_m"))
    folded = blocks.withColumn("_f", F.expr(_fold("_m", key_type)))
    return folded.select(*by, F.col("_f.done").alias("_done"), F.col("_f.key").alias("_k"),
                         F.col("_f.z").alias("_z"), F.col("_f.p").alias("_p"))


def _decided(level: DataFrame) -> DataFrame:
    return level.select("_s", F.explode("_done").alias("_d")).select(
        "_s", F.col("_d.key").alias("_k"), F.col("_d.z").alias("_z"), F.col("_d.take").alias("_take"))


def round_fractions(docs: DataFrame, block: int = BLOCK, seed: int = SEED) -> DataFrame:
    """Pivotal rounding of distinct (_s, _k, _z, _p), 0 < _p < 1: (_s, _k, _z, _take)."""
    size_class = F.floor(F.log2(F.col("_z") + 1.0) * CLASSES_PER_DOUBLING).cast("int")
    docs = docs.withColumn("_c", size_class)
    per = docs.groupBy("_s", "_c").agg(F.ceil(F.count("*") / block).alias("_nb"))
    docs = docs.join(per.select(F.col("_s").alias("_s2"), F.col("_c").alias("_c2"), "_nb"),
                     F.col("_s").eqNullSafe(F.col("_s2")) & (F.col("_c") == F.col("_c2")))
    docs = docs.withColumn("_b", F.pmod(F.xxhash64(F.lit(seed + 1), F.col("_k")), F.col("_nb")))
    level = pin(_level(docs, ["_s", "_c", "_b"], 0, seed))
    decided, n = [_decided(level)], 0
    most = level.agg(F.max("_b")).first()[0]
    while most is not None and most > 0:  # blocks of a size class
        n += 1
        up = level.select("_s", "_c", F.floor(F.col("_b") / block).alias("_b"), "_k", "_z", "_p")
        level = pin(_level(up, ["_s", "_c", "_b"], n, seed))
        decided.append(_decided(level))
        most = most // block
    # Then the size classes of a source: at most a few hundred (logarithmic in the largest size).
    root = pin(_level(level.select("_s", "_k", "_z", "_p"), ["_s"], n + 1, seed))
    decided.append(_decided(root))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit(-1), F.col("_k"), F.col("_z")), F.lit(1 << 52)) / float(1 << 52)
    decided.append(root.select("_s", "_k", "_z", (draw < F.col("_p")).alias("_take")))
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out


def decide(rows: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
           cap: float = CAP, seed: int = SEED) -> DataFrame:
    """Distinct (_k, _s, _z) of ``rows`` with source_size, target and the copies to take."""
    plan = targets(rows, weights, share, cap)
    docs = (rows.distinct()
            .join(plan.withColumnRenamed("_s", "_s1"), F.col("_s").eqNullSafe(F.col("_s1"))).drop("_s1"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    docs = pin(docs.withColumn("_base", F.floor(rate).cast("long"))
               .withColumn("_p", F.when(F.col("_z") > 0, rate - F.col("_base")).otherwise(0.0)))
    taken = round_fractions(docs.where(F.col("_p") > 0).select("_s", "_k", "_z", "_p"), seed=seed)
    taken = taken.select(F.col("_s").alias("_s3"), F.col("_k").alias("_k3"), F.col("_z").alias("_z3"), "_take")
    same = (F.col("_k").eqNullSafe(F.col("_k3")) & F.col("_s").eqNullSafe(F.col("_s3"))
            & (F.col("_z") == F.col("_z3")))
    return docs.join(taken, same, "left").select(
        "_k", "_s", "_z", "source_size", "target",
        (F.col("_base") + F.coalesce(F.col("_take"), F.lit(False)).cast("long")).alias("copies"))


def mix(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
        seed: int = SEED) -> DataFrame:
    """(key, source, size, source_size, target, copies, taken) for every row of ``df``."""
    rows = pin(sizes(df, key, text, source))
    plan = decide(rows, weights, share, cap, seed)
    plan = plan.select(F.col("_k").alias("_k4"), F.col("_s").alias("_s4"), F.col("_z").alias("_z4"),
                       "source_size", "target", "copies")
    same = (F.col("_k").eqNullSafe(F.col("_k4")) & F.col("_s").eqNullSafe(F.col("_s4"))
            & (F.col("_z") == F.col("_z4")))
    return rows.join(plan, same).select(
        F.col("_k").alias(key), F.col("_s").alias(source), F.col("_z").alias("size"),
        "source_size", "target", "copies", (F.col("copies") * F.col("_z")).alias("taken"))


def mixed(df: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
          weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
          seed: int = SEED) -> DataFrame:
    """The rows of ``df``, each as often as the mix takes it (all columns kept)."""
    rows = pin(sizes(df, key, text, source))
    plan = decide(rows, weights, share, cap, seed).where("copies > 0").select(
        F.col("_k").alias("_k4"), F.col("_s").alias("_s4"), F.col("_z").alias("_z4"), "copies")
    # The size is computed from the text again, so the texts cross one shuffle only.
    inner, (k, t, s) = numbered(df, key, text, source)
    sized = inner.withColumn("_size", F.size(words(F.col(t))).cast("long"))
    same = F.col(k).eqNullSafe(F.col("_k4")) & F.col(s).eqNullSafe(F.col("_s4")) & (F.col("_size") == F.col("_z4"))
    return (sized.join(plan, same)
            .withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
            .select(*inner.columns).toDF(*df.columns))
