import itertools
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from valuescope.llm import simhash
from valuescope.llm import components
from valuescope.llm.components import component_roots

from .helpers import awkward, documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(pairs, keys):
    root = {k: k for k in keys}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        if a != b:
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in keys}


def test_equals_brute_force(spark):
    rows = documents(spark).collect()
    fps = {r["doc_id"]: _fingerprint(r["text"]) for r in rows}
    near = [(a, b) for a, b in itertools.combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 3]
    expected = _components(near, fps)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"])
           for r in simhash.near_duplicates(documents(spark)).collect()}
    assert got == {k: (f"{fps[k]:016x}", expected[k]) for k in fps}
    assert len(set(expected.values())) < len(fps)


def test_pieces_of_a_long_text_give_the_same_fingerprint(monkeypatch):
    text = " ".join(f"w{i % 700}X" for i in range(5000))
    monkeypatch.setattr(simhash, "PIECE", 500)
    assert simhash.fingerprint(text.encode()) == _fingerprint(text)
    assert simhash.fingerprint("ÄB  c".encode()) == _fingerprint("ÄB  c")


def test_thresholds_always_meet_the_pigeonhole_sum():
    rng = np.random.default_rng(5)
    fps = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    both = np.array([[np.sum((fps >> np.uint64(i)) & (fps >> np.uint64(j)) & np.uint64(1)) for j in range(64)] for i in range(64)])
    for m in (1, 2, 3, 4):
        parts = simhash.plan_parts(len(fps), both, m)
        assert sorted(int(b) for p in parts for b in p) == list(range(64))
        chosen, _ = simhash.thresholds(fps, parts, np.diag(both) / len(fps), len(fps), 3)
        assert (chosen.sum(axis=1) == 3 - m + 1).all() and chosen.min() >= -1


def test_links_of_clusters_and_skewed_bits(spark, monkeypatch):
    # Dense clusters, bits that are nearly constant, and blocks much smaller than a bucket.
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = random.Random(11)
    fps = set()
    for _ in range(12):
        centre = rng.getrandbits(64) & 0x00FFFFFFFFFF0FFF
        fps.add(centre)
        for _ in range(40):
            fps.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, 5))))
    signed = [f - (1 << 64) if f >> 63 else f for f in sorted(fps)]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    near = [(a, b) for a, b in itertools.combinations(signed, 2) if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3]
    expected = _components(near, signed)
    roots = {r["node"]: r["root"] for r in component_roots(simhash.links(nodes)).collect()}
    assert {k: roots.get(k, k) for k in signed} == expected


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, k) for k in range(1001, 1400)] + [(5000, 5000)]
    got = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{k: 1000 for k in range(1000, 1400)}}


def test_awkward_rows(spark):
    rows = simhash.near_duplicates(awkward(spark)).collect()
    assert len(rows) == awkward(spark).count()
    zero = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert zero == {2}   # null, empty and blank texts; null keys count last
    assert {r["component_id"] for r in rows if r["doc_id"] == 7} == {4}
    kept = simhash.one_of_each(awkward(spark))
    assert kept.columns == awkward(spark).columns
    assert kept.count() == len({r["component_id"] if r["doc_id"] != 6 else r["fingerprint"] for r in rows})
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.one_of_each(empty(spark)).count() == 0


def test_one_of_each_keeps_the_least_key(spark):
    groups = simhash.near_duplicates(documents(spark))
    kept = {r["doc_id"] for r in simhash.one_of_each(documents(spark)).collect()}
    assert kept == {r["component_id"] for r in groups.select(F.col("component_id")).distinct().collect()}


def test_edges_that_are_stars_need_no_round(spark, monkeypatch):
    made, real = [], components.pin
    monkeypatch.setattr(components, "pin", lambda df: made.append(1) or real(df))
    edges = spark.createDataFrame([(1, k) for k in range(2, 40)] + [(k, 50) for k in range(51, 60)], "a long, b long")
    got = {r["node"]: r["root"] for r in component_roots(edges).collect()}
    assert got == {k: 1 if k < 40 else 50 for k in [*range(1, 40), *range(50, 60)]}
    assert len(made) == 1
    assert component_roots(edges.limit(0)).count() == 0
