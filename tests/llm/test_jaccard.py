import os
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from valuescope.llm import jaccard, queries

from .helpers import awkward, documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _set(text, k=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(" ".join(words[i:i + k]) for i in range(len(words) - k + 1)) or frozenset(
        [" ".join(words)] if words else [])


def _brute(rows, percent=80):
    """{key: (set size, least key reachable)} by comparing all pairs; keys unique."""
    sets = {k: _set(t) for k, t in rows}
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for k, s in sets.items():
        shared = Counter(o for h in s for o in lists[h])
        for o, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[o]) - n):
                a, b = find(k), find(o)
                root[max(a, b)] = min(a, b)
        for h in s:
            lists[h].append(k)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def _got(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_equals_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    expected = _brute(rows)
    assert _got(jaccard.join_components(documents(spark))) == expected
    assert any(root != k for k, (_, root) in expected.items())


def _edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_copies_chains_and_common_passages(spark):
    """Near copies on both sides of the threshold, chains of copies of copies, a passage
    in many unlike documents, and short texts."""
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(40)]
    base = [f"b{i % 150}" for i in range(200)]
    texts = [" ".join(base)] + [_edited(rng, base, rng.randrange(1, 9)) for _ in range(40)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(10):
        chain = _edited(rng, chain, 2).split()
        texts.append(" ".join(chain))
    texts += [" ".join([*(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 120))), *passage]) for _ in range(60)]
    texts += ["Same short TEXT", "same short text", "same short", "same", "", None, " \n"]
    rows = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    got = _got(jaccard.join_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == _brute(rows)
    assert len({c for _, c in got.values()}) < len(rows)


@pytest.mark.parametrize("percent", [50, 100])
def test_other_thresholds(spark, percent):
    rng = random.Random(percent)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, _edited(rng, base, rng.randrange(6))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert _got(jaccard.join_components(df, percent=percent)) == _brute(rows, percent)


def test_prefixes_of_chosen_lengths_share_enough():
    """The m-match property for every pair of sets, each with its own m."""
    rng = np.random.default_rng(1)
    universe = np.arange(60)
    sets = [np.sort(rng.choice(universe, rng.integers(20, 50), replace=False)) for _ in range(120)]
    sets += [np.setdiff1d(s, s[rng.integers(0, len(s), 2)]) for s in sets]
    df = Counter(x for s in sets for x in s.tolist())
    made = []
    for s in sets:
        ordered = sorted(s.tolist(), key=lambda x: (df[x], x))
        shared = [x for x in ordered if df[x] > 1]
        m, used = jaccard.choose_matches(np.array([df[x] for x in shared]), len(s))
        made.append((set(s.tolist()), m, set(shared[:used])))
    linked = 0
    for i, (a, ma, pa) in enumerate(made):
        for b, mb, pb in made[:i]:
            if 100 * len(a & b) >= 80 * len(a | b):
                linked += 1
                assert len(pa & pb) >= min(ma, mb)
    assert linked > 50
    assert len({m for _, m, _ in made}) > 1


def test_costly_lists_ask_for_more_matches():
    rare = jaccard.choose_matches(np.full(90, 2), 100)[0]
    common = jaccard.choose_matches(np.full(90, 5000), 100)[0]
    assert rare < common


def test_long_texts_piece_by_piece(monkeypatch):
    text = " ".join(f"W{i % 900}\tx" for i in range(4000))
    whole = jaccard.shingle_set(text, jaccard._WordHashes())
    monkeypatch.setattr(jaccard, "PIECE_BYTES", 100)
    assert (jaccard.shingle_set(text, jaccard._WordHashes()) == whole).all()
    assert len(whole) == len(_set(text))


def test_awkward_rows(spark):
    out = jaccard.join_components(awkward(spark))
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    rows = out.collect()
    assert len(rows) == awkward(spark).count()
    by_key = defaultdict(list)
    for r in rows:
        by_key[r["doc_id"]].append((r["n_shingles"], r["component_id"]))
    assert by_key[1] == [(6, 1), (6, 1)] and by_key[7] == by_key[4] and by_key[7][0][1] == 4
    assert by_key[2] == [(0, 2)] and by_key[5] == [(0, 5)] and sorted(by_key[6]) == [(1, 6), (2, 6)]
    assert sorted(by_key[None]) == [(0, None), (1, None)]
    assert jaccard.join_components(empty(spark)).count() == 0


def test_text_keys(spark):
    df = spark.createDataFrame([("b", "a b c d e f"), ("a", "A b c d e f"), ("c", "else")], "doc_id string, text string")
    assert _got(jaccard.join_components(df)) == {"a": (2, "a"), "b": (2, "a"), "c": (1, "c")}


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    rows = con.execute(queries.SQL["op13_jaccard_join"]).fetchall()
    assert {k: (n, c) for k, n, c in rows} == _got(queries.op13_jaccard_join(spark, "/root/testdata/sf0.001"))


def test_parity_never_shows_more_than_the_difference():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a = rng.integers(-2**63, 2**63, rng.integers(1, 400))
        b = np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(-2**63, 2**63, rng.integers(0, 30))])
        shown = sum(int(x).bit_count() for x in (jaccard.parity(a) ^ jaccard.parity(b)).view(np.uint64))
        assert shown <= len(set(a.tolist()) ^ set(b.tolist()))
    assert not (jaccard.parity(a) ^ jaccard.parity(a[::-1].copy())).any()


def test_lists_of_past_rounds_are_deleted(spark, monkeypatch):
    """While the rounds go on, only the last round's lists are kept."""
    made, kept = [], []

    def met(postings, step):
        kept.append(sum(os.path.exists(folder) for folder in made))
        return real_met(postings, step)

    def pinned(df):
        out = real_pin(df)
        if "a_root" in out.columns:
            made.append(os.path.dirname(out.inputFiles()[0]).removeprefix("file://"))
        return out

    real_met, real_pin = jaccard._met, jaccard.pin
    monkeypatch.setattr(jaccard, "_met", met)
    monkeypatch.setattr(jaccard, "pin", pinned)
    rng = random.Random(5)
    bases = [[f"b{g}_{i}" for i in range(120)] for g in range(4)]
    rows = [(i, _edited(rng, bases[i % 4], rng.randrange(1, 7))) for i in range(80)]
    assert _got(jaccard.join_components(spark.createDataFrame(rows, "doc_id long, text string"))) == _brute(rows)
    assert len(made) > 1 and max(kept) <= 1
    assert not any(os.path.exists(folder) for folder in made)


def test_rounds_join_components_not_all_links_again(spark, monkeypatch):
    """What a round links is closed once: later rounds hold no edge, and no joined set, of it."""
    calls, real = [], jaccard.component_roots

    def closed(edges):
        calls.append({(r["a"], r["b"]) for r in edges.collect()})
        return real(edges)

    monkeypatch.setattr(jaccard, "component_roots", closed)
    monkeypatch.setattr(jaccard, "LINKING_SHARE", -1.0)
    monkeypatch.setattr(jaccard, "MEETINGS", 0)
    rng = random.Random(6)
    base = [f"b{i}" for i in range(100)]
    chain = [base[:]]
    for step in range(12):   # each near the one before, its ends far apart
        chain.append([w if not 8 * step <= i < 8 * step + 3 else f"n{step}_{i}" for i, w in enumerate(chain[-1])])
    rows = [(i, " ".join(words)) for i, words in enumerate(chain)]
    rows += [(100 + i, _edited(rng, [f"c{k}" for k in range(120)], rng.randrange(1, 7))) for i in range(30)]
    assert _got(jaccard.join_components(spark.createDataFrame(rows, "doc_id long, text string"))) == _brute(rows)
    gone: set[int] = set()
    for edges in calls:
        assert not gone & {x for edge in edges for x in edge}
        parent = {x: x for edge in edges for x in edge}
        for _ in parent:
            for a, b in edges:
                parent[a] = parent[b] = min(parent[a], parent[b])
        gone |= {x for x, least in parent.items() if x != least}
    assert len(calls) > 1


def test_few_meetings_end_the_rounds(spark):
    met = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 7), (2, 8), (2, 9), (3, 4)], "a_h long, a_root long")
    assert jaccard._meetings(met) == (7, 5)
    assert jaccard._meetings(met.limit(0)) == (0, 0)
