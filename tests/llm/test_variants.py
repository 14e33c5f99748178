import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np

from valuescope.llm import queries, variants

from .helpers import awkward, documents, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _words(rows):
    count = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}


def _one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _brute(rows):
    n = _words(rows)
    near = {w: [o for o in n if _one_edit(w, o)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda o: (-n[o], o), default=None)
        if best is not None and n[best] >= 10 * n[w]:
            form[w] = best
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (n[w], len(near[w]), form.get(w), n.get(form.get(w)), root)
    return out


def _got(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def _texts(rng, stems, n):
    rows = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = stems[min(int(rng.expovariate(0.25)), len(stems) - 1)]
            if rng.random() < 0.1:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("aé") + w[k:], w[:k] + rng.choice("xÿ") + w[k + 1:]])
            words.append(w.capitalize() if rng.random() < 0.2 else w)
        rows.append((i, " ".join(words)))
    return rows


def test_equals_brute_force(spark):
    rows = _texts(random.Random(2), ["letters", "lettersx", "aaaaaaaa", "königreich", "überraschung", "mississippi",
                                     "ababababab", "Ärgernis"], 120)
    got = _got(variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == _brute(rows)
    assert any(v[2] for v in got.values()) and any(v[1] > 3 for v in got.values())


def test_chains_of_forms(spark):
    """A word's form may itself have a more frequent form: the root is the last."""
    text = " ".join(["chainedwords"] * 2 + ["chainedword"] * 30 + ["chainedwor"] * 400)
    rows = [(1, text)]
    got = _got(variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string")))
    assert got == _brute(rows)
    assert got["chainedwords"][4] == "chainedwor" and got["chainedword"][2] == "chainedwor"


def test_lists_of_several_blocks(spark, monkeypatch):
    """Hot prefix and suffix: many words that agree on all but a few letters."""
    monkeypatch.setattr(variants, "BLOCK", 8)
    words = ["common" + x + y + "suffix" for x in "abcdefghij" for y in "abcdefg"]
    words += ["common" + x + "suffix" for x in "abcdefghij"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    pairs = [tuple(sorted(r)) for r in variants.near_words(df).collect()]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == {(a, b) for a in words for b in words if a < b and _one_edit(a, b)}


def test_single_edits_on_random_words():
    rng = random.Random(7)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(7, 11))) for _ in range(300)})
    codes, length = variants._matrix(words)
    a, b = np.triu_indices(len(words), 1)
    near, _ = variants.single_edits(codes, length, a, b)
    assert [(words[i], words[j]) for i, j in zip(a[near], b[near])] == [
        (x, y) for k, x in enumerate(words) for y in words[k + 1:] if _one_edit(x, y)]


def test_long_texts_piece_by_piece(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("abcÀÿ ×z\U0001F600▁9") for _ in range(5000)) + "lettersonly" * 30
    whole = Counter()
    variants.add_words(whole, "7", text)
    monkeypatch.setattr(variants, "PIECE_CHARS", 11)
    cut = Counter()
    variants.add_words(cut, "7", text)
    assert cut == whole and whole
    assert {w.decode("latin-1"): n for w, n in whole.items() if n >= 2} == _words([(7, text)])


def test_awkward_rows(spark):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    out = variants.group_variants(awkward(spark))
    assert out.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert _got(out) == _brute(rows)
    assert variants.group_variants(empty(spark)).count() == 0


def test_equals_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM read_parquet('/root/testdata/sf0.001/documents.parquet')")
    res = con.execute(queries.SQL["op12_spelling_variants"])
    names = [c[0] for c in res.description]
    got = _got(queries.op12_spelling_variants(spark, "/root/testdata/sf0.001"))
    assert names == ["word", "n", "n_near", "form", "form_n", "root"]
    assert {r[0]: tuple(r[1:]) for r in res.fetchall()} == got
    assert documents(spark).count() and len(got) > 1000
