import re

import pytest

from valuescope.llm import quality

from .helpers import awkward, documents, empty


def _brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = {}
    for w in windows:
        seen[w] = seen.get(w, 0) + 1
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def _measures(r):
    return (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])


def test_base_measures_equal_brute_force(spark):
    rows = documents(spark, "/root/testdata/sf0.01")
    wanted = {r["doc_id"]: _brute(r["text"]) for r in rows.collect()}
    got = {r["doc_id"]: _measures(r) for r in quality.judge(rows).collect()}
    assert got == wanted


def test_clash_of_window_keys_is_exact(spark, monkeypatch):
    # With 60 of 64 bits for the place, windows clash all the time.
    monkeypatch.setattr(quality, "POSITION_BITS", 60)
    texts = ["a b c d a b c e f", "x " * 9, "a b c", "one two three four five six one two three", ""]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["_k"]: r["n_repeat_words"] for r in quality.measures(rows).collect()}
    assert got == {i: _brute(t)[4] for i, t in enumerate(texts)}


def test_verdicts_follow_the_labels(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").selectExpr("doc_id", "quality AS label")
    got = quality.judge(documents(spark, "/root/testdata/sf0.01")).join(labels, "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in got if r["label"] == 1]
    bad = [r["kept"] for r in got if r["label"] == 0]
    assert sum(good) / len(good) > 0.95
    assert sum(bad) / len(bad) < 0.4


def test_estimates_find_the_reliable_rules(spark):
    names = list(quality.RULES)
    # 80 clean, 20 caught by the first rule, and one rule that always says keep.
    rows = [tuple([1] * len(names)) + (800,), tuple([-1] + [1] * (len(names) - 1)) + (200,)]
    params = quality.estimate(spark.createDataFrame(rows, ", ".join(f"v_{r} int" for r in names) + ", n long"))
    assert params["prior"] == pytest.approx(0.8, abs=0.02)
    good, bad = params["votes"][names[0]]
    assert good[-1] <= quality.MAX_FALSE_ALARM and bad[-1] > 0.8


def test_awkward_rows(spark):
    rows = awkward(spark)
    got = quality.judge(rows).collect()
    assert sorted(map(_measures, got)) == sorted(_brute(r["text"]) for r in rows.collect())
    assert not any(r["kept"] for r in got if r["base_failed"])
    assert quality.judge(empty(spark)).count() == 0
