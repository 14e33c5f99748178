import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from valuescope.llm import fingerprint as fpr

from .helpers import awkward, documents, empty


def _order(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, r["text"] or ""))


def _edited(rows):
    rows = [r["text"] or "" for r in _order(rows)]
    out = []
    for i, t in enumerate(rows):
        n = len(t) // 4
        out.append(t[:len(t) - n] + rows[(i + 1) % len(rows)][:n])
    return rows, out


def _shingles(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _likeness(a, b):
    a, b = _shingles(a), _shingles(b)
    return 1.0 if not a and not b else len(a & b) / min(len(a), len(b)) if a and b else 0.0


@pytest.mark.parametrize("per_bucket", [7, 4000])
def test_edits_equal_brute_force(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(fpr, "ROWS_PER_BUCKET", per_bucket)
    rows = documents(spark)
    got = sorted(fpr.compare_with_edits(rows).collect(), key=lambda r: r["doc_id"])
    texts, edited = _edited(rows.collect())
    assert [r["n_chars"] for r in got] == [len(t) for t in texts]
    assert [r["edited_text"] for r in got] == edited
    near = [_likeness(a, b) for a, b in zip(texts, edited)]
    error = np.abs(np.array(near) - [r["near_edited"] for r in got])
    assert error.mean() < 0.08
    exact = [i for i, (a, b) in enumerate(zip(texts, edited)) if max(len(_shingles(a)), len(_shingles(b))) <= fpr.FLOOR]
    assert exact and error[exact].max() < 1e-9      # short texts are kept whole
    after = [_likeness(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    assert np.abs(np.array(after) - [r["near_next"] for r in got]).mean() < 0.03


def test_containment_between_unequal_texts_and_merging(spark):
    rng = np.random.default_rng(1)
    words = [f"w{k}" for k in rng.integers(0, 10**6, 40_000)]
    rows = [(0, " ".join(words)), (1, " ".join(words[5000:9000])), (2, " ".join(words[:20_000])), (3, " ".join(words[19_996:]))]
    sk = fpr.with_sketch(spark.createDataFrame(rows, "i int, t string"), "t", "s").select("i", "s")
    s = {r["i"]: r["s"] for r in sk.collect()}
    assert 0.8 * 40_000 / fpr.SCALE < len(s[0]["hashes"]) < 1.2 * 40_000 / fpr.SCALE
    pair = sk.where("i = 0").select(F.col("s").alias("a")).crossJoin(sk.where("i = 1").select(F.col("s").alias("b")))
    assert pair.select(fpr.containment(F.col("a"), F.col("b"))).first()[0] == 1.0
    halves = sk.where("i = 2").select(F.col("s").alias("a")).crossJoin(sk.where("i = 3").select(F.col("s").alias("b")))
    assert halves.select(fpr.merged(F.col("a"), F.col("b")).alias("m")).first()["m"]["hashes"] == s[0]["hashes"]


def test_equal_texts_have_equal_fingerprints(spark):
    rows = spark.createDataFrame([(1, "a b c d e f g"), (2, "x"), (3, "a b c d e f g")], "doc_id long, text string")
    got = {r["doc_id"]: r["f"] for r in fpr.compare_with_edits(rows).select(
        "doc_id", fpr.text_form(F.col("sketch")).alias("f")).collect()}
    assert got[1] == got[3] != got[2]


def test_awkward_rows(spark):
    rows = awkward(spark)
    got = fpr.compare_with_edits(rows).withColumn("h", F.sha2("edited_text", 256)).collect()
    _, edited = _edited(rows.collect())
    assert sorted(r["h"] for r in got) == sorted(hashlib.sha256(t.encode()).hexdigest() for t in edited)
    assert fpr.compare_with_edits(empty(spark)).count() == 0
    alone = fpr.compare_with_edits(rows.where("doc_id = 8")).first()
    assert alone["near_next"] == 1.0


@pytest.mark.parametrize("keys", [None, "equal", "text"])
def test_any_key_type_and_hot_keys(spark, monkeypatch, keys):
    """Null keys, one key for all rows, and text keys, in more than one range."""
    monkeypatch.setattr(fpr, "ROWS_PER_BUCKET", 10)
    rows = [(None if keys is None else "k" if keys == "equal" else f"k{i:04d}", f"text number {i:04d} of this table " * 3)
            for i in range(300)]
    got = fpr.compare_with_edits(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    wanted = []
    for (_, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        wanted.append(t[:len(t) - len(t) // 4] + after[:len(t) // 4])
    assert sorted(r["edited_text"] for r in got) == sorted(wanted)
    marked = fpr.with_next(spark.createDataFrame(rows, "doc_id string, text string"), "doc_id", "text", ["text"])
    assert len(marked.collect()) == 300


def test_many_equal_and_null_keys(spark):
    rows = spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.format_string("text %06d", "id").alias("text"))
    rows = rows.unionByName(spark.range(10_000).select(F.lit(1).cast("long").alias("doc_id"), F.format_string("other %06d", "id").alias("text")))
    got = fpr.with_next(rows, "doc_id", "text", ["text"])
    wrong = got.where(F.col("next_text").isNull() | ((F.col("next_text") <= F.col("text")) & ~F.col("text").endswith("9999")))
    assert got.count() == 20_000 and wrong.count() == 0
