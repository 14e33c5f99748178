import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from valuescope.llm import toxicity as tox

from .helpers import awkward, empty

BAD = "scoundrel rascal villain".split()


def _corpus(n=900):
    rng = random.Random(4)
    syllables = "ba de fi go lu ra te mi so nu".split()
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4))) for _ in range(rng.randrange(8, 60))]
        bad = i % 5 == 0
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark):
    rows, labels = _corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    return docs, marks, tox.train(docs, marks.where(~tox.held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark, model):
    docs, marks, _ = model
    got = tox.score(docs, marks).join(marks, "doc_id").where("held_out").collect()
    assert len(got) > 200
    right = [r["predicted"] == r["toxic"] for r in got]
    assert np.mean(right) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_disguises_are_restored(model):
    cost = tox.Costs(model[2][0])
    for written, meant in (("sc0undrel", "scoundrel"), ("r@scal", "rascal"), ("v!llain", "villain"),
                           ("v.i.l.l.a.i.n", "villain"), ("rrraaassscccaaalll", "rascal"), ("\"rascal!!\"", "rascal")):
        assert tox.plain_word(written, cost) == meant
    assert "rascal" in tox.written_words("you r a s c a l you")


def test_disguised_texts_score_like_plain_ones(model):
    words = tox.Words(model[2][0])
    plain, hidden, clean = tox.scores(model[2], ["bade rascal sonu villain gora scoundrel",
                                                  "bade r@sc4l sonu v1ll@in gora s c o u n d r e l", "bade sonu gora"], words)
    assert plain > 0.7 and hidden > 0.7 and clean < 0.3


def test_held_out_is_crc32_of_the_key(spark):
    import zlib
    got = spark.range(200).select("id", tox.held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in got)


def test_labels_held_out_are_not_read(spark, model):
    docs, marks, _ = model
    flipped = marks.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r["doc_id"]: r["score"] for r in tox.score(docs, marks).collect()}
    b = {r["doc_id"]: r["score"] for r in tox.score(docs, flipped).collect()}
    assert a == b


def test_awkward_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (None, 1), (4, 0), (1, 0), (99, 1)], "doc_id long, toxic int")
    rows = awkward(spark)
    got = tox.score(rows, labels)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == rows.count()
    assert got.where("score is null or held_out is null").count() == 0
    kept = tox.without_toxic(rows, labels)
    assert kept.columns == rows.columns
    assert tox.score(empty(spark), labels).count() == 0
    none = tox.score(rows, labels.limit(0)).select("score").distinct().collect()
    assert len(none) == 1


def _costs(text):
    lm = np.zeros(tox.LM_SLOTS, np.float32)
    for batch in tox._lm_counts(iter([pa.RecordBatch.from_arrays([pa.array([text])], names=["t"])])):
        lm[batch.column(0).to_numpy()] = batch.column(1).to_numpy()
    return tox.Costs(lm)


def test_symbols_at_the_end_of_a_word_are_read():
    cost = _costs("the ass and the boss hit a worthless word of glass " * 40)
    for written, meant in (("a$$", "ass"), ("bo$$", "boss"), ("hi+", "hit"), ("h!+", "hit"), ("\"worthle$$\".", "worthless"),
                           ("gla$$!!", "glass"), ("word!!", "word"), ("word!", "word"), ("boss!\"", "boss"), ("(hit)...", "hit")):
        assert tox.plain_word(written, cost) == meant


def test_disguised_words_of_any_length_are_restored():
    cost = _costs("the boss hit a worthless word of glass " * 40)
    phrase = "_".join("worthless") + "-" + "-".join("boss")
    for written, meant in (("worth1" + "e" * 60 + "ss", "worthless"), ("w0" + "r" * 50 + "thless", "worthless"),
                           (phrase * 3, "worthlessboss" * 3), (".".join("w0rthless" * 6), "worthless" * 6)):
        assert len(written) > 40
        assert tox.plain_word(written, cost) == meant
    # In time proportional to the length.
    assert tox.plain_word(".".join("w0rthless" * 3000), cost) == "worthless" * 3000
    for written in ("a" * 300_000 + "1", "a" + "1" * 300_000, "a" + "." * 300_000 + "b", "." * 300_000, "ab1" * 10_000):
        assert tox.plain_word(written, cost) is not None


def test_spaced_words_beside_punctuation_are_joined():
    cost = _costs("you are a loser and the boss hit an idiot with glass " * 40)

    def read(text):
        return {tox.plain_word(w, cost) for w in tox.written_words(text)}

    for text in ("you l o s e r!", "you l o s e r.", "l o s e r, you", "\"l o s e r\"", "(l o s e r)", "'L O S E R!!'", "l, o, s, e, r.",
                 "l. 0. $. e. r.", "_l o s e r_", "you l 0 $ e r?!", "“l o s e r” “i d i o t”", "l o s e r! i d i o t!"):
        assert "loser" in read(text), text
    assert "idiot" in read("“l o s e r” “i d i o t”") and "idiot" in read("l o s e r! i d i o t!")
    assert "boss" in read("the b o $ $.") and "glass" in read("\"g l a $ $\"!")
    assert tox.written_words("we are a b -- so it is.") == set("we are a b -- so it is.".split())
    assert tox.written_words("= " + "=" * 200_000 + " " * 200_000 + "a " + "." * 200_000)


def test_words_that_start_with_two_letters_are_not_tried_as_single(monkeypatch):
    real, tried = tox._SINGLE, []

    class Tried:
        @staticmethod
        def match(word):
            tried.append(word)
            return real.match(word)

    monkeypatch.setattr(tox, "_SINGLE", Tried)
    got = tox.written_words("Well, then: b2b! (b) a, d. -x- _y_ $ it's")
    assert {"(b)a,d.-x-_y_$", "well,", "then:"} <= got
    assert not {"well,", "then:", "b2b!", "it's"} & set(tried) and {"(b)", "a,", "-x-", "_y_", "$"} <= set(tried)


def test_words_are_tried_as_single_characters_once(monkeypatch):
    words = tox.Words(np.zeros(tox.LM_SLOTS, np.float32))
    lines = ["b a d word", "( a ) d one, b", "(a) d !b! word one,", "abc (a)d b a d", "", None, "a d b"]
    want = [tox.written_words(line or "") for line in lines]
    tried, plain = [], tox.single_characters
    monkeypatch.setattr(tox, "single_characters", lambda some: tried.extend(some) or plain(some))
    for _ in range(2):
        assert [words.written(line) for line in lines] == want
    assert sorted(tried) == sorted({w for line in lines for w in (line or "").split()})
