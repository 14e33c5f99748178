import time
import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from valuescope.llm import pieces

from .helpers import awkward, documents, empty


@pytest.fixture(scope="module")
def vocab():
    return pieces._prepared(pieces.load())


@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=6))
@settings(max_examples=150, deadline=None)
def test_decoding_returns_the_text(texts):
    v = test_decoding_returns_the_text.__dict__.setdefault("v", pieces._prepared(pieces.load()))
    got = pieces.encode_texts(texts, np.arange(len(texts)).astype(np.uint64), v)
    assert pieces.decode_ids(got, v) == texts


def test_odd_texts(vocab):
    texts = ["", " ", "  a  b\n\nc ", "▁x ▁ ▁", "\x00\r\n\t", "日本語 ｱ 😀👍  ", "x" * 20_000, "é" * 300 + " " * 50 + "\n" * 20, None]
    got = pieces.encode_texts(texts, np.zeros(len(texts), np.uint64), vocab)
    assert pieces.decode_ids(got, vocab) == texts


def test_segmentations_have_their_lattice_probability(vocab):
    text, n = "the cat", 30_000
    got = Counter(tuple(x.tolist()) for x in pieces.encode_texts([text] * n, np.arange(n).astype(np.uint64), vocab))
    weight = {}
    for i, w in zip(vocab["ids"], vocab["weights"]):
        s = vocab["start"][i]
        weight[bytes(vocab["bytes"][s:s + vocab["size"][i]])] = (int(i), w)

    def cuts(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            own = weight.get(rest[:k].encode())
            if own and " " not in rest[1:k]:
                for tail, total in cuts(rest[k:]):
                    yield (own[0], *tail), own[1] + total

    paths = dict(cuts(" " + text))
    whole = sum(math.exp(x) for x in paths.values())
    assert set(got) <= set(paths)
    for path, x in paths.items():
        p = math.exp(x) / whole
        assert abs(got[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-4


def test_rows_are_cut_alike_whatever_their_neighbours(vocab):
    texts = ["some text to be cut into pieces of words"] * 4 + ["other words"]
    keys = np.array([5, 6, 5, 7, 5], np.uint64)
    a = pieces.encode_texts(texts, keys, vocab)
    b = pieces.encode_texts(texts[::-1], keys[::-1].copy(), vocab)[::-1]
    assert all((x == y).all() for x, y in zip(a, b)) and (a[0] == a[2]).all()


def test_round_trip_over_the_table(spark):
    rows = pieces.round_trip(documents(spark))
    assert rows.count() == documents(spark).count() and rows.where("not lossless").count() == 0
    again = {r["doc_id"]: r["ids"] for r in pieces.round_trip(documents(spark).repartition(3)).collect()}
    assert again == {r["doc_id"]: r["ids"] for r in rows.collect()}


def test_awkward_rows(spark):
    rows = awkward(spark)
    got = pieces.round_trip(rows)
    assert got.count() == rows.count() and got.where("not lossless").count() == 0
    assert got.where("text is null and ids is not null").count() == 0
    assert pieces.encode(rows, out="piece_ids").columns == [*rows.columns, "piece_ids"]
    assert pieces.round_trip(empty(spark)).count() == 0


def test_long_words_are_cut_like_short_ones(monkeypatch):
    """The walk of a long word and the padded filter give the same pieces."""
    vocab = pieces._prepared(pieces.load())
    texts = ["unbrokenwordwithoutanyblankatall" * 3, "  x▁y\0z", "東京に行くことができます。" * 5, "aaaaaaaaaaaaaaaa aaaaaaa", "\n\nab"]
    keys = np.arange(len(texts)).astype(np.uint64)
    short = pieces.encode_texts(texts, keys, vocab)
    monkeypatch.setattr(pieces, "LONG_WORD", 0)
    long = pieces.encode_texts(texts, keys, vocab)
    assert [x.tolist() for x in short] == [x.tolist() for x in long]
    assert pieces.decode_ids(long, vocab) == texts


def test_text_without_blanks_in_linear_time():
    vocab = pieces._prepared(pieces.load())
    text = "".join(chr(0x4E00 + i * 7919 % 20000) + "ab" * (i % 3) for i in range(40_000))
    begin = time.process_time()
    ids = pieces.encode_texts([text], np.zeros(1, np.uint64), vocab)
    assert time.process_time() - begin < 20
    assert pieces.decode_ids(ids, vocab) == [text]


def test_only_runs_that_may_go_on_are_followed(vocab):
    """Every piece is found where it starts; most runs of characters end early."""
    words = ["tokenization", "▁the", "zzqxjkvzzqxj", "日本語", "e"]
    codes = np.array([ord(c) for c in "".join(words)], np.uint64)
    left = np.concatenate([np.arange(len(w), 0, -1) for w in words])
    found = {(int(a), k): int(vocab["ids"][r]) for k, (at, rank) in enumerate(pieces._pieces_at(codes, left, vocab), 1)
             for a, r in zip(at, rank)}
    text, expected = "".join(words), {}
    for a, room in enumerate(left.tolist()):
        for k in range(1, room + 1):
            if text[a:a + k] in vocab["table"]:
                expected[a, k] = vocab["table"][text[a:a + k]][0]
    assert found == expected and len(expected) > 15
    goes_on = vocab["filter"] & 2
    assert 0 < np.count_nonzero(goes_on) < 0.1 * len(goes_on)
