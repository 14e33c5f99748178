import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from valuescope.llm import align, queries

from .helpers import awkward, documents, empty


@pytest.fixture(scope="module")
def tok():
    return align.Tokenizers()


def _whole(tok, text):
    """Tokens of a whole text, not cut into stretches, as the libraries give them."""
    if not text:
        return [], []
    want = (" " + text).encode()
    a, b = tok.a.encode(" " + text, add_special_tokens=False).ids, tok.b.encode(text)
    if b"".join(tok.bytes_a[i] for i in a) != want or b"".join(tok.bytes_b[i] for i in b) != want:
        return [], []
    return a, b


def _spans(ids, table):
    out, at = [], 0
    for i in ids:
        out.append((at, at + len(table[i]), i))
        at = out[-1][1]
    return out


def _taken(spans, end):
    """Takes the spans (last first) that end by ``end``."""
    out = []
    while spans and spans[-1][1] <= end:
        out.append(spans.pop())
    return out


def _brute(tok, rows):
    """[(key, n_a, n_b, n_groups, n_links, n_best, count_sum, sha)] by comparing all byte ranges."""
    made, total = [], Counter()
    for key, text in rows:
        a, b = _whole(tok, text)
        sa, sb = _spans(a, tok.bytes_a), _spans(b, tok.bytes_b)
        ends = sorted({e for _, e, _ in sa} & {e for _, e, _ in sb})
        links, groups = Counter(), []
        pa, pb = sa[::-1], sb[::-1]
        for high in ends:
            ga, gb = (_taken(x, high) for x in (pa, pb))
            links.update((i, j) for s, e, i in ga for t, f, j in gb if max(s, t) < min(e, f))
            groups.append(",".join(str(i) for *_, i in ga) + "|" + ",".join(str(j) for *_, j in gb))
        total.update(links)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        made.append((key, len(a), len(b), len(groups), links, sha))
    top = Counter()
    for (_, j), n in total.items():
        top[j] = max(top[j], n)
    return [(key, na, nb, ng, sum(links.values()), sum(n for p, n in links.items() if total[p] == top[p[1]]),
             sum(n * total[p] for p, n in links.items()), sha) for key, na, nb, ng, links, sha in made]


def _same(df, expected):
    order = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in df.collect()), key=order) == sorted(expected, key=order)


TEXTS = ["plain words, and some more.", "It's   spaced \n\n out\tand  'quoted'", "Größe naïve 東京に行く 한국어 текст",
         "emoji \U0001F600\U0001F468‍\U0001F469 x", "▁literal blank mark", "<|endoftext|> and <s> are text </s>",
         " leading space", "\nleading line end", "trailing space ", "\x1c odd\x85white　space ​", "a", " ",
         "é combining", "12345 1,000.50 x_y-z", "\x00 zero", "  ", "ꙮ 𐍈 ᠎ ﻿", "aaaaaaaa" * 40]


def test_equals_brute_force_on_odd_texts(spark, tok):
    rows = list(enumerate(TEXTS + TEXTS[:3]))
    _same(align.align(spark.createDataFrame(rows, "doc_id long, text string")), _brute(tok, rows))


def test_query_equals_brute_force(spark, tok):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark).collect()]
    out = queries.op11_tokenizer_alignment(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    _same(out, _brute(tok, rows))


def test_stretches_are_tokenized_as_in_the_whole_text(tok):
    """Both tokenizers end a token at every cut, whatever stands around it (texts with
    U+2581 have no tokens)."""
    rng = random.Random(11)
    alphabet = "aB é1'’.,-_ \n\t\x85\xa0　東я\U0001F600<s>"
    for _ in range(400):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 40)))
        cut = align.stretches(text)
        assert "".join(cut) == " " + text
        assert sum(tok.encode_a(cut), []) == tok.a.encode(" " + text, add_special_tokens=False).ids
        assert sum(tok.encode_b(cut), []) == tok.b.encode(text)


def test_lockstep_on_random_cuts():
    rng = np.random.default_rng(3)
    size_a, size_b, at_a, at_b, expected = [], [], [0], [0], []
    for u in range(50):
        n = int(rng.integers(0, 30))
        ends = [sorted({*rng.integers(1, n, rng.integers(0, 8)).tolist(), n}) if n > 1 else [n] * (n == 1) for _ in "ab"]
        spans = [list(zip([0, *e], e)) for e in ends]
        for i, (s, e) in enumerate(spans[0]):
            for j, (t, f) in enumerate(spans[1]):
                if max(s, t) < min(e, f):
                    expected.append((u, at_a[-1] + i, at_b[-1] + j, e == f))
        for sizes, at, x in ((size_a, at_a, spans[0]), (size_b, at_b, spans[1])):
            sizes += [e - s for s, e in x]
            at.append(len(sizes))
    got = align.lockstep(*(np.array(x, np.int64) for x in (size_a, at_a, size_b, at_b)))
    assert sorted(zip(*(x.tolist() for x in got))) == sorted(expected)


def test_worker_forgets_stretches(spark, tok, monkeypatch):
    monkeypatch.setattr(align, "HELD_STRETCHES", 3)
    merged = align.Merged(tok)
    counts, digests, pairs, times = align.align_texts(["one two", None, "", "one one"], merged)
    assert counts[:, 0].tolist() == [2, 0, 0, 2] and digests[1] == digests[2] == ""
    assert [t.tolist() for t in times] == [[1, 1], [], [], [2]]
    again = align.align_texts(["one two"], merged)
    assert again[0].tolist() == counts[:1].tolist() and (again[2][0] == pairs[0]).all()


def test_awkward_rows(spark, tok):
    rows = [(r["doc_id"], r["text"]) for r in awkward(spark).collect()]
    _same(align.align(awkward(spark)), _brute(tok, rows))
    assert align.align(empty(spark)).count() == 0


def test_group_texts_show_the_ids_of_every_group():
    class Sized:
        size_a, size_b = np.zeros(9), np.zeros(7)
        shown = [f"{i}{e}" for i in range(9) for e in ",|"] + [f"{i}{e}" for i in range(7) for e in ",;"]

    made = [[([8], [0, 1]), ([2, 3, 4], [5])], [], [([1], [6])]]
    flat_a = [i for groups in made for a, _ in groups for i in a]
    flat_b = [i for groups in made for _, b in groups for i in b]
    last_a, last_b = (np.cumsum([len(g[k]) for groups in made for g in groups]) - 1 for k in (0, 1))
    tokens = np.array([sum(len(a) + len(b) for a, b in groups) for groups in made])
    assert align.group_texts(Sized, np.array(flat_a), np.array(flat_b), last_a, last_b, tokens) == [
        "8|0,1;2,3,4|5;", "", "1|6;"]
    nothing = np.zeros(0, np.int64)
    assert align.group_texts(Sized, nothing, nothing, nothing, nothing, np.zeros(1, np.int64)) == [""]
