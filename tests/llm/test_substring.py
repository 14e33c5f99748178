import random

from valuescope.llm import substring as sub

from .helpers import awkward, documents, empty, texts


def _brute(rows):
    """Texts in key order; every span seen before is cut."""
    seen, out = set(), {}
    for key, text in rows:
        parts, gone = sub.sentences(text), set()
        assert "".join(text[p[0]:p[1]] for p in parts) == text
        for i, part in enumerate(parts):
            if not part[2]:
                continue
            n = filled = 0
            j, held = i, []
            while j < len(parts) and (n < sub.MIN_WORDS or filled < sub.MIN_SENTENCES):
                n, filled, held = n + parts[j][2], filled + bool(parts[j][2]), held + parts[j][3].split()
                j += 1
            if n >= sub.MIN_WORDS and filled >= sub.MIN_SENTENCES:
                if " ".join(held) in seen:
                    gone.update(range(i, j))
                seen.add(" ".join(held))
        out[key] = "".join(text[p[0]:p[1]] for i, p in enumerate(parts) if i not in gone)
    return out


def test_equals_brute_force(spark):
    rows = documents(spark)
    got = dict(texts(sub.dedup(rows)))
    assert got == _brute(texts(rows))
    assert got != dict(texts(rows))


def _prose(rng, n):
    out = []
    while n > 0:
        k = min(n, rng.randrange(4, 14))
        out.append(" ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(k)) + ".")
        n -= k
    return " ".join(out)


def test_planted_passages_leave_all_but_the_first(spark):
    rng = random.Random(2)
    passages = [_prose(rng, 70), " ".join(f"run{rng.randrange(10**6)}on" for _ in range(90))]
    rows = []
    for i in range(30):
        own = [_prose(rng, 60), _prose(rng, 40)]
        rows.append((i, own[0] + " and to " + passages[i % 2] + " " + own[1] if i < 20 else " ".join(own)))
    got = dict(texts(sub.dedup(spark.createDataFrame(rows, "doc_id long, text string"))))
    for i, text in rows:
        if i < 2 or i >= 20:
            assert got[i] == text
        else:
            left = got[i].split()
            assert len(left) <= len(text.split()) - 35
            held = set(passages[i % 2].split())
            assert sum(w in held for w in left) < 45
            assert text.split()[:50] == left[:50] and text.split()[-25:] == left[-25:]


def test_awkward_rows(spark):
    rows = awkward(spark)
    got = sub.dedup(rows, n_cut="n")
    assert got.columns == [*rows.columns, "n"]
    by_key = texts(got)
    assert len(by_key) == rows.count()
    one = "one two three four five six seven eight nine ten."
    assert [t for k, t in by_key if k == 1] == [one, one]       # a repeated row is the same document
    assert [t for k, t in by_key if k == 3] == [None] and [t for k, t in by_key if k == 2] == [""]
    assert [t for k, t in by_key if k == 7] == [""]             # a full copy of document 4
    (four,) = [t for k, t in by_key if k == 4]
    assert 0 < len(four) and sorted(t or "" for k, t in by_key if k == 6) == ["another text with the same key", "short"]
    assert sub.dedup(empty(spark)).count() == 0


def test_runs_of_white_space_take_linear_time():
    assert len(sub.sentences("a." + " " * 300_000 + "b" + "\n " * 100_000)) == 2


def test_passages_inside_running_text_leave_their_copies(spark):
    """51 to 60 words from and into the middle of sentences, against a brute force over words."""
    rng = random.Random(5)

    def running(n):  # sentences of up to 60 words
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) + ("." if rng.random() < 1 / 30 else "") for _ in range(n))

    rows = []
    for i in range(150):
        passage = running(51 + i % 10)
        rows += [(2 * i + k, f"{running(rng.randrange(20, 70))} x{i}{k} {passage} y{i}{k} {running(rng.randrange(20, 70))}") for k in (0, 1)]
    got = dict(texts(sub.dedup(spark.createDataFrame(rows, "doc_id long, text string"))))
    seen: set[tuple] = set()
    for key, text in rows:
        words = text.split()
        runs = [tuple(words[i:i + 51]) for i in range(len(words) - 50)]
        left = got[key].split()
        if any(run in seen for run in runs):
            assert 20 <= len(words) - len(left) <= 60
        else:
            assert got[key] == text
        seen.update(runs)
    assert len(seen) and sum(got[k] != t for k, t in rows) == 150


def _batches(rows, size):
    import pyarrow as pa

    kinds = [("_k", pa.int64()), ("d", pa.int64()), ("first", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())]
    for a in range(0, len(rows), size):
        yield pa.RecordBatch.from_pylist([dict(zip([n for n, _ in kinds], r)) for r in rows[a:a + size]], pa.schema(kinds))


def test_one_row_of_a_span_and_partition_keeps_its_hash():
    rows = sorted([(k, 10 + k, 3, 7, 7) for k in range(50)] + [(0, 10, 3, 7, 7), (4, 14, 9, 7, 8), (5, 15, 0, 8, 8)],
                  key=lambda r: (r[3], r[4], r[0], r[1], r[2]))
    for size in (1, 3, 20, 100):
        got = [tuple(r.values()) for b in sub._told_apart(_batches(rows, size)) for r in b.to_pylist()]
        # The row of key 0 is there twice: one document.
        assert [r for r in got if r[4] is not None] == [
            (0, 10, 3, 7, 7), (0, 10, 3, 7, 7), (4, 14, 9, 7, 8), (5, 15, 0, 8, 8)]
        assert [r for r in got if r[4] is None] == [(None, None, 3, 10 + k, None) for k in range(1, 50)]


def test_spans_cross_one_shuffle_and_are_not_written(spark, monkeypatch):
    written = []
    monkeypatch.setattr(sub, "pin", lambda df: written.append(df) or df)
    rows = documents(spark).repartition(5)
    got = dict(texts(sub.dedup(rows)))
    assert got == _brute(texts(rows))
    assert len(written) == 1 and written[0].columns == ["d", "cuts"]
