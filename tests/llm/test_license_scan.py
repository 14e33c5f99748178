import random

import numpy as np
import pytest

from valuescope.llm import license_scan as ls

from .helpers import awkward, documents, empty


def _tokens(text):
    return [t.lower() for t in ls._TOKEN.findall((text or "").encode())]


def _shingles(tokens):
    return set(zip(*(tokens[k:] for k in range(ls.SHINGLE))))


def test_equals_brute_force_containment(spark):
    rows = documents(spark, "/root/testdata/sf0.01")
    got = {(r["doc_id"], r["license"]) for r in ls.scan(rows).collect()}
    templates = {n: _shingles(_tokens(t)) for n, t in ls.TEMPLATES.items()}
    expected = set()
    for r in rows.collect():
        own = _shingles(_tokens(r["text"]))
        expected |= {(r["doc_id"], n) for n, s in templates.items() if len(s & own) >= ls.CONTAINMENT * len(s)}
    assert got == expected and expected


def test_edited_templates_are_found_and_regions_hold_them():
    rng = random.Random(3)
    compiled = ls.compile_templates(ls.TEMPLATES)
    found = total = 0
    for _ in range(300):
        name = rng.choice(list(ls.TEMPLATES))
        words = ls.TEMPLATES[name].split()
        for _ in range(len(words) // 60):
            words[rng.randrange(len(words))] = "zzz"
        text = " ".join([f"w{rng.randrange(999)}" for _ in range(rng.randrange(150))] + words
                        + [f"w{rng.randrange(999)}" for _ in range(rng.randrange(150))])
        wanted = _shingles(_tokens(ls.TEMPLATES[name]))
        if len(wanted & _shingles(_tokens(text))) < ls.CONTAINMENT * len(wanted):
            continue
        total += 1
        data = np.frombuffer(text.encode(), np.uint8)
        h, a, b = ls._word_hashes(data, ls._inverse_powers(len(data) + 1))
        matches = {m[0]: m for m in ls.scan_text(text.encode(), h, a, b, compiled, ls.CONTAINMENT)}
        if name in matches:
            found += 1
            _, share, low, high = matches[name]
            region = _shingles(_tokens(text.encode()[low:high].decode()))
            assert len(region & wanted) / len(wanted) == pytest.approx(share)
    assert total > 200 and found >= 0.99 * total


def test_collision_chance_of_the_bands():
    assert ls.collision_chance(0.6) > 0.9999


def test_awkward_rows(spark):
    rows = awkward(spark).union(awkward(spark).limit(0))
    assert ls.scan(rows).count() == 0
    hit = rows.selectExpr("doc_id", "concat(coalesce(text, ''), ' Released under the MIT License. ', coalesce(text, '')) text")
    got = ls.scan(hit).collect()
    assert len(got) == hit.count() and {r["license"] for r in got} == {"MIT-line"}
    assert ls.scan(empty(spark)).count() == 0


def test_every_copy_of_a_notice_is_a_region():
    rng = random.Random(6)
    compiled = ls.compile_templates(ls.TEMPLATES)
    for name, template in ls.TEMPLATES.items():
        for gap in (0, 3, 200):
            between = " ".join(f"w{rng.randrange(999)}" for _ in range(gap))
            text = "start here " + f" {between} ".join([template] * 4) + " and end"
            data = np.frombuffer(text.encode(), np.uint8)
            h, a, b = ls._word_hashes(data, ls._inverse_powers(len(data) + 1))
            got = [m[1:] for m in ls.scan_text(text.encode(), h, a, b, compiled, ls.CONTAINMENT) if m[0] == name]
            assert len(got) == 4 and all(share == 1.0 for share, _, _ in got), (name, gap)
            assert all(x[2] <= y[1] for x, y in zip(got, got[1:]))
            wanted = _shingles(_tokens(template))
            assert all(_shingles(_tokens(text.encode()[x:y].decode())) >= wanted for _, x, y in got)
