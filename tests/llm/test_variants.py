"""Operator 13 against brute force, its parts, and its defined cases."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notecodes.llm import variants

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute_counts(rows, edited=199, least=6):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % edited == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= least:
                n[run] += 1
    return n


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, edited=199, least_count=5, factor=5):
    n = {w: c for w, c in brute_counts(rows, edited).items() if c >= least_count}
    others = {w: [o for o in n if near(w, o)] for w in n}
    form = {}
    for w, found in others.items():
        best = min(found, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), None if form[w] is None else n[form[w]]))
    return sorted(out)


def grouped(spark, rows, **more):
    return sorted(tuple(r) for r in variants.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string"), **more).collect())


def misspelt(rng, word):
    i = rng.randrange(len(word))
    return rng.choice([word[:i] + word[i + 1:], word[:i] + rng.choice("aeiouéß") + word[i:], word[:i] + rng.choice("aeiouéß") + word[i + 1:]])


def corpus(seed=3):
    rng = random.Random(seed)
    base = ["".join(rng.choices("abcdeflmnorsté", k=rng.randint(5, 11))) for _ in range(60)]
    wrong = [misspelt(rng, w) for w in base for _ in range(4)]
    wrong += [misspelt(rng, w) for w in wrong[::3]]
    pool = base * 40 + wrong * 6 + wrong[::2] * 3
    rng.shuffle(pool)
    return [(i, " ".join(pool[k:k + 50])) for i, k in enumerate(range(0, len(pool), 50))]


@pytest.mark.parametrize("edited", [199, 3])
def test_equals_brute_force(spark, edited):
    rows = corpus()
    want = brute(rows, edited)
    assert any(r[1] for r in want)
    assert grouped(spark, rows, edited=edited) == want


def test_defined_cases(spark):
    long = "".join(random.Random(1).choices("abcé", k=700))
    odd = ["aaaaaab", "aaaaab", "aaaaaaab", "ÀÀÀbcdef", "ààbcdef", "àbcdefg", "stra×ße÷", "don't,stop", "日本ünïcödé日本", "abcdef1ghijkl", "x" * 64, "x" * 63, "x" * 65, "x" * 66, long, long[:300] + long[301:]]
    rows = [(i, " ".join(odd)) for i in range(9)] + [(None, " ".join(odd)), (None, None), (3, ""), (4, "  \n")]
    rows += [(i, "aaaaab " * 40 + long + " " + "y" * 5000) for i in range(30)]
    rows += rows[:12]  # repeated rows count as often
    assert grouped(spark, rows) == brute(rows)


def test_ties_go_to_the_smaller_word(spark):
    rows = [(1, "bbcdef " * 30 + "abcdef " * 30 + "zbcdef " * 5)]
    want = brute(rows, 1 << 40)
    assert [r for r in want if r[0] == "zbcdef"] == [("zbcdef", "abcdef", "abcdef", 5, 2, 30)]
    assert grouped(spark, rows, edited=(1 << 32) - 1) == want


def test_chain_of_forms(spark):
    words = {"abcdefg": 5 ** 5, "abcdefgh": 5 ** 4, "abcdefghi": 5 ** 3, "abcdefghij": 5 ** 2, "abcdefghijk": 5}
    rows = [(1, " ".join(w for w, n in words.items() for _ in range(n)))]
    got = grouped(spark, rows, edited=(1 << 32) - 1)
    assert {r[2] for r in got} == {"abcdefg"} and got == brute(rows, 1 << 40)


def test_empty_table_and_extra_columns(spark):
    assert grouped(spark, []) == []
    rows = corpus(8)[:6]
    more = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "id", "key", "root")})
    assert sorted(tuple(r) for r in variants.spelling_variants(more, least_count=2).collect()) == brute(rows, least_count=2)


def test_run_crcs():
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 5000).astype(np.uint8)
    start = np.sort(rng.integers(0, 4000, 50))
    end = start + np.concatenate((rng.integers(0, 70, 45), [64, 65, 200, 900, 0]))
    state = np.array([zlib.crc32(f"{i}:".encode()) for i in range(50)], np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(start, end, state)]
    assert variants.run_crcs(data, start, end, state).tolist() == want


def test_digests_meet_like_texts(monkeypatch):
    words = ["aaab", "aab", "abab", "ababb", "babab", "ééa"]
    plain = {(w, k) for w in words for k, _, _ in variants.prefixes(w)}
    monkeypatch.setattr(variants, "LONGEST", 0)
    digest = [[k for k, _, _ in variants.prefixes(w)] for w in words]
    monkeypatch.setattr(variants, "LONGEST", 64)
    text = [[k for k, _, _ in variants.prefixes(w)] for w in words]
    flat = {}
    for d, t in zip(sum(digest, []), sum(text, [])):
        assert flat.setdefault(t, d) == d
    assert len(set(flat.values())) == len(flat) == len({k for _, k in plain})
