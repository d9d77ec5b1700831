"""Spelling variants against comparison of all pairs of words."""

import os
import random
import re
import sys
import zlib
from collections import Counter

import pytest

sys.path.insert(0, os.path.dirname(__file__))
from helpers import AWKWARD, frame, prose  # noqa: E402

from ledgerlake.llm import spelling  # noqa: E402

LOWER = {c: c + 32 for c in range(65, 91)}


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_groups(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1:] if h % 199 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: sorted((-words[v], v) for v in words if one_edit(w, v)) for w in words}
    form = {w: x[0][1] for w, x in near.items() if x and -x[0][0] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def corpus(seed=11):
    """Words with variants of falling frequency, chains of forms, ties, accents and long words."""
    rng = random.Random(seed)
    letters = "abcdeéñ÷×ß"
    base = ["".join(rng.choices(letters, k=rng.randint(5, 12))) for _ in range(60)] + ["aaaaaa", "aaaaaaa", "ababab", "ab" * 400]
    bag = []
    for k, w in enumerate(base):
        bag += [w] * (150 if k % 3 else 40)
        for depth in range(4):
            at = rng.randrange(len(w))
            w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice(letters) + w[at:],
                            w[:at] + rng.choice(letters) + w[at + 1:], w[1:] + "a", w[:-1], "b" + w])
            bag += [w] * rng.choice([5, 6, 29, 30, 31]) if depth < 2 else [w] * 5
    rng.shuffle(bag)
    rows = [(i, " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in bag[i::97])) for i in range(97)]
    return rows + rows[:2] + [(500 + i, prose(rng, 300)) for i in range(30)] + AWKWARD


@pytest.mark.parametrize("size,qmax", [(25_000, 3), (20, 3), (200, 5), (5, 7)])
def test_groups_equal_all_pairs(spark, monkeypatch, size, qmax):
    monkeypatch.setattr(spelling, "QMAX", qmax)
    monkeypatch.setattr(spelling, "LEAST_FREQUENT", 2)
    rows = corpus()
    got = [tuple(r) for r in spelling.spelling_groups(frame(spark, rows), size).collect()]
    want = plain_groups(rows)
    assert len(got) == len(want) and set(got) == want
    assert sum(r[1] is not None for r in want) > 30 and any(r[1] is not None and r[2] != r[1] for r in want)


def test_near_words_share_a_key():
    """Over all short words of two letters and every dictionary made of some of their grams."""
    rng = random.Random(3)
    words = ["".join("ab"[(i >> k) & 1] for k in range(n)) for n in (6, 7) for i in range(1 << n)]
    grams = sorted({f"^{w}$"[p:p + q] for w in words for p in range(8) for q in (2, 3)})
    for _ in range(4):
        frequent = {g for g in grams if rng.random() < 0.6}
        keys = {w: spelling.postings(w, frequent) for w in words}
        assert all(keys[a] & keys[b] for a in words for b in words if a < b and one_edit(a, b))


def test_empty_table_and_no_words(spark):
    assert spelling.spelling_groups(frame(spark, [(1, "x")]).limit(0)).collect() == []
    assert spelling.spelling_groups(frame(spark, [(1, None), (2, "")])).collect() == []
