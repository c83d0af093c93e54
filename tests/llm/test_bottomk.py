"""Bottom-k near duplicates against brute force over all pairs."""

from __future__ import annotations

import itertools
import random
import re
from math import comb

import numpy as np
import pyarrow as pa
import pytest

from threadline.llm import bottomk
from threadline.llm.inputs import ship
from threadline.llm.words import words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, row long, key string, n int"


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least: dict[int, list] = {}
    for i, (key, _) in enumerate(rows):
        least.setdefault(find(i), []).append(key)
    out = []
    for i, (key, _) in enumerate(rows):
        comp = min((x for x in least[find(i)] if x is not None), default=None)
        out.append((key, len(sets[i]), comp, key is not None and key == comp))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    texts: list[str | None] = [None, "", " \t", "one", "One", "one two", "a b c d", "a b c d e", "A b c d e f"]
    for n in (8, 30, 60, 100, 140, 400, 1500):
        for _ in range(3):
            base = [rng.choice(words) for _ in range(n)]
            for _ in range(rng.choice((2, 7, 25))):
                copy = list(base)
                for _ in range(rng.choice((0, 1, 1, n // 90, n // 60, n // 40, n // 25, n // 8))):
                    copy[rng.randrange(n)] = rng.choice(("edit", rng.choice(words)))
                texts.append(" ".join(copy))
            texts.append(" ".join(base[: n - n // 12]))
    passage = " ".join(rng.choice(words) for _ in range(60))
    texts += [passage + " " + " ".join(rng.choice(words) for _ in range(rng.randrange(3, 60))) for _ in range(30)]
    rng.shuffle(texts)
    out = [(5 * i + 2, t) for i, t in enumerate(texts)]
    return out + [out[4], out[4], (out[5][0], out[9][1]), (None, out[7][1]), (None, "only null ids have this text"), (None, None)]


@pytest.mark.parametrize("k", [96, 40])
def test_components(spark, rows, k):
    ship(spark)
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA).repartition(5)
    found = [tuple(r) for r in bottomk.near_duplicates(df, k=k).collect()]
    assert sorted(found, key=str) == brute(rows)


@pytest.mark.parametrize("crowd", [2, 8])
def test_crowds_and_shuffled_joins(spark, rows, monkeypatch, crowd):
    monkeypatch.setattr(bottomk, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(bottomk, "CROWD", crowd)
    monkeypatch.setattr(bottomk, "SMALL", 50 * crowd)
    df = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in bottomk.near_duplicates(df).collect()), key=str) == brute(rows)


def test_no_documents(spark):
    ship(spark)
    assert bottomk.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame([(None, None, 1, "x", 2)], SCHEMA)
    assert [tuple(r) for r in bottomk.near_duplicates(one).collect()] == [(None, 0, None, False)]


def test_bounds():
    m = bottomk.least_overlap(96)
    below = sum(comb(96, i) * 0.85**i * 0.15 ** (96 - i) for i in range(m))
    assert below <= bottomk.TAIL < below + comb(96, m) * 0.85**m * 0.15 ** (96 - m)
    rng = np.random.default_rng(1)
    for _ in range(200):
        x, y = (np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in "ab")
        union = sorted({*x.tolist(), *y.tolist()})[:10]
        assert bottomk.union_sketch(x[:10], y[:10], 10) == (len([u for u in union if u in x and u in y]), len(union))


def test_words_of_opposite_order_differ():
    """Long words whose letters stand in opposite Thue-Morse order have hashes of their own."""
    a = "".join("ab"[bin(i).count("1") & 1] for i in range(1024))
    b = a.translate({97: 98, 98: 97})
    h = words_of(pa.array([a, b, a, "ab", "ba", "a b"])).hashes
    assert h[0] == h[2] and len(set(h.tolist())) == 6
