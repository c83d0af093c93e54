"""Periodic runs against the definition, word by word."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from threadline.llm import runs
from threadline.llm.inputs import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """(start, length, period) of all runs: every period, every maximal stretch, smallest period only."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            begin = i
            while i < n and words[i] == words[i - q]:
                i += 1
            start, length = begin - q, i - begin + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words):
    gone = {i for s, length, q in brute(words) for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


TEXTS = [
    None, "", " \n", "a", "a a a a a", "a a a a a a", "a b a b a b a", "a b a b a b a b", "x a b c a b c a b c a b c y",
    "a a a a a a b a a a a a a b a a a a a a b a a a a a a b", "a\x0ba\ta\ra\na a a a a", "é é é é é é É", "b a a a a a a a b " * 5,
    "a " * 3000, "a b " * 1000 + "c " + "b a " * 900, " ".join(str(i % 700) for i in range(4000)), " ".join(str(i % 1001) for i in range(4003)),
    "a b a b a b a b a b b a b b a b b a b b a b", "a a b " * 3 + "a a", "a a b " * 4,
]


def test_numbers_against_brute_force():
    rng = random.Random(4)
    for _ in range(400):
        texts = []
        for _ in range(rng.randrange(1, 6)):
            words = [rng.randrange(rng.choice((1, 2, 3, 9))) for _ in range(rng.randrange(0, 60))]
            if rng.random() < 0.6 and words:
                p = rng.randrange(1, len(words) + 1)
                words = (words[:rng.randrange(len(words))] + words[:p] * rng.randrange(1, 7))[:120]
            texts.append(words)
        first = np.cumsum([0, *map(len, texts)])
        found = runs.periodic_runs(np.array([w for t in texts for w in t], dtype=np.int64), first).tolist()
        assert found == [[i, *r] for i, t in enumerate(texts) for r in brute(t)]


def test_no_texts():
    assert len(runs.periodic_runs(np.zeros(0, dtype=np.int64), np.array([0]))) == 0


def test_find_runs(spark, monkeypatch):
    ship(spark)
    rows = [(i if i % 7 else None, t, "c", 0) for i, t in enumerate(TEXTS)] + [(3, "a a a a a a", "c", 0)] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string, n_words int")
    found = runs.find_runs(df).collect()
    want = []
    for key, text, _, _ in rows:
        words = WORD.findall(text or "")
        want.append((key, len(words), brute(words), collapsed(words)))
    got = [(r["doc_id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert runs.find_runs(df.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 50, 1 << 20])
def test_slices(monkeypatch, size):
    import pyarrow as pa

    monkeypatch.setattr(runs, "_SLICE_BYTES", size)
    batch = pa.record_batch({"doc_id": pa.array(range(len(TEXTS))), "text": pa.array(TEXTS)})
    out = [x for part in runs._each([batch, batch.slice(0, 0)]) for x in part.column("collapsed").to_pylist()]
    assert out == [collapsed(WORD.findall(t or "")) for t in TEXTS]


def test_query_rebuilds_the_tails(spark, tmp_path):
    import zlib

    from threadline.llm.queries import op12_periodic_runs

    rows = [(i, " ".join(f"w{(i * j) % 97}" for j in range(i % 90))) for i in range(300)] + [(None, "a a a a a a"), (990, None), (12, " \t")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want, hit = [], 0
    for key, text in rows:
        words, h = WORD.findall(text or ""), None if key is None else zlib.crc32(str(key).encode())
        if h is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, hit = [words[i if i < a else a + (i - a) % p] for i in range(n)], hit + 1
        found = brute(words)
        best = max(found, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None, None, None))
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in found)
        want.append((key, len(found), *best, None if best[0] is None else best[1] * 1000 // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words).encode()).hexdigest()))
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    assert hit > 20 and sorted(got, key=str) == sorted(want, key=str)
