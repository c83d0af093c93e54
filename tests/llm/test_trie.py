"""The prefix trie against a plain dictionary of prefixes, with blocks of every size."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from threadline.llm import trie
from threadline.llm.inputs import ship

SCHEMA = "conv_id long, turn long, role string, text string, depth string, prefix int"


def brute(built):
    """Rows of every node from {conv_id: [(role, text), ...]}."""
    members: dict[tuple, list[int]] = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    rows = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in members)]
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below if q)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(built[c]) == len(p)))
        rows.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def conversations(rows):
    out: dict[int, list] = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            out.setdefault(c, []).append((turn, role or "", text or ""))
    digest = lambda r, t: hashlib.md5(f"{len(r)}:{r}{t}".encode()).hexdigest()
    return {c: [(r, t) for _, r, t in sorted(s, key=lambda x: (x[0] is not None, x[0] or 0, digest(*x[1:])))] for c, s in out.items()}


@pytest.fixture(scope="module")
def said():
    rng = random.Random(8)
    rows = []
    for c in range(-6, 70):
        for k in range(rng.choice((1, 2, 3, 3, 9))):
            text = rng.choice(("hi", "hi", "ho", "é", "", None)) if k < 3 else rng.choice("xyz")
            rows.append((c, k if rng.random() < 0.9 else None, rng.choice(("user", "user", None, "")), text, "d", 1))
    same = [("user", "hi"), ("bot", "long answer"), ("user", "ok")]
    rows += [(c, k, *same[k], "d", 1) for c in range(100, 140) for k in range(3)]
    return rows + [rows[0], rows[0], (None, 0, "user", "lost", "d", 1), (500, None, None, None, "d", 1)]


@pytest.mark.parametrize("block_bytes", [1, 150, 1 << 20])
def test_trie(spark, said, block_bytes):
    ship(spark)
    df = spark.createDataFrame(said, SCHEMA).repartition(3)
    found = trie.prefix_trie(trie.sequences(df), block_bytes=block_bytes)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(conversations(said))


def test_turnless_and_none(spark):
    ship(spark)
    seqs = spark.createDataFrame([(3, None), (1, []), (2, None)], "conv_id long, turns array<struct<digest: string, size: bigint>>")
    for block_bytes in (1, 1000):
        row = trie.prefix_trie(seqs, block_bytes=block_bytes).collect()
        assert [tuple(r) for r in row] == [(1, 0, None, 3, 0, 1, 0, hashlib.sha256(b"1,2,3").hexdigest())]
    assert trie.prefix_trie(seqs.limit(0)).count() == 0
    assert trie.trie_of(spark.createDataFrame([], SCHEMA)).count() == 0


def test_range_minimum_searches_both_ways():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 7, 64, 100):
        values = rng.integers(-1, 6, n)
        table = trie.RangeMinimum(values)
        start, least = (x.ravel() for x in np.meshgrid(np.arange(-1, n), np.arange(0, 7)))
        left = [max((j for j in range(s + 1) if values[j] < k), default=-1) for s, k in zip(start, least)]
        assert table.left(start, least).tolist() == left
        start = start + 1
        assert table.right(start, least).tolist() == [next((j for j in range(s, n) if values[j] < k), n) for s, k in zip(start, least)]


def test_ids_of_a_list_over_many_blocks(spark, monkeypatch):
    ship(spark)
    monkeypatch.setattr(trie, "_PIECE", 3)
    digest = hashlib.md5(b"x").hexdigest()
    seqs = spark.createDataFrame([(c, [(digest, 5)]) for c in range(95, 1205)], "conv_id long, turns array<struct<digest: string, size: bigint>>")
    rows = {r["depth"]: r for r in trie.prefix_trie(seqs, block_bytes=4000).collect()}
    assert rows[1]["ends_sha256"] == hashlib.sha256(",".join(map(str, range(95, 1205))).encode()).hexdigest()
    assert (rows[1]["n_convs"], rows[1]["saved_tokens"], rows[0]["n_children"]) == (1110, 1109 * 5, 1)


def test_query_rebuilds_heads(spark, said, tmp_path):
    from threadline.llm.queries import op13_prefix_trie

    spark.createDataFrame(said, SCHEMA).drop("depth", "prefix").write.parquet(f"{tmp_path}/conversations.parquet")
    own = conversations(said)
    built = {}
    for c, s in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = own.get(base, [])[:h] + s[h:]
    found = op13_prefix_trie(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(built)
