"""Periodic runs: stretches of words that repeat with a short period, by a sparse diagonal pass.

A run with period q is a diagonal: word i equals word i - q for each word after
the first q. For each word its earlier occurrences name the diagonals (lags) it
lies on; a lag that the word before had too goes on, any other begins anew, and
a diagonal that ends long enough is a run at once. Only words that occur again
take part, so the pass is sparse.

Words that occur very often would lie on as many diagonals as they have earlier
occurrences. The pass is therefore made for blocks of g = 1, 2, 4, … words that
start at each word, and each block takes its latest earlier occurrence only.
That loses nothing: inside a run with smallest period q, a block of g >= q
words has its latest occurrence exactly q words before (a nearer one would give
the run a smaller period), so the pass with g / 2 < q <= g sees the run as one
unbroken diagonal, from its (q+1)-th word to its last block. Four periods are
longer than q + g, so no run is too short to be seen. Blocks are named by the
names of their halves, exactly, and only blocks whose halves both occur again
go on, so a text of n words costs about n and a long run n log n.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from threadline.llm.arrow import take

LEAST_LENGTH, LEAST_PERIODS = 6, 4
_SLICE_BYTES = 2 << 20  # text handled at once; a longer text is handled alone

SCHEMA = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start, period.

    ``ids`` are the words of several texts as numbers, ``first[t]:first[t + 1]``
    those of text t; starts count from the text's first word.
    """
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][text]
    at, key, g = np.arange(len(ids)), text * (int(ids.max(initial=0)) + 1) + ids, 1
    found = [np.zeros((0, 4), dtype=np.int64)]
    while len(at):
        order = np.argsort(key, kind="stable")
        again = key[order][1:] == key[order][:-1]
        # The diagonal of each block that has an earlier occurrence, in word order.
        lag = np.zeros(len(ids), dtype=np.int64)
        lag[at[order[1:][again]]] = at[order[1:][again]] - at[order[:-1][again]]
        on = np.flatnonzero(lag)
        begins = np.ones(len(on), dtype=bool)
        begins[1:] = (np.diff(on) > 1) | (np.diff(lag[on]) != 0)
        start_at = np.flatnonzero(begins)
        last = np.append(start_at[1:], len(on)) - 1 if len(on) else start_at
        period = lag[on[start_at]]
        start = on[start_at] - period
        length = on[last] + g - start
        ok = (2 * period > g) & (period <= g) & (length >= np.maximum(LEAST_LENGTH, LEAST_PERIODS * period))
        owner = text[start[ok]]
        found.append(np.stack([owner, start[ok] - first[owner], length[ok], period[ok]], axis=1))
        # Blocks of twice as many words, where both halves occur again.
        name = np.full(len(ids), -1, dtype=np.int64)
        repeated = np.zeros(len(at), dtype=bool)
        repeated[order[1:][again]] = repeated[order[:-1][again]] = True
        name[at[order]] = np.cumsum(np.append(True, ~again))
        name[at[~repeated]] = -1
        at = at[repeated]
        at = at[at + 2 * g <= end[at]]
        at = at[name[at + g] >= 0]
        key = name[at] * (len(ids) + 2) + name[at + g]
        g *= 2
    rows = np.concatenate(found)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def _slice(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
    """Runs and collapsed text of some rows."""
    # bytes.split() parts at exactly the bytes 9 to 13 and 32.
    words = [(t or "").encode("utf-8").split() for t in texts.to_pylist()]
    number: dict[bytes, int] = {}
    first = np.cumsum([0, *map(len, words)])
    numbers = np.fromiter((number.setdefault(w, len(number)) for ws in words for w in ws), dtype=np.int64, count=first[-1])
    rows = periodic_runs(numbers, first)
    runs: list[list[dict]] = [[] for _ in words]
    dropped: dict[int, np.ndarray] = {}
    for t, start, length, period in rows.tolist():
        runs[t].append({"start": start, "length": length, "period": period})
        edge = dropped.setdefault(t, np.zeros(len(words[t]) + 1, dtype=np.int64))
        edge[start + period] += 1
        edge[start + length] -= 1
    kept = [b" ".join(ws if t not in dropped else compress(ws, np.cumsum(dropped[t])[:-1] == 0)) for t, ws in enumerate(words)]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
    return pa.record_batch({
        "doc_id": ids, "n_words": pa.array(np.diff(first), pa.int64()), "runs": pa.array(runs, kind),
        "collapsed": pa.array([k.decode("utf-8") for k in kept], pa.string()),
    })


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0), batch.column(1)
        sizes = np.append(0, np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64))
        lo = 0
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + _SLICE_BYTES, side="right")) - 1)
            yield _slice(ids.slice(lo, hi - lo), texts.slice(lo, hi - lo))
            lo = hi


def find_runs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period) and collapsed of each row.

    Words are runs of characters other than space and the controls 9 to 13, of
    the whole text, unchanged. A run is a stretch of words with smallest period
    q, at least ``max(6, 4 q)`` words long, that neither neighbour extends.
    ``collapsed`` has all words but those after the first q of a run, one space
    between them. Null and empty texts have no words, no runs and an empty
    collapsed text. Each row is handled on its own, so repeated rows and equal or
    null ids give a result each; other columns do not take part. An empty table
    gives an empty result.
    """
    return take(df, doc_id=doc_id, text=text).mapInArrow(_each, SCHEMA)
