"""Quality classifier: random Fourier features over document statistics, ridge, isotonic calibration.

Statistics of a text are a short vector. Each is stored as a whole number of
millionths, and each random feature as a whole number of 4096ths, so that the
sums over tasks (means, deviations, normal equations) are exact and a rerun
gives the same model whatever the order of addition. What reaches the driver
has a size fixed by the parameters: two sums per statistic, the normal
equations, and one row per calibration step.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadline.llm.arrow import texts_of
from threadline.plans.scratch import Scratch

_MILLION = 1_000_000
_GRID = 4096
_STEPS = 2048  # raw scores are calibrated on so many steps

STATISTICS = (
    "log words", "log mean word length", "letters", "upper case", "digits", "space", "line breaks", "bars", "exclamation",
    "full stops and commas", "other signs", "distinct words", "largest word share", "repeated neighbours",
    "repeated lines", "words ending in a sign", "words of capitals", "words without letters", "distinct characters", "longest word",
)


def _kind_table() -> np.ndarray:
    """0 letter, 1 upper-case letter, 2 digit, 3 space, 4 other, for characters below 2**16."""
    table = np.full(1 << 16, 4, dtype=np.uint8)
    for i in range(1 << 16):
        category = unicodedata.category(chr(i))
        if category == "Lu":
            table[i] = 1
        elif category[0] == "L":
            table[i] = 0
        elif category[0] == "N":
            table[i] = 2
        elif category[0] == "Z" or 9 <= i <= 13:
            table[i] = 3
    return table


_KINDS: list[np.ndarray] = []


def statistics(text: str) -> list[float]:
    """The statistics of one text, each of them bounded; an empty text has zeros."""
    if not _KINDS:
        _KINDS.append(_kind_table())
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kinds = np.bincount(_KINDS[0][np.minimum(codes, 0xFFFF)], minlength=5)
    ascii_counts = np.bincount(np.minimum(codes, 128), minlength=129)
    n, m = len(codes), len(words)
    seen = Counter(words)
    lines = [x for x in text.split("\n") if x]
    points = int(ascii_counts[46] + ascii_counts[44])
    bars, shouts = int(ascii_counts[124]), int(ascii_counts[33])
    last = [w[-1] for w in words]
    tails = sum(1 for c in last if not c.isalnum() and c not in ".,;:'\"?)")
    capitals = sum(map(str.isupper, words))
    bare = sum(1 for w in words if not any(map(str.isalpha, w)))
    letters = int(kinds[0] + kinds[1])
    return [
        np.log1p(m), np.log1p(n / m), letters / n, kinds[1] / max(letters, 1), kinds[2] / n, kinds[3] / n,
        len(lines) / m, bars / m, min(shouts / m, 4.0), points / m, min((kinds[4] - points - bars - shouts) / m, 8.0),
        len(seen) / m, max(seen.values()) / m, sum(a == b for a, b in zip(words, words[1:])) / m,
        1 - len(set(lines)) / max(len(lines), 1), tails / m, capitals / m, bare / m,
        np.log1p(np.count_nonzero(ascii_counts)), np.log1p(max(map(len, seen))),
    ]


def with_statistics(df: DataFrame, text: str, key: str = "doc_id") -> DataFrame:
    """Key and statistics (millionths, array of long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                rows = [np.rint(np.array(statistics(t)) * _MILLION).astype(np.int64) for t in texts_of(part.column(1))]
                yield pa.record_batch({"doc_id": part.column(0), "stats": pa.array(rows, pa.list_(pa.int64()))})

    return df.select(F.col(f"`{key}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, stats array<long>"
    )


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray  # [statistics, features]
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray  # calibrated score of each step of the raw score
    low: float
    high: float

    def features(self, stats: np.ndarray) -> np.ndarray:
        """Random features as whole 4096ths, the last one constant."""
        x = np.clip((stats / _MILLION - self.mean) / self.scale, -8, 8)
        z = np.rint(np.cos(x @ self.directions + self.phases) * _GRID)
        return np.hstack([z, np.full((len(z), 1), float(_GRID))])

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights / _GRID

    def step(self, stats: np.ndarray) -> np.ndarray:
        at = (self.raw(stats) - self.low) / (self.high - self.low) * (_STEPS - 1)
        return np.clip(np.rint(at), 0, _STEPS - 1).astype(np.int64)

    def score(self, stats: np.ndarray) -> np.ndarray:
        return self.steps[self.step(stats)]


def isotonic(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence nearest to ``values`` (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for v, w in zip(values, weights):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            b, a = blocks.pop(), blocks.pop()
            total = a[1] + b[1]
            blocks.append([(a[0] * a[1] + b[0] * b[1]) / total, total, a[2] + b[2]])
    return np.concatenate([np.full(int(n), v) for v, _, n in blocks]) if blocks else np.zeros(0)


def _matrix(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in rows:
        if batch.num_rows:
            stats = np.stack([np.asarray(x, dtype=np.float64) for x in batch.column(0).to_pylist()])
            yield stats, batch.column(1).to_numpy(zero_copy_only=False).astype(np.float64)


def fit(labelled: DataFrame, features: int = 192, width: float = 4.0, ridge: float = 1e-3, seed: int = 7) -> Model:
    """Fit on a frame of (stats array<long>, label 0/1).

    ``width`` is the kernel's width in standard deviations. Without rows every
    text scores 0.5; with one class only, the share of that class.
    """
    d = len(STATISTICS)
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(d, features)) / width
    phases = rng.uniform(0, 2 * np.pi, features)
    one = labelled.select(F.count("*").alias("n"), *[F.sum(F.col("stats")[i]).alias(f"a{i}") for i in range(d)],
                          *[F.sum((F.col("stats")[i] / 1000).cast("decimal(20,0)") * (F.col("stats")[i] / 1000).cast("decimal(18,0)")).alias(f"b{i}") for i in range(d)]).first()
    n = one["n"]
    empty = Model(np.zeros(d), np.ones(d), directions, phases, np.zeros(features + 1), np.full(_STEPS, 0.5), 0.0, 1.0)
    if not n:
        return empty
    mean = np.array([one[f"a{i}"] / n / _MILLION for i in range(d)])
    square = np.array([float(one[f"b{i}"]) / n / 1e6 for i in range(d)])
    scale = np.maximum(np.sqrt(np.maximum(square - mean**2, 0)), 1e-3)
    base = Model(mean, scale, directions, phases, np.zeros(features + 1), empty.steps, 0.0, 1.0)
    size = features + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, right = np.zeros((size, size), dtype=np.int64), np.zeros(size, dtype=np.int64)
        for stats, label in _matrix(batches):
            z = base.features(stats)
            gram += np.rint(z.T @ z).astype(np.int64)
            right += np.rint(z.T @ label).astype(np.int64)
        upper = np.triu_indices(size)
        values = np.concatenate([gram[upper], right])
        yield pa.record_batch({"cell": pa.array(np.arange(len(values)), pa.int32()), "value": pa.array(values, pa.int64())})

    # One row per cell of the normal equations, whatever the number of documents.
    cells = labelled.select("stats", "label").mapInArrow(sums, "cell int, value long")
    total = cells.groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    values = np.zeros(len(total))
    for r in total:
        values[r["cell"]] = float(r["value"])
    gram = np.zeros((size, size))
    upper = np.triu_indices(size)
    gram[upper] = values[: len(upper[0])]
    gram = np.triu(gram) + np.triu(gram, 1).T
    right = values[len(upper[0]) :] / _GRID
    weights = np.linalg.solve(gram / _GRID**2 / n + ridge * np.eye(size), right / n)
    weights = np.round(weights, 9)
    raw = Model(mean, scale, directions, phases, weights, empty.steps, -0.25, 1.25)

    def steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = np.zeros((2, _STEPS), dtype=np.int64)
        for stats, label in _matrix(batches):
            at = raw.step(stats)
            rows[0] += np.bincount(at, minlength=_STEPS)
            rows[1] += np.bincount(at, weights=label, minlength=_STEPS).astype(np.int64)
        where = np.flatnonzero(rows[0])
        yield pa.record_batch({"step": pa.array(where, pa.int32()), "n": pa.array(rows[0][where]), "good": pa.array(rows[1][where])})

    found = labelled.select("stats", "label").mapInArrow(steps, "step int, n long, good long")
    counts = sorted((r["step"], r["n"], r["good"]) for r in found.groupBy("step").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).collect())
    at = np.array([c[0] for c in counts])
    weight = np.array([c[1] for c in counts], dtype=float)
    level = isotonic(np.array([c[2] for c in counts]) / weight, weight)
    return Model(mean, scale, directions, phases, weights, np.interp(np.arange(_STEPS), at, level), -0.25, 1.25)


def score(stats: DataFrame, model: Model) -> DataFrame:
    """Key and calibrated score of rows with statistics."""
    held = stats.sparkSession.sparkContext.broadcast(model)  # features * statistics floats

    @F.pandas_udf("double")
    def apply(column):
        import pandas as pd

        if not len(column):
            return pd.Series([], dtype="float64")
        return pd.Series(held.value.score(np.stack(column.to_numpy()).astype(np.float64)))

    return stats.withColumn("score", apply("stats"))


def classify(
    documents: DataFrame, labels: DataFrame, held_out: F.Column, text: str = "text", label: str = "quality", threshold: float = 0.7, **options: float
) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Learns from labelled rows outside ``held_out`` (a condition on doc_id; null
    counts as not held out). Labels other than 0 and 1 are ignored, and so are
    documents without an id; a document with several labels counts once for each.
    """
    scratch = Scratch(documents.sparkSession, "quality")
    stats = scratch.save(with_statistics(documents, text), "stats")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label}`").cast("int").alias("label")).where(F.col("label").isin(0, 1))
    held = F.coalesce(held_out, F.lit(False))
    training = scratch.save(stats.where(~held).join(known, "doc_id").select("stats", "label"), "training")
    model = fit(training, **options)
    return score(stats, model).select(
        "doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
