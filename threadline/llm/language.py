"""Language ID: multinomial naive Bayes over hashed character n-grams.

Training counts n-grams of all training texts in numpy, one dense count table
per language and task, summed by Spark. The table of log probabilities has a
fixed number of buckets and one row per language; it is what tasks receive.
Texts are scored in batches: the rows of the table are gathered at the n-grams
a text has and summed per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadline.llm.arrow import released, texts_of, with_text

UNKNOWN = "und"
MAX_LANGUAGES = 1024  # checked bound on what tasks receive: MAX_LANGUAGES * 2**bits floats
_STEPS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D), np.uint32(0x27D4EB2F))


@dataclass(frozen=True)
class Model:
    """Languages by name, log prior of each, and log probabilities by bucket and language."""

    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray  # float32 [2**bits, languages]
    bits: int
    orders: int


def _buckets(texts: list[str], bits: int, orders: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams of orders 1..n, and the number of the text of each.

    A text is lower-cased and stands between two spaces; n-grams do not cross texts.
    """
    joined = [f" {t.lower()} " for t in texts]
    lengths = np.fromiter(map(len, joined), dtype=np.int64, count=len(joined))
    codes = np.frombuffer("".join(joined).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint32)
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), lengths)
    found, owner = [], []
    shift = np.uint32(32 - bits)
    h = np.zeros(len(codes), dtype=np.uint32)
    for order in range(orders):
        n = len(codes) - order
        if n <= 0:
            break
        h = (h[:n] ^ codes[order:]) * _STEPS[order % len(_STEPS)]
        h ^= h >> np.uint32(15)
        whole = doc[:n] == doc[order:] if order else slice(None)
        found.append(((h * np.uint32(0x2C1B3C6D)) >> shift)[whole].astype(np.int32))
        owner.append(doc[:n][whole])
    return np.concatenate(found), np.concatenate(owner)


def _slices(texts: list[str], step: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Runs of texts of about ``step`` characters, so that arrays stay small; a long text is a run."""
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > step:
            yield lo, i
            lo, size = i, 0
        size += len(t)
    if lo < len(texts):
        yield lo, len(texts)


def train(df: DataFrame, text: str = "text", lang: str = "lang", bits: int = 16, orders: int = 3, smoothing: float = 0.5) -> Model:
    """Fit on every row with a language. Null texts count as empty; without rows the model has no language."""
    size = 1 << bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts, langs = texts_of(part.column(0)), part.column(1).to_pylist()
                names = sorted(set(langs))
                number = {name: i for i, name in enumerate(names)}
                row = np.array([number[x] for x in langs], dtype=np.int64)
                for name in langs:
                    docs[name] = docs.get(name, 0) + 1
                for lo, hi in _slices(texts):
                    bucket, doc = _buckets(texts[lo:hi], bits, orders)
                    both = np.bincount(row[lo + doc] * size + bucket, minlength=len(names) * size)
                    for name in names:
                        counted = both[number[name] * size : (number[name] + 1) * size]
                        if name not in tables:
                            tables[name] = np.zeros(size, dtype=np.int64)
                        tables[name] += counted
        for name, counts in tables.items():
            where = np.flatnonzero(counts)
            yield pa.record_batch(
                {"lang": pa.array([name] * (len(where) + 1), pa.string()),
                 "bucket": pa.array(np.append(where, -1), pa.int32()),
                 "n": pa.array(np.append(counts[where], docs[name]), pa.int64())}
            )

    rows = df.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{text}`").cast("string"), F.col(f"`{lang}`").cast("string"))
    counts = rows.mapInArrow(released(count), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    # One row per language and bucket: fixed by the parameters, whatever the corpus.
    table = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")).limit(MAX_LANGUAGES + 1).collect()
    if len(table) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    languages = sorted(r["lang"] for r in table)
    weights = np.zeros((size, len(languages)), dtype=np.float64)
    prior = np.zeros(len(languages))
    for r in table:
        k = languages.index(r["lang"])
        cells = np.array([(c["bucket"], c["n"]) for c in r["cells"]], dtype=np.int64)
        docs = cells[cells[:, 0] == -1, 1].sum()
        cells = cells[cells[:, 0] >= 0]
        weights[cells[:, 0], k] = cells[:, 1]
        prior[k] = docs
    if languages:
        weights = np.log(weights + smoothing) - np.log(weights.sum(axis=0) + smoothing * size)
        prior = np.log(prior / prior.sum())
    return Model(languages, prior, weights.astype(np.float32), bits, orders)


def has_letter(text: str) -> bool:
    """Is a character of a letter category among them? Digits, fractions and enclosed or Roman numerals are none."""
    return any(map(str.isalpha, text))


def score(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """Language and its posterior probability for each text.

    ``und`` and 0 for null, for texts without a letter, and for a model without
    languages. Of equally likely languages the first by name is taken.
    """
    langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    asked = [i for i, t in enumerate(texts) if t and has_letter(t)] if model.languages else []
    chosen = [texts[i] for i in asked]
    for lo, hi in _slices(chosen):
        bucket, doc = _buckets(chosen[lo:hi], model.bits, model.orders)
        sums = np.stack(
            [np.bincount(doc, weights=model.weights[:, k][bucket], minlength=hi - lo) for k in range(len(model.languages))], axis=1
        ) + model.prior
        best = sums.argmax(axis=1)
        share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
        for j in range(hi - lo):
            langs[asked[lo + j]], scores[asked[lo + j]] = model.languages[best[j]], share[j]
    return langs, scores


def predict(df: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score_col: str = "score") -> DataFrame:
    """All rows and columns, with the predicted language and its score added.

    Columns of the result names that exist already give way to them. Null ids
    and repeated rows are rows like others; texts are scored in runs of bounded
    size, a very long one alone; an empty table gives an empty result.
    """
    given = {lang_pred.lower(), score_col.lower()}
    df = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in given or c == text])

    held = df.sparkSession.sparkContext.broadcast(model)  # languages * 2**bits floats
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                found, values = score(part.column(told).to_pylist(), held.value)
                columns = [*part.columns[: len(names)], pa.array(found, pa.string()), pa.array(values, pa.float64())]
                fields = [*[part.schema.field(i) for i in range(len(names))], pa.field("lang", pa.string()), pa.field("score", pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    plain, told = with_text(df, names.index(text))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(df.schema.fields))
    out = plain.mapInArrow(released(run), f"{schema}, lang string, score double")
    return out.toDF(*names, lang_pred, score_col)
