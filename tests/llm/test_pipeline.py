"""The pipeline, stage by stage, against brute force on what each stage gets."""

from __future__ import annotations

import random
import re

import pytest

import corpus_pipeline
from threadline.llm import mixture
from threadline.llm.inputs import ship
from threadline.llm.queries import tokenizer_file

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def shingles(text):
    w = words((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two languages, copies, near copies, a passage in many texts, and texts without letters."""
    rng = random.Random(21)
    english, other = ([f"{a}{b}" for a in x for b in y] for x, y in (("the wor li st ing".split(), "ed er ly s".split()), ("ża grzy bło sze cz".split(), "ki ów ąć ę".split())))
    base = [" ".join(rng.choice(english if i % 2 else other) + str(rng.randrange(9)) for _ in range(60)) for i in range(30)]
    passage = " ".join(rng.choice(english) + str(rng.randrange(9)) for _ in range(25))
    texts = []
    for b in base:
        w = b.split()
        w[rng.randrange(60)] = "edit"
        texts += [b, " ".join(w), b if rng.random() < 0.3 else passage + " " + " ".join(rng.sample(w, 40))]
    texts += [None, "", "12 34 !!", "½ ²", "the", "x y"]
    rows = [(10 * i + 3, t, "en" if i % 2 else "pl", ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(2).write.parquet(f"{path}/documents.parquet")
    ship(spark)
    return path


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def near(given):
    sets = [shingles(r[1]) for r in given]
    root = list(range(len(given)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(given)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, r in enumerate(given):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [r for i, r in enumerate(given) if least[find(i)] == r[0]]


def without_repeats(given):
    first = {}
    for r in given:
        w = words(r[1])
        for i in range(len(w) - 12):
            key = tuple(w[i : i + 13])
            first[key] = min(first.get(key, r[0]), r[0])
    out = []
    for r in given:
        w = words(r[1])
        gone = {j for i in range(len(w) - 12) if first[tuple(w[i : i + 13])] < r[0] for j in range(i, i + 13)}
        text = " ".join(x for j, x in enumerate(w) if j not in gone) if gone else r[1]
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


def test_stages(spark, folder):
    import sentencepiece

    stages = dict(corpus_pipeline.STAGES)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = stages["language"](spark, docs.selectExpr("*", "1 AS _score", "'x' AS _lang_pred"), folder)
    assert kept.columns == corpus_pipeline.COLUMNS
    want = [r for r in rows_of(docs) if any(map(str.isalpha, r[1] or ""))]
    assert sorted(rows_of(kept)) == sorted(want) and len(want) < docs.count()
    unique = stages["near_duplicates"](spark, kept, folder)
    assert sorted(rows_of(unique)) == sorted(near(want)) and unique.count() < len(want)
    before = near(want)
    want = without_repeats(before)
    clean = stages["substrings"](spark, unique, folder)
    assert sorted(rows_of(clean)) == sorted(want) and want != before
    mixed = rows_of(stages["mixture"](spark, clean, folder))
    sizes = {}
    for r in want:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    target = mixture.targets(sizes)
    for source in sizes:
        taken = sum(len(words(r[1])) for r in mixed if r[3] == source)
        # Any whole number of words can be met here: there are short texts in each source's lengths.
        assert abs(target[source] - taken) <= max(len(words(r[1])) for r in want)
    assert set(mixed) <= set(want) and max(mixed.count(r) for r in set(mixed)) <= 2
    coded = stages["pieces"](spark, clean, folder).collect()
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file("piece_bpe_32k.model"))
    texts = {r[0]: r[1] for r in want}
    assert len(coded) == len(want) and all(list(r["pieces"]) == library.encode(texts[r["doc_id"]]) and r["same"] for r in coded)


def test_run_writes_each_stage(spark, folder):
    out = corpus_pipeline.run(spark, folder).collect()
    assert out and all(r["same"] for r in out)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "substrings", "mixture", "pieces"]
    assert "threadline_chunks" not in str([t.name for t in spark.catalog.listTables()])


def test_empty_documents(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
