"""Operators against brute force, round trips and held-out rows, with nulls, ties, repeats and empty tables."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import Row, functions as F

from threadline.llm import fingerprint, jaccard, language, mixture, pieces, quality, sharding, substring, token_files, topk
from threadline.llm.inputs import ship
from threadline.llm.queries import tokenizer_file
from threadline.plans.scratch import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, chunk string, c0 string"


@pytest.fixture(scope="module")
def documents(spark):
    """Copies, near copies, shared passages, tiny texts, nulls, repeats and clashing column names."""
    ship(spark)
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(400)] + ["Ünï", "日本", "x😀"]
    base = [" ".join(rng.choice(words, 80)) for _ in range(12)]
    passage = " ".join(rng.choice(words, 20))
    texts: list[str | None] = list(base)
    for b in base:
        parts = b.split()
        for at in rng.integers(0, 80, 2):
            parts[at] = "edit"
        texts += [b, b.upper(), " ".join(parts), b[:200] + " " + passage + "\n" + b[260:]]
    texts += ["", None, None, "one", "One", "one  two", "a b c d", "a b c d", "a b c d e", "a b c d e f", "a b c d e f g", " \n\t", passage, "!!! ###", "ab"]
    rows = [(i * 3 + 1, t, "en" if i % 2 else "fr", f"s{i % 4}" if i % 5 else None, "c", "z") for i, t in enumerate(texts)]
    rows += [rows[3], rows[3], (rows[4][0], "other text under the same id", "en", "s1", "c", "z"), (None, base[0], "en", "s0", "c", "z"), (None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


@pytest.mark.parametrize("boundary", [None, 0, 6])
def test_jaccard_components(spark, documents, boundary):
    given = rows_of(documents)
    sets = [shingles(t) for _, t in given]
    root = list(range(len(given)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(given)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
            root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(given):
        least.setdefault(find(i), []).append(key)
    least = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    want = sorted(((k, len(s), least[find(i)]) for i, ((k, _), s) in enumerate(zip(given, sets))), key=str)
    found = jaccard.near_duplicates(documents, boundary=boundary).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found), key=str) == want
    kept = jaccard.keep_first(documents)
    assert kept.columns == documents.columns
    assert kept.count() == len({find(i) for i in range(len(given))})


def test_substring_dedup(documents):
    given = rows_of(documents)
    big = 2**63 - 1
    first = {}
    for key, text in given:
        words = WORD.findall(text or "")
        for i in range(len(words) - 12):
            w = tuple(words[i : i + 13])
            first[w] = min(first.get(w, big), big if key is None else key)
    want = []
    for key, text in given:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - 12):
            if first[tuple(words[i : i + 13])] < (big if key is None else key):
                gone |= set(range(i, i + 13))
        want.append((key, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    found = substring.dedup(documents)
    assert found.columns == [*documents.columns, "n_words", "n_removed", "kept"]
    assert sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()), key=str) == sorted(want, key=str)


def test_token_files(spark, documents):
    from tokenizers import Tokenizer

    path = f"{Scratch(spark, 'tokens').root}/ids"
    name = tokenizer_file("word_bpe_49k.json")
    token_files.write_tokens(documents, path, name)
    found = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    keys = [r["doc_id"] for r in found]
    assert keys == sorted(keys, key=lambda k: (k is None, k or 0))
    texts = {}
    for key, text in rows_of(documents):
        ids = Tokenizer.from_file(name).encode(text or "", add_special_tokens=False).ids + [1]
        texts.setdefault(key, []).append(np.array(ids, dtype="<u4").tobytes())
    start = 0
    for r in found:
        assert r["start"] == start and bytes(r["ids"]) in texts[r["doc_id"]] and r["n_tokens"] == len(r["ids"]) // 4
        texts[r["doc_id"]].remove(bytes(r["ids"]))
        start += r["n_tokens"]



def test_encoder_equals_the_library(monkeypatch):
    """Odd words, the digit between words, and a cache that is far too small."""
    from tokenizers import Tokenizer

    name = tokenizer_file("word_bpe_49k.json")
    library = Tokenizer.from_file(name)
    rng = np.random.default_rng(5)
    letters = list("abcdeEÉßΣжİ0123.,'-$") + ["e\u0301", "\u0301", "\uff10", "\t", "\n"]
    words = ["".join(rng.choice(letters, rng.integers(0, 9))) for _ in range(3000)]
    texts = ["", "0", " 0 0 ", "a0b", "<|endoftext|>x<|STARTOFTEXT|>", "it's 're", "x" * 5000, *(" ".join(rng.choice(words, 40)) for _ in range(200))]
    for cache, group in ((400_000, 1000), (50, 7)):
        monkeypatch.setattr(token_files, "_CACHE", cache)
        monkeypatch.setattr(token_files, "_GROUP", group)
        encoder = token_files.Encoder(name)
        found = [ids for lo in range(0, len(texts), 30) for ids in encoder.encode(texts[lo : lo + 30])]
        assert found == [np.array(library.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in texts]
    assert encoder.encode([]) == []


def test_blocks_round_trip():
    for ids in (np.zeros(0), np.arange(5), np.array([2**32 - 1, 0, 77] * 9)):
        ids = ids.astype("<u4")
        assert (token_files.unpack_block(token_files.pack_block(ids, 4)) == ids).all()


def test_mixture(spark, documents):
    found = mixture.mix(documents).collect()
    again = mixture.mix(documents.repartition(3)).collect()
    shape = lambda rows: sorted(str((r["doc_id"], r["source"], r["key"], r["passes"])) for r in rows)
    assert shape(found) == shape(again) and len(found) == documents.count()
    by = {}
    for r in found:
        assert 0 <= r["passes"] <= 2 and (r["size"] or r["passes"] == 0)
        by.setdefault(r["source"], [r["target"], 0])[1] += r["passes"] * r["size"]
    total = sum(r["size"] for r in found)
    assert sum(t for t, _ in by.values()) == pytest.approx(1.5 * total)
    longest = max(r["size"] for r in found)  # a source of few documents cannot come nearer than their sizes allow
    assert all(abs(t - taken) <= longest for t, taken in by.values())
    copies = mixture.mix_rows(documents, Scratch(spark, "mix"))
    assert copies.columns == documents.columns and copies.count() == sum(r["passes"] for r in found)


def test_budget_is_met_exactly_when_it_can_be():
    counts = {3: 2, 5: 4, 11: 3}
    for budget in range(60):
        sums = {a * 3 + b * 5 + c * 11 for a in range(3) for b in range(5) for c in range(4)}
        taken = mixture.fit_counts(counts, budget)
        assert all(0 <= taken[k] <= counts[k] for k in counts)
        assert sum(k * n for k, n in taken.items()) == max(s for s in sums if s <= budget)


def test_budgets_against_all_sums():
    rng = np.random.default_rng(7)
    for _ in range(200):
        counts = {int(k): int(n) for k, n in zip(rng.integers(1, 40, 6), rng.integers(1, 5, 6))}
        reach = {0}
        for k, n in counts.items():
            reach = {v + k * i for v in reach for i in range(n + 1)}
        budget = int(rng.integers(0, max(reach) + 5))
        taken = mixture.fit_counts(counts, budget)
        assert all(0 <= taken[k] <= counts[k] for k in counts)
        assert sum(k * n for k, n in taken.items()) == max(v for v in reach if v <= budget)


def test_targets_share_what_is_cut_off():
    found = mixture.targets({"a": 100, "b": 10, None: 1000})
    assert found["b"] == 20 and found["a"] == 200 and sum(found.values()) == pytest.approx(1.5 * 1110)


def test_sharding(documents):
    found = sharding.shard(documents, 4, bundles=8).collect()
    assert len(found) == documents.count()
    for s in {r["shard"] for r in found}:
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots)))
    # Equal texts lie together: none of them alone has more bytes than an even share.
    places = {}
    for r in found:
        places.setdefault(r["key"], set()).add(r["shard"])
    held = {}
    for r in found:
        held[r["key"]] = held.get(r["key"], 0) + r["size"]
    total = sum(held.values())
    assert all(len(p) == 1 or held[k] * 4 > total for k, p in places.items())
    by_shard = [sum(r["size"] for r in found if r["shard"] == s) for s in range(4)]
    assert sum(by_shard) == sum(len((t or "").encode()) + 1 for _, t in rows_of(documents))
    assert max(by_shard) - total / 4 <= max(v for k, v in held.items() if len(places[k]) == 1)
    items = np.array([[5, 1, 1], [4, 1, 1], [3, 1, 1], [3, 1, 1], [3, 1, 1], [2, 1, 1]], dtype=float)
    placed = sharding.pack(items, 2)
    assert items[placed == 0, 0].sum() == 10


def test_a_group_larger_than_a_shard_is_cut(spark):
    """Copies of one text, many without an id, with more bytes than a shard; short copies stay together."""
    ship(spark)
    rows = [(None if i % 2 else i, "long text " * 40) for i in range(300)] + [(1000 + i, "s") for i in range(900)]
    rows += [(5000 + i, f"other {i} " * 20) for i in range(200)]
    found = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string"), 4, bundles=64).collect()
    places = {}
    for r in found:
        places.setdefault(r["size"], set()).add(r["shard"])
    assert len(places[2]) == 1 and len(places[401]) >= 3
    by_shard = [sum(r["size"] for r in found if r["shard"] == s) for s in range(4)]
    assert max(by_shard) < 1.1 * sum(by_shard) / 4
    for s in range(4):
        slots = sorted(r["slot"] for r in found if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_topk(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=6).tolist() for _ in range(300)] + [[1.0] * 6] * 40 + [None, [None] * 6, [float("nan")] * 6, [float("inf")] + [0.0] * 5, []]
    rows = [(i, v) for i, v in enumerate(vectors)] + [(7, vectors[7]), (None, vectors[3])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    sound = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, v in {(i, tuple(v)) for i, v in sound if i % 20 == 0}:
        best = sorted((-int(np.dot(v, w)), i) for i, w in sound if i != q)[:20]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    found = [tuple(r) for r in topk.top_k(df, 20, F.col("vec_id") % 20 == 0).collect()]
    assert sorted(found) == sorted(want)


def test_trees_hold_their_members():
    rng = np.random.default_rng(6)
    v = np.vstack([rng.integers(-50, 50, (700, 5)), np.ones((300, 5), int)])
    tree = topk.build(np.arange(1000), v)
    assert sorted(tree.ids) == list(range(1000))
    for i in range(len(tree.lo)):
        apart = np.sqrt(((tree.vectors[tree.lo[i] : tree.hi[i]] - tree.center[i]) ** 2).sum(axis=1))
        assert (apart <= tree.radius[i] + 1e-6).all()


def test_words_in_use_stay_when_the_others_go(monkeypatch):
    asked = []
    encode_words = pieces.encode_words
    monkeypatch.setattr(pieces, "_CACHE", 20)
    monkeypatch.setattr(pieces, "encode_words", lambda words, model: asked.extend(words) or encode_words(words, model))
    encoder = pieces.Encoder(tokenizer_file("piece_bpe_32k.model"))
    for i in range(20):
        encoder.encode([f"common words w{i}a w{i}b  w{i}c w{i}d"])
    assert asked.count(pieces.MARK + "common") == 1 and len(asked) == len(set(asked))
    assert len(encoder._known) + len(encoder._earlier) <= 40


def test_pieces_equal_the_library(documents):
    import sentencepiece

    path = tokenizer_file("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for r in pieces.encode_and_decode(documents, path).collect():
        if r["text"] is None:
            assert r["pieces"] is None and r["decoded"] is None
        else:
            assert r["pieces"] == library.encode(r["text"]) and r["decoded"] == r["text"]
    odd = ["  a   b  ", "<s></s><0x0A>", "\x00é", "!!!!!", "\n\n", "▁ x"]
    assert [np.frombuffer(b, "<u4").tolist() for b in pieces.Encoder(path).encode(odd)] == library.encode(odd)


def test_a_text_goes_to_python_once(documents, monkeypatch):
    sent = []
    kind = type(documents)
    to_python = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *given: sent.append(len(self.columns)) or to_python(self, *given))
    path = tokenizer_file("piece_bpe_32k.model")
    given = len(documents.columns)
    assert len(pieces.encode_and_decode(documents, path).columns) == given + 2 and sent == [given]
    numbers = documents.select("doc_id", F.col("doc_id").alias("text"))
    assert all(r["decoded"] == (r["text"] if r["text"] is None else str(r["text"])) for r in pieces.encode_and_decode(numbers, path).collect())


@pytest.mark.parametrize("with_bytes", [False, True])
def test_unigram_model_by_hand(tmp_path, with_bytes):
    """Scores, ties and unknown characters of a small unigram model, against the library."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    kinds = proto.SentencePiece
    given = [("<unk>", 0.0, kinds.UNKNOWN), ("<s>", 0.0, kinds.CONTROL), ("</s>", 0.0, kinds.CONTROL)]
    if with_bytes:
        given += [(f"<0x{i:02X}>", -20.0, kinds.BYTE) for i in range(256)]
    # No piece here repeats one text, so no two paths differ in the order of equal pieces only.
    texts = ["▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "▁ab", "ca", "cab", "é", "bcd"]
    given += [(t, -1.0 - 0.37 * ((7 * i) % 11), kinds.NORMAL) for i, t in enumerate(texts)]
    for text, score, kind in given:
        proto.pieces.add(piece=text, score=score, type=kind)
    proto.trainer_spec.model_type = 1
    proto.trainer_spec.byte_fallback = with_bytes
    proto.normalizer_spec.name = "identity"
    proto.normalizer_spec.add_dummy_prefix = True
    proto.normalizer_spec.remove_extra_whitespaces = False
    path = str(tmp_path / "small.model")
    (tmp_path / "small.model").write_bytes(proto.SerializeToString())
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    rng = np.random.default_rng(9)
    words = ["".join(rng.choice(list("aaabbccdé xy"), rng.integers(1, 12))) for _ in range(400)]
    found = [np.frombuffer(b, "<u4").tolist() for b in pieces.Encoder(path).encode(words)]
    assert found == [library.encode(w) for w in words]


def test_fingerprints(documents):
    found = fingerprint.compare_with_next(documents).collect()
    given = rows_of(documents)
    assert len(found) == len(given)
    prints = {}
    for r in fingerprint.fingerprints(documents).join(documents.select("doc_id", "text"), "doc_id").collect():
        prints.setdefault(r["text"] or "", set()).add(r["fingerprint"])
    ids = [k for k, _ in given if k is not None]
    single = {k: t or "" for k, t in given if ids.count(k) == 1}
    order = sorted(single, reverse=True)
    for r in found:
        k = r["doc_id"]
        if k in single and k != order[-1] and order[order.index(k) + 1] == max((x for x in ids if x < k), default=None):
            text = fingerprint.edited(single[k], single[order[order.index(k) + 1]])
            assert r["edited_sha256"] == hashlib.sha256(text.encode()).hexdigest() and r["n_chars"] == len(single[k])
            assert r["fingerprint"] == fingerprint.digest(single[k].encode())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert fingerprint.likeness(fingerprint.digest(b"abc" * 50), fingerprint.digest(b"abc" * 51)) > 0.9


def test_language(spark):
    ship(spark)
    path = "/root/testdata/sf0.001/documents.parquet"
    docs = spark.read.parquet(path)
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    model = language.train(docs.where(~held))
    found = language.predict(docs.where(held), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) > 0.95
    assert language.score([None, "", "12 !!", "the"], model)[0][:3] == ["und"] * 3
    assert language.score(["½ ² Ⅷ ①", "７", "日", "ª"], model)[0][:2] == ["und"] * 2
    assert "und" not in language.score(["日", "ª", "x1"], model)[0]
    clash = docs.limit(5).withColumn("lang_pred", F.lit("old")).withColumn("Score", F.lit(9))
    again = language.predict(clash.unionByName(clash), model)
    assert again.columns == [*docs.columns, "lang_pred", "score"] and again.where("lang_pred = 'old' or score > 1").count() == 0 and again.count() == 10
    assert language.predict(docs.limit(0), model).count() == 0
    empty = language.train(docs.limit(0))
    assert language.score(["the"], empty)[0] == ["und"]


def test_quality(spark):
    ship(spark)
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    found = quality.classify(docs, labels, held).join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in found]) > 0.95
    none = quality.classify(docs.limit(3), labels.limit(0), held).collect()
    assert [r["score"] for r in none] == [0.5] * 3
    assert quality.isotonic(np.array([1.0, 0.0, 2.0]), np.ones(3)).tolist() == [0.5, 0.5, 2.0]


def test_empty_tables(spark, documents):
    none = documents.where("false")
    path = f"{Scratch(spark, 'tokens').root}/none"
    token_files.write_tokens(none, path, tokenizer_file("word_bpe_49k.json"))
    frames = [
        jaccard.near_duplicates(none), jaccard.keep_first(none), substring.dedup(none), mixture.mix(none), sharding.shard(none),
        fingerprint.compare_with_next(none), token_files.read_tokens(spark, path),
        topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), 20, F.col("vec_id") % 20 == 0),
        pieces.encode_and_decode(none, tokenizer_file("piece_bpe_32k.model")), quality.classify(none, spark.createDataFrame([], "doc_id long, quality int"), F.lit(False)),
    ]
    assert [f.count() for f in frames] == [0] * len(frames)


def test_checksums_are_of_little_endian_ids(spark):
    df = spark.createDataFrame([Row(ids=bytearray(np.array([1, 2], "<u4").tobytes()))])
    assert df.select(F.crc32("ids")).first()[0] == zlib.crc32(np.array([1, 2], "<u4").tobytes())


def test_packing_is_not_kept_from_a_shard_by_rows_alone():
    """An item with more rows than a shard's share leaves the bytes of its shard to others."""
    items = np.array([[1.0, 1.0, 900.0]] + [[10.0, 1.0, 1.0]] * 40)
    where = sharding.pack(items, 4)
    held = [items[where == s, 0].sum() for s in range(4)]
    assert max(held) <= 1.1 * sum(held) / 4
