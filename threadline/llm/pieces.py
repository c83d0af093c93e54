"""SentencePiece encoding and decoding by a shared-prefix forward pass.

Texts are cut into marked words: a run of marks (U+2581, the spaces) and what
follows up to the next mark. No piece has a mark after another character, so
words are encoded apart. The distinct words of a batch are sorted, which makes
them a trie read depth-first: going to the next word keeps the forward states
of the prefix it shares with the one before.

Unigram models: the state of a prefix is its best score and last piece
(Viterbi), of equal scores the longest last piece; where two paths hold the same
pieces in another order, the library's choice depends on rounding of the whole
sentence's sum. BPE models rank pieces by merge order, and the sum of scores does
not give their result; there the state is the last piece of the prefix's own
encoding, and a piece extends a prefix when merging the two pieces alone would
leave them apart. That gives the library's result with the same pass.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadline.llm.arrow import released, with_text

MARK = "▁"
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_UNKNOWN = 10.0  # fixed value of the format: a character without a piece scores so much below the least piece
_CACHE = 150_000  # words whose pieces a worker keeps; when half of them are new, those that were not used since go


class PieceModel:
    """Pieces of a model file: scores, merges, bytes and normalisation settings."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = n_pieces = model.get_piece_size()
        self.text = [model.id_to_piece(i) for i in range(n)]
        self.size = [len(t) for t in self.text]
        self.score = [model.get_score(i) for i in range(n)]
        special = {i for i in range(n) if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.ids = {self.text[i]: i for i in range(n) if i not in special}
        self.bytes = {int(self.text[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        self.control = special - set(self.byte_of)
        self.unknown = model.unk_id()
        # Pieces read from the last character to the first, as a tree: a node is its children and its own piece or -1.
        self.back: tuple[dict, int] = ({}, -1)
        for t, k in sorted(self.ids.items(), key=lambda x: len(x[0])):
            children = self.back[0]
            for c in reversed(t[1:]):
                children = children.setdefault(c, ({}, -1))[0]
            # Shorter pieces come first, so the place of this one has no children yet, or none that a piece ends with.
            children[t[0]] = (children.get(t[0], ({},))[0], k)
        self.spoken = [b"" if i in self.control else self.byte_of.get(i) or t.replace(MARK, " ").encode() for i, t in enumerate(self.text)]
        kind, self.dummy, squeeze, name = _settings(path)
        if squeeze or name not in ("identity", ""):
            raise ValueError(f"normalisation {name!r} is not supported")
        if any(MARK in t.lstrip(MARK) for t in self.ids):
            raise ValueError("a piece spans two words")
        self.bpe = kind == 2
        self.alone = min((self.score[i] for i in self.ids.values()), default=0.0) - _UNKNOWN
        self._apart: dict[int, bool] = {}  # by left * number of pieces + right
        self._whole: list[bool | None] = [None] * n_pieces

    def merge(self, units: list[str]) -> list[str]:
        """Merge the neighbours with the best score, the leftmost of equals, until none are left."""
        units = list(units)
        while True:
            best, at = None, -1
            for i in range(len(units) - 1):
                k = self.ids.get(units[i] + units[i + 1])
                if k is not None and (best is None or self.score[k] > best):
                    best, at = self.score[k], i
            if at < 0:
                return units
            units[at : at + 2] = [units[at] + units[at + 1]]

    def whole(self, piece: int) -> bool:
        """Does the piece's own text come out as the piece?"""
        known = self._whole[piece]
        if known is None:
            known = self._whole[piece] = len(self.merge(list(self.text[piece]))) == 1
        return known

    def apart(self, left: int, right: int) -> bool:
        """Do the two pieces stay as they are when they stand together?"""
        both = left * len(self.text) + right
        known = self._apart.get(both)
        if known is None:
            if len(self._apart) > 300_000:
                self._apart.clear()
            a, b = self.text[left], self.text[right]
            known = self._apart[both] = self.merge(list(a + b)) == [a, b]
        return known


def _settings(path: str) -> tuple[int, bool, bool, str]:
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        proto.ParseFromString(f.read())
    n = proto.normalizer_spec
    return proto.trainer_spec.model_type, n.add_dummy_prefix, n.remove_extra_whitespaces, n.name


def encode_words(words: list[str], model: PieceModel) -> list[list[int]]:
    """Ids of distinct marked words, sorted or not, in the order given."""
    order = sorted(range(len(words)), key=words.__getitem__)
    out: list[list[int]] = [[] for _ in words]
    before, last, score = "", [-1], [0.0]
    extend = _extend_bpe if model.bpe else _extend_unigram
    for i in order:
        word, keep = words[i], 0
        for a, b in zip(before, word):
            if a != b:
                break
            keep += 1
        del last[keep + 1 :], score[keep + 1 :]
        extend(word, keep, model, last, score)
        out[i] = _path(word, model, last)
        before = word
    return out


# The state of the prefix word[:end] comes from those of shorter ones: its last
# piece (-1: a character without one; it starts where the piece is that long) and its score.


def _extend_bpe(word: str, keep: int, model: PieceModel, last: list[int], score: list[float]) -> None:
    root, whole, apart, n, add = model.back[0], model._whole, model._apart, len(model.text), last.append
    for end in range(keep + 1, len(word) + 1):
        children, lo, piece = root, end, -1
        while lo:
            lo -= 1
            node = children.get(word[lo])
            if node is None:  # no piece ends so
                break
            children, k = node
            if k < 0:
                continue
            fits = whole[k]
            if not (model.whole(k) if fits is None else fits):
                continue
            left = last[lo]
            if lo and left >= 0:
                stays = apart.get(left * n + k)
                if not (model.apart(left, k) if stays is None else stays):
                    continue
            piece = k  # the only one
            break
        add(piece)


def _extend_unigram(word: str, keep: int, model: PieceModel, last: list[int], score: list[float]) -> None:
    for end in range(keep + 1, len(word) + 1):
        best, children, lo = None, model.back[0], end
        single = children.get(word[end - 1], (None, -1))[1] >= 0
        while lo:
            lo -= 1
            node = children.get(word[lo])
            if node is None:
                break
            children, k = node
            if k >= 0 and (best is None or score[lo] + model.score[k] >= best[0]):
                best = (score[lo] + model.score[k], k)
        # A character without a piece of its own may stand alone.
        if best is None or not single and score[end - 1] + model.alone > best[0]:
            best = (score[end - 1] + model.alone, -1)
        score.append(best[0])
        last.append(best[1])


def _path(word: str, model: PieceModel, last: list[int]) -> list[int]:
    out: list[int] = []
    end, size = len(word), model.size
    while end:
        piece = last[end]
        if piece >= 0:
            out.append(piece)
            end -= size[piece]
            continue
        if model.bytes:
            out += [model.bytes[b] for b in reversed(word[end - 1 : end].encode("utf-8", "surrogatepass"))]
        elif not out or out[-1] != model.unknown:  # unknown characters in a row are one
            out.append(model.unknown)
        end -= 1
    out.reverse()
    return out


class Encoder:
    def __init__(self, path: str) -> None:
        self.model = PieceModel(path)
        # With a mark before every text, all words begin with one; it is left out of the keys.
        self._lead = MARK if self.model.dummy else ""
        self._known: dict[str, bytes] = {}
        self._earlier: dict[str, bytes] = {}  # words that a text since then had move to the other

    def _cut(self, text: str) -> list[str]:
        """The marked words of a text, without the mark that all of them begin with."""
        if not self._lead:
            return _WORD.findall(text.replace(" ", MARK))
        if not text:
            return []
        words = text.split(" ")
        if MARK not in text and "" not in words:  # single spaces between words: each is one mark
            return words
        return [w[1:] for w in _WORD.findall(MARK + text.replace(" ", MARK))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut = [self._cut(t) for t in texts]
        if len(self._known) > _CACHE // 2:
            self._known, self._earlier = {}, self._known
        known, earlier, fresh = self._known, self._earlier, []
        for w in set().union(*cut):
            if w not in known:
                ids = earlier.get(w)
                if ids is None:
                    fresh.append(w)
                else:
                    known[w] = ids
        for w, ids in zip(fresh, encode_words([self._lead + w for w in fresh], self.model)):
            known[w] = struct.pack(f"<{len(ids)}I", *ids)
        return [b"".join(map(known.__getitem__, words)) for words in cut]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: marks are spaces, the first one is dropped, control pieces say nothing."""
        text = b"".join(map(self.model.spoken.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.dummy and text.startswith(" ") else text


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(df: DataFrame, model: str, text: str = "text", pieces: str = "pieces") -> DataFrame:
    """All rows and columns, with the ids of the text as an array of int.

    Null texts have null ids, empty ones none. Whole texts are encoded; a batch
    is taken a few hundred texts at a time.
    """

    @F.pandas_udf("array<int>")
    def apply(column):
        import pandas as pd

        texts = [t if isinstance(t, str) else None for t in column]
        out: list[np.ndarray | None] = []
        for lo in range(0, len(texts), 500):
            some = texts[lo : lo + 500]
            ids = encoder(model).encode([t or "" for t in some])
            out += [None if t is None else np.frombuffer(b, dtype="<i4") for t, b in zip(some, ids)]
        return pd.Series(out, dtype=object)

    return df.withColumn(pieces, apply(F.col(f"`{text}`").cast("string")))


def decode(df: DataFrame, model: str, pieces: str = "pieces", decoded: str = "decoded") -> DataFrame:
    """All rows and columns, with the text of the ids. Null ids have null text."""

    @F.pandas_udf("string")
    def apply(column):
        import pandas as pd

        return pd.Series([None if v is None else encoder(model).decode(np.asarray(v)) for v in column], dtype=object)

    return df.withColumn(decoded, apply(F.col(f"`{pieces}`")))


def encode_and_decode(df: DataFrame, model: str, text: str = "text") -> DataFrame:
    """All columns and ``pieces``, ``decoded`` in one pass over the texts."""
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(model)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, min(500, batch.num_rows - lo))
                texts = part.column(told).to_pylist()
                ids = [np.frombuffer(b, dtype="<i4") for b in tool.encode([t or "" for t in texts])]
                bounds = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                values = pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                gone = pa.array([t is None for t in texts])
                pieces = pa.ListArray.from_arrays(pa.array(bounds, pa.int32(), mask=np.append(gone.to_numpy(zero_copy_only=False), False)), values)
                decoded = pa.array([None if t is None else tool.decode(v) for t, v in zip(texts, ids)], pa.string())
                columns = [part.column(i) for i in range(len(names))]
                fields = [part.schema.field(i) for i in range(len(names))]
                schema = pa.schema([*fields, ("pieces", pa.list_(pa.int32())), ("decoded", pa.string())])
                yield pa.RecordBatch.from_arrays([*columns, pieces, decoded], schema=schema)

    plain, told = with_text(df, names.index(text))
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(df.schema.fields))
    out = plain.mapInArrow(released(run), f"{schema}, pieces array<int>, decoded string")
    return out.toDF(*names, "pieces", "decoded")
