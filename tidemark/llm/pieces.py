"""SentencePiece encoding by batched Viterbi over the scores of a piece file, and decoding."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.distinct_words import WordMemory

SPACE = "▁"
_BASE = np.uint64(0x100000001B3)
#: Positions of one word whose pieces are looked up at a time.
STRETCH = 4096


class Pieces:
    """Piece strings, scores and kinds of a model file, with sorted keys for lookups by hash."""

    def __init__(self, path: str) -> None:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as source:
            model.ParseFromString(source.read())
        self.strings = [p.piece for p in model.pieces]
        kinds, scores = [p.type for p in model.pieces], [p.score for p in model.pieces]
        kind = model.SentencePiece
        self.byte_id = {int(self.strings[k][3:-1], 16): k for k, t in enumerate(kinds) if t == kind.BYTE}
        self.byte_of = {k: b for b, k in self.byte_id.items()}
        self.unknown = kinds.index(kind.UNKNOWN)
        normal = [k for k, t in enumerate(kinds) if t == kind.NORMAL]
        self.unknown_score = min(scores[k] for k in normal) - 10.0        # fixed value: the penalty of a character without a piece
        self.longest = max(len(self.strings[k]) for k in normal)
        self.add_space = model.normalizer_spec.add_dummy_prefix
        codes = np.zeros((len(normal), self.longest), np.uint64)
        lengths = np.array([len(self.strings[k]) for k in normal])
        for row, k in enumerate(normal):
            codes[row, :lengths[row]] = [ord(c) for c in self.strings[k]]
        keys = np.zeros(len(normal), np.uint64)
        for k in range(self.longest):
            keys = np.where(k < lengths, keys * _BASE + codes[:, k], keys)
        keys = keys * _BASE + lengths.astype(np.uint64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.codes = keys[order], codes[order]
        self.ids, self.scores = np.array(normal)[order], np.array([scores[k] for k in normal])[order]
        #: Characters inside pieces of two or more; a word may be cut at any other character.
        inside = {c for k in normal if len(self.strings[k]) > 1 for c in self.strings[k]}
        self.break_is_alone = "\n" not in inside
        self.space_leads = not any(SPACE in self.strings[k].lstrip(SPACE) for k in normal)

    def probe(self, text: np.ndarray, hashes: np.ndarray, end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the substrings of ``length`` that end at ``end`` (columns), -1 where there is no such piece.

        ``hashes[:, k]`` is the hash of the first k characters of every row.
        """
        power = np.uint64(pow(int(_BASE), length, 2**64))
        key = (hashes[:, end] - hashes[:, end - length] * power) * _BASE + np.uint64(length)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        row, col = np.nonzero(self.keys[at] == key)
        found = at[row, col]
        start = end[col] - length
        same = np.ones(len(row), bool)
        for k in range(length):
            same &= self.codes[found, k] == text[row, start + k]
        ids, scores = np.full(key.shape, -1, np.int64), np.full(key.shape, -np.inf)
        ids[row[same], col[same]], scores[row[same], col[same]] = self.ids[found[same]], self.scores[found[same]]
        return ids, scores


def viterbi(pieces: Pieces, words: Sequence[str]) -> list[list[int]]:
    """Ids of the best segmentation of each word; words of equal length advance together.

    The best is the greatest sum of scores; of equal sums the one whose last
    piece is longest, and so on towards the front.
    """
    out: list[list[int]] = [[] for _ in words]
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        if w:
            by_length.setdefault(len(w), []).append(k)
    for length, places in by_length.items():
        step = max(1, 200_000 // length)
        for k in range(0, len(places), step):
            some = places[k:k + step]
            for place, ids in zip(some, _advance(pieces, [words[p] for p in some], length), strict=True):
                out[place] = ids
    return out


def _advance(pieces: Pieces, words: list[str], length: int) -> list[list[int]]:
    text = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, length).astype(np.uint64)
    n, longest = len(words), pieces.longest
    hashes = np.zeros((n, length + 1), np.uint64)
    for k in range(length):
        hashes[:, k + 1] = hashes[:, k] * _BASE + text[:, k]
    best = np.full((n, longest + length + 1), -np.inf)                  # position k is at column longest + k
    best[:, longest] = 0.0
    back, chosen = np.zeros((n, length + 1), np.int32), np.zeros((n, length + 1), np.int64)
    rows = np.arange(n)
    for low in range(1, length + 1, STRETCH):
        ends = np.arange(low, min(length, low + STRETCH - 1) + 1)
        ids, scores = np.full((n, len(ends), longest), -1, np.int64), np.full((n, len(ends), longest), -np.inf)
        for size in range(1, min(longest, int(ends[-1])) + 1):
            inside = ends >= size
            ids[:, inside, size - 1], scores[:, inside, size - 1] = pieces.probe(text, hashes, ends[inside], size)
        alone = ids[:, :, 0] < 0
        ids[:, :, 0] = np.where(alone, pieces.unknown, ids[:, :, 0])
        scores[:, :, 0] = np.where(alone, pieces.unknown_score, scores[:, :, 0])
        for k, end in enumerate(ends.tolist()):
            reach = best[:, end:end + longest][:, ::-1] + scores[:, k]  # column s: the last piece has s + 1 characters
            size = longest - 1 - np.argmax(reach[:, ::-1], axis=1)      # the longest of the best
            best[:, longest + end] = reach[rows, size]
            back[:, end], chosen[:, end] = size + 1, ids[rows, k, size]
    return [_traced(pieces, word, b, c) for word, b, c in zip(words, back.tolist(), chosen.tolist(), strict=True)]


def _traced(pieces: Pieces, word: str, back: list[int], chosen: list[int]) -> list[int]:
    ids, at = [], len(word)
    while at:
        if chosen[at] == pieces.unknown and pieces.byte_id:
            ids += [pieces.byte_id[b] for b in reversed(word[at - 1].encode("utf-8", "surrogatepass"))]
        else:
            ids.append(chosen[at])
        at -= back[at]
    return ids[::-1]


class Codec:
    """Encoding and decoding of whole texts; distinct words are segmented once per memory."""

    def __init__(self, path: str) -> None:
        self.pieces = pieces = Pieces(path)
        if not pieces.space_leads:
            self.cut = re.compile("(?s).+")                             # pieces may span words
        else:
            self.cut = re.compile(f"{SPACE}*[^{SPACE}\n]+|\n|{SPACE}+" if pieces.break_is_alone else f"{SPACE}*[^{SPACE}]+|{SPACE}+")
        self.memory = WordMemory(lambda words: [np.array(ids, "<u4").tobytes() for ids in viterbi(pieces, words)], 400_000)
        self.bytes_of = np.array([bytes([pieces.byte_of[k]]) if k in pieces.byte_of else s.encode() for k, s in enumerate(pieces.strings)], object)

    def encode_all(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as unsigned 32-bit little-endian integers; an empty text has none."""
        cut = []
        for text in texts:
            spaced = text.replace(" ", SPACE)
            cut.append(self.cut.findall(SPACE + spaced if self.pieces.add_space and text else spaced))
        known = self.memory.learn(chain.from_iterable(cut)).__getitem__
        return [b"".join(map(known, words)) for words in cut]

    def decode(self, ids: bytes) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        joined = b"".join(self.bytes_of[np.frombuffer(ids, "<u4")].tolist()).decode("utf-8", "replace").replace(SPACE, " ")
        return joined[1:] if self.pieces.add_space and joined.startswith(" ") else joined


def coded(docs: DataFrame, model_path: str, text_col: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``docs`` with ``ids`` (unsigned 32-bit little-endian integers as binary) and ``decoded``, the text of these ids.

    The segmentation is the one with the greatest sum of the file's piece scores;
    a character without a piece becomes its bytes.  Spaces become ``▁`` and one is
    put before the text if the file asks for it.  Other normalisation is not
    applied: files that ask for a character map are refused.

    Null and empty texts have no ids and decode to an empty text.  ``decoded``
    equals any other text, unless that holds ``▁`` itself, which decodes to a
    space.  Texts are read whole, however long.  Rows are neither moved nor dropped, an
    empty table stays empty; other columns pass through, but one named
    like a new one, in whatever case, gives way to it.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() in {ids.lower(), decoded.lower()}])
    at = docs.columns.index(text_col)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model_path)
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                coded_ = codec.encode_all([t or "" for t in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(coded_, pa.binary()), pa.array(map(codec.decode, coded_), pa.string())],
                                                 [*part.schema.names, ids, decoded])

    schema = docs.schema
    return docs.mapInArrow(code, type(schema)([*schema.fields]).add(ids, "binary").add(decoded, "string"))


_CODECS: dict[str, Codec] = {}


def _codec(path: str) -> Codec:
    """One codec per process: what it has learned serves later tasks."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]
