"""Token ids as flat unsigned integer files with 64-bit document offsets."""

from __future__ import annotations

import json
import re
import uuid
from array import array
from collections.abc import Callable, Iterator
from functools import cache
from itertools import accumulate
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.distinct_words import WordMemory
from tidemark.llm.store import new_folder

#: Fixed values of byte-level BPE: the bytes that stand for themselves, and the kinds of characters that its pieces tell apart.
PLAIN_BYTES = [*range(33, 127), *range(161, 173), *range(174, 256)]
KINDS = {1: r"\p{L}+", 2: r"\p{N}+", 3: r"\s+"}
_OTHER, _SPACE, _UNSEEN = 0, 3, 255
#: Characters that are cut and looked up at a time.
STRETCH = 1 << 22

_LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def byte_letters() -> dict[int, int]:
    """The letter of each byte: itself, or else the next one from 256 on."""
    others = [b for b in range(256) if b not in PLAIN_BYTES]
    return {b: b for b in PLAIN_BYTES} | {b: 256 + k for k, b in enumerate(others)}


@cache
def _kinds() -> np.ndarray:
    return np.full(0x110000, _UNSEEN, np.uint8)


def kinds_of(points: np.ndarray) -> np.ndarray:
    """Kinds of code points by the library's own character tables, which it is asked for once per character and process."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    kinds = _kinds()
    new = np.unique(points[kinds[points] == _UNSEEN])
    if len(new):
        kinds[new] = _OTHER
        for kind, pattern in KINDS.items():
            for _, (a, b) in Split(Regex(pattern), "removed", invert=True).pre_tokenize_str("".join(map(chr, new))):
                kinds[new[a:b]] = kind
    return kinds[points]


def piece_bounds(data: bytes, firsts: np.ndarray) -> np.ndarray:
    r"""Where the pieces begin, and the end: of UTF-8 texts that lie in a row and begin at ``firsts``.

    Pieces are those of ``'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+``.
    So they are runs of one kind.  Of white space before other characters the last
    character is a piece of its own, or the beginning of the next one if it is a
    space; an apostrophe that begins a piece takes the letters of its ending.
    """
    n = len(data)
    codes = np.frombuffer(data + bytes(3), np.uint8)
    kind = np.frombuffer(bytearray(data.translate(kinds_of(np.arange(128)).tobytes() + bytes(128))), np.uint8)
    if not data.isascii():
        for width, low, high in ((2, 0xC0, 0xE0), (3, 0xE0, 0xF0), (4, 0xF0, 0xF8)):
            at = np.flatnonzero((codes >= low) & (codes < high))
            point = (codes[at] & (0x7F >> width)).astype(np.int32)
            for k in range(1, width):
                point = point << 6 | codes[at + k] & 0x3F
            found = kinds_of(point)
            for k in range(width):
                kind[at + k] = found
    first = np.zeros(n + 3, bool)
    first[firsts], first[n:] = True, True
    cut, space = first[:n + 1].copy(), kind == _SPACE
    cut[1:n] |= kind[1:] != kind[:-1]
    last = space[:-1] & ~space[1:] & ~first[1:n]           # last bytes of white space before other characters
    cut[:n - 1] |= last
    cut[1:n] &= ~(last & (codes[:n - 1] == 32))
    wide = np.flatnonzero(last & (codes[:n - 1] >= 0x80))
    cut[wide], at = False, wide.copy()
    for _ in range(2):                                     # white space has three bytes at most
        at -= codes[at] & 0xC0 == 0x80
    cut[at] = True
    at = np.flatnonzero(codes[:n] == ord("'"))
    at = at[cut[at] & ~first[at + 1]]
    one, two = codes[at + 1], codes[at + 1] * np.uint16(256) + codes[at + 2]
    size = np.where(np.isin(one, list(b"stmd")), 2, np.where(np.isin(two, [0x7265, 0x7665, 0x6C6C]) & ~first[at + 2], 3, 0))
    at, size = at[size > 0], size[size > 0]
    cut[at + 1] = False
    cut[at + size] = True
    return np.flatnonzero(cut)


def stretches(text: str) -> list[str]:
    """``text`` cut before spaces between two other characters, where a piece begins, about every ``STRETCH`` characters."""
    parts, at = [], 0
    while len(text) - at > STRETCH and (space := _LONE_SPACE.search(text, at + STRETCH)):
        parts.append(text[at:space.start()])
        at = space.start()
    return [*parts, text[at:]]


def byte_bpe(path: str, dtype: str, added: bool = False) -> Callable[[list[str]], list[bytes]]:
    """A function from texts to their ids as little-endian bytes.

    Special strings in a text are ordinary text, or with ``added`` what the library
    takes them for by default: a text that holds an added token is left to it.

    Many texts are cut into pieces at a time; each distinct piece is merged by the
    tokenizer's model, once per memory, and the ids of a text are those of its pieces
    in turn.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    merge, letters = tokenizer.model.tokenize, byte_letters()
    contents = [t.content for t in tokenizer.get_added_tokens_decoder().values()] if added else []
    code = {2: "H", 4: "I"}[np.dtype(dtype).itemsize]

    def ids_of(pieces: list[bytes]) -> list[bytes]:
        return [array(code, [t.id for t in merge(p.decode("latin-1").translate(letters))]).tobytes() for p in pieces]

    memory = WordMemory(ids_of, 500_000)

    def encode(texts: list[str]) -> list[bytes]:
        whole = {k for k, t in enumerate(texts) if any(c in t for c in contents)}
        found = {k: [array(code, tokenizer.encode(texts[k], add_special_tokens=False).ids).tobytes()] for k in whole}
        some, held = [], 0
        for k, text in enumerate(texts):
            for part in stretches(text) if k not in whole else ():
                some.append((k, part))
                held += len(part)
                if held >= STRETCH:
                    add_ids(found, some)
                    some, held = [], 0
        add_ids(found, some)
        return [b"".join(found[k]) for k in range(len(texts))]

    def add_ids(found: dict[int, list[bytes]], some: list[tuple[int, str]]) -> None:
        coded = [part.encode() for _, part in some]
        data, firsts = b"".join(coded), np.cumsum([0, *map(len, coded)])
        if not data:
            found.update((k, []) for k, _ in some)
            return
        bounds = piece_bounds(data, firsts)
        pieces = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(data)]).dictionary_encode()
        distinct = pieces.dictionary.to_pylist()
        ids = pa.array(map(memory.learn(distinct).__getitem__, distinct), pa.large_binary()).take(pieces.indices)
        _, ends, held = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[np.searchsorted(bounds, firsts)].tolist()
        for (k, _), a, b in zip(some, ends[:-1], ends[1:], strict=True):
            found.setdefault(k, []).append(held[a:b].to_pybytes())

    return encode


_ENCODERS: dict[tuple[str, str, bool], Callable[[list[str]], list[bytes]]] = {}


def process_encoder(path: str, dtype: str, added: bool = False) -> Callable[[list[str]], list[bytes]]:
    """The process's encoder: what it has learned serves later tasks."""
    if (path, dtype, added) not in _ENCODERS:
        _ENCODERS[path, dtype, added] = byte_bpe(path, dtype, added)
    return _ENCODERS[path, dtype, added]


def id_type(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 2**16 else "<u4"


def _place(folder: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named with or without a scheme."""
    if urlparse(folder).scheme in ("", "file"):
        return pafs.LocalFileSystem(), urlparse(folder).path
    return pafs.FileSystem.from_uri(folder)


def write_tokens(docs: DataFrame, folder: str, encoder: Callable[[], Callable[[list[str]], list[bytes]]], dtype: str, end_id: int,
                 id_col: str = "doc_id", text_col: str = "text") -> list[dict]:
    """Write the token files of ``docs`` in ascending id order; returns and stores the manifest.

    One file of ids, one of offsets (int64, one more than documents, from 0) and
    one Arrow file of document ids per range of ids; ``end_id`` follows each
    document.  The manifest lists the files in id order with the number of
    documents and ids before each, from prefix sums of the files' counts.

    Null text is empty text: its document is the end id alone.  A null id sorts
    first; rows that share an id follow each other, ordered by text digest.  An
    empty table gives an empty manifest.  Other columns are ignored.
    """
    ordered = (docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
               .withColumn("tie", F.xxhash64("text"))
               .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files, inside = _place(folder)
        files.create_dir(inside, recursive=True)
        name = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"      # an attempt that failed leaves an unlisted file
        encode, end = encoder(), np.array([end_id], dtype).tobytes()
        offsets, keys = [0], []
        with files.open_output_stream(f"{inside}/{name}.ids") as out:
            for batch in batches:
                for k in range(0, batch.num_rows, 2048):
                    for ids in encode(batch.column(1)[k:k + 2048].to_pylist()):
                        out.write(ids + end)
                        offsets.append(offsets[-1] + len(ids + end) // np.dtype(dtype).itemsize)
                keys.append(batch.column(0))
        if len(offsets) == 1:
            files.delete_file(f"{inside}/{name}.ids")
            return
        with files.open_output_stream(f"{inside}/{name}.offsets") as out:
            out.write(np.array(offsets, "<i8").tobytes())
        with files.open_output_stream(f"{inside}/{name}.docs") as out:
            table = pa.Table.from_arrays([pa.chunked_array(keys)], ["doc_id"])
            with pa.ipc.new_file(out, table.schema) as writer:
                writer.write_table(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name]), pa.array([len(offsets) - 1], pa.int64()), pa.array([offsets[-1]], pa.int64())], ["name", "documents", "ids"])

    parts = sorted(ordered.mapInArrow(write, "name string, documents long, ids long").collect())       # a row per file
    before = list(accumulate((p.ids for p in parts), initial=0))
    docs_before = list(accumulate((p.documents for p in parts), initial=0))
    manifest = [{"name": p.name, "documents": p.documents, "ids": p.ids, "first_id": a, "first_document": b}
                for p, a, b in zip(parts, before, docs_before)]  # noqa: B905  the sums hold the totals too
    files, inside = _place(folder)
    files.create_dir(inside, recursive=True)
    with files.open_output_stream(f"{inside}/manifest.json") as out:
        out.write(json.dumps({"dtype": dtype, "end_id": end_id, "files": manifest}).encode())
    return manifest


def open_ids(folder: str, name: str, dtype: str) -> np.ndarray:
    """The ids of one file: memory-mapped where the store is a mounted folder, fetched otherwise."""
    files, inside = _place(folder)
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(f"{inside}/{name}.ids", dtype, mode="r")
    with files.open_input_file(f"{inside}/{name}.ids") as source:
        return np.frombuffer(source.read(), dtype)


def read_tokens(spark: SparkSession, folder: str, id_type_name: str = "long") -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of every document, read from the files; ``ids`` are unsigned 32-bit little-endian."""
    files, inside = _place(folder)
    with files.open_input_file(f"{inside}/manifest.json") as source:
        manifest = json.loads(source.read())
    dtype, listed = manifest["dtype"], manifest["files"]
    rows = spark.createDataFrame([(f["name"], f["first_id"]) for f in listed], "name string, first_id long")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, inside = _place(folder)
        for batch in batches:
            for name, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with files.open_input_file(f"{inside}/{name}.offsets") as source:
                    offsets = np.frombuffer(source.read(), "<i8")
                with files.open_input_file(f"{inside}/{name}.docs") as source:
                    keys = pa.ipc.open_file(source).read_all().column(0).combine_chunks()
                ids = open_ids(folder, name, dtype)
                for k in range(0, len(keys), 256):
                    cut = offsets[k:k + 257]
                    some = [ids[a:b].astype("<u4").tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [keys[k:k + 256], pa.array(first + cut[:-1]), pa.array(np.diff(cut)), pa.array(some, pa.binary())],
                        ["doc_id", "start", "n_tokens", "ids"])

    return rows.repartition(max(1, len(listed))).mapInArrow(read, f"doc_id {id_type_name}, start long, n_tokens long, ids binary")


def token_digests(docs: DataFrame, tokenizer_path: str, end_id: int, vocabulary: int, id_col: str = "doc_id",
                  text_col: str = "text", added: bool = False) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` per document, as read back from files written for ``docs``; ``added`` as in ``byte_bpe``."""
    folder, dtype = new_folder(docs.sparkSession, "tokens"), id_type(vocabulary)
    write_tokens(docs, folder, lambda: process_encoder(tokenizer_path, dtype, added), dtype, end_id, id_col, text_col)
    read = read_tokens(docs.sparkSession, folder, docs.schema[id_col].dataType.simpleString())
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
