"""Benchmark windows in documents, searched with the tables of Wu and Manber."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.distinct_words import release
from tidemark.llm.store import stored

WINDOW = 10
#: Benchmark text handled in one pass over the documents; more items are taken in further passes.
#: A worker's tables take about 15 bytes for each of these.
PASS_BYTES = 8_000_000
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
BLOCK, BITS = 8, 20


def normal(text: str | None) -> bytes:
    """The words of a text, A-Z in lower case, each with a space before it and one after the last; empty without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return b" " + b" ".join(words) + b" " if words else b""


def window_places(words: bytes, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """First and last byte (excluded) of every run of ``size`` words of a normal text, or of all words of a shorter one.

    A window has a space at either end; a text without words has none.
    """
    spaces = np.flatnonzero(np.frombuffer(words, np.uint8) == 32)
    if len(spaces) < 2:
        return spaces[:0], spaces[:0]
    width = min(size, len(spaces) - 1)
    return spaces[:-width], spaces[width:] + 1


class Searcher:
    """All occurrences of strings of at least ``least`` bytes in a buffer.

    The strings are places in one buffer.  ``shift`` tells for the hash of a block of
    bytes how far a position may move on without passing an occurrence; where that
    is nowhere, the block's bucket names the strings with this block at the end of
    their first ``least`` bytes, and these are compared byte by byte.  Many
    positions advance together.
    """

    def __init__(self, data: bytes, starts: np.ndarray, lengths: np.ndarray, block: int) -> None:
        self.data, self.starts, self.lengths = data, starts, lengths.astype(np.int32)
        self.least = least = int(lengths.min())
        self.block = block = min(block, max(2, least // 3))
        self.shift = np.full(2**BITS, least - block + 1, np.int32)
        letters = np.frombuffer(data, np.uint8)
        ends = np.empty(0, np.int64)
        for k in range(least - block + 1):
            ends = self._slot(self._rolled(letters, starts + k, block, 257))
            np.minimum.at(self.shift, ends, np.int32(least - block - k))
        self.in_bucket = np.argsort(ends, kind="stable").astype(np.int32)
        self.first = np.searchsorted(ends[self.in_bucket], np.arange(2**BITS + 1)).astype(np.int32)
        self.head = self._rolled(letters, starts, least, 1_000_003)

    @staticmethod
    def _rolled(letters: np.ndarray, at: np.ndarray, width: int, base: int) -> np.ndarray:
        """Value of the ``width`` bytes from each place on."""
        value = np.zeros(len(at), np.uint64)
        for k in range(width):
            value = value * np.uint64(base) + letters[at + k]
        return value

    @staticmethod
    def _slot(value: np.ndarray) -> np.ndarray:
        return ((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - BITS)).astype(np.int64)

    def find(self, text: bytes) -> Iterator[tuple[int, int]]:
        """``(start, number of the string)`` of every occurrence."""
        data, least, block = np.frombuffer(text, np.uint8), self.least, self.block
        if len(data) < least:
            return
        lane = 4096
        at = np.arange(least - 1, len(data), lane)                  # last byte of the part that is looked at
        stop = np.minimum(at + lane, len(data))
        while len(at):
            names = self._slot(self._rolled(data, at - block + 1, block, 257))
            move = self.shift[names]
            hit = np.flatnonzero(move == 0)
            if len(hit):
                counts = self.first[names[hit] + 1] - self.first[names[hit]]
                which = np.repeat(self.first[names[hit]], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                string = self.in_bucket[which]
                starts = at[hit] - least + 1
                alike = np.repeat(self._rolled(data, starts, least, 1_000_003), counts) == self.head[string]
                for start, s in zip(np.repeat(starts, counts)[alike].tolist(), string[alike].tolist(), strict=True):
                    if text.startswith(self.data[self.starts[s]:self.starts[s] + self.lengths[s]], start):
                        yield start, s
            at = at + np.maximum(move, 1)
            going = at < stop
            at, stop = at[going], stop[going]


class Benchmark:
    """Windows of benchmark items, in classes of similar length so that a short item does not shorten the shifts of all.

    The items' words lie in one buffer, and a window is a place in it; equal
    windows are one, with the numbers of all their items.
    """

    def __init__(self, items: Sequence[tuple[str | None, str | None]], size: int = WINDOW) -> None:
        self.names = [name for name, _ in items]
        texts = [normal(text) for _, text in items]
        data, base = b"".join(texts), np.cumsum([0, *map(len, texts)])
        places = [window_places(t, size) for t in texts]
        starts = np.concatenate([base[:0], *[a + b for (a, _), b in zip(places, base, strict=False)]])
        lengths = np.concatenate([base[:0], *[b - a for a, b in places]])
        owner = np.repeat(np.arange(len(texts), dtype=np.int32), [len(a) for a, _ in places])
        names = np.frombuffer(b"".join(xxhash.xxh3_128_digest(data[a:a + n]) for a, n in zip(starts.tolist(), lengths.tolist(), strict=True)), "V16")
        _, one, which = np.unique(names, return_index=True, return_inverse=True)
        self.owners = owner[np.argsort(which, kind="stable")]           # items of each window, window after window
        self.first = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(one)))])
        self.searchers: list[Searcher] = []
        self.numbers: list[np.ndarray] = []
        edges = [3, 6, 12, 24, 40, 2**62]
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            some = np.flatnonzero((lengths[one] >= low) & (lengths[one] < high))
            if len(some):
                self.searchers.append(Searcher(data, starts[one][some], lengths[one][some], BLOCK))
                self.numbers.append(some.astype(np.int32))

    def items_of(self, window: int) -> Iterator[str]:
        return (self.names[k] for k in self.owners[self.first[window]:self.first[window + 1]] if self.names[k] is not None)

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, int]], list[str]]:
        """Number of words, word spans inside occurrences (end excluded), and the items that occur."""
        return self.scan_all([text])[0]

    def scan_all(self, texts: Sequence[str | None]) -> list[tuple[int, list[tuple[int, int]], list[str]]]:
        """As :meth:`scan`, for many texts in one buffer; a zero byte keeps them apart."""
        parts = [normal(t) for t in texts]
        buffer = b"\0".join(parts)
        data = np.frombuffer(buffer, np.uint8)
        base = np.cumsum([0] + [len(p) + 1 for p in parts])
        spaces = np.cumsum(data == 32) if len(data) else np.empty(0, np.int64)
        spans: list[list[tuple[int, int]]] = [[] for _ in parts]
        names: list[set[str]] = [set() for _ in parts]
        for searcher, numbers in zip(self.searchers, self.numbers, strict=True):
            found = list(searcher.find(buffer))
            if not found:
                continue
            starts = np.array([f[0] for f in found])
            rows = np.searchsorted(base, starts, side="right") - 1
            ends = starts + searcher.lengths[[f[1] for f in found]] - 1
            lead = np.where(base[rows] > 0, spaces[base[rows] - 1], 0)
            first, last = spaces[starts] - 1 - lead, spaces[ends] - 1 - lead
            for row, a, b, (_, s) in zip(rows.tolist(), first.tolist(), last.tolist(), found, strict=True):
                spans[row].append((a, b))
                names[row].update(self.items_of(numbers[s]))
        return [(max(0, p.count(b" ") - 1), joined(s), sorted(n)) for p, s, n in zip(parts, spans, names, strict=True)]


def joined(spans: Sequence[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


FOUND = "struct<n_words:long,spans:array<struct<first:long,last:long>>,items:array<string>>"


_BENCHMARKS: dict[str, Benchmark] = {}


def _process_benchmark(name: str, items: list[tuple[str, str]], size: int) -> Benchmark:
    """The process's tables of these items, built once; those of another pass go."""
    if name not in _BENCHMARKS:
        _BENCHMARKS.clear()
        _BENCHMARKS[name] = Benchmark(items, size)
    return _BENCHMARKS[name]


def _search(items: list[tuple[str, str]], size: int) -> Column:
    name = xxhash.xxh3_128_hexdigest(repr((size, items)).encode("utf-8", "surrogatepass"))

    @F.pandas_udf(FOUND)
    def search(texts: pd.Series, spans: pd.Series, names: pd.Series) -> pd.DataFrame:
        release()
        bench = _process_benchmark(name, items, size)
        out = []
        for k in range(0, len(texts), 256):
            found = bench.scan_all([t if isinstance(t, str) else None for t in texts[k:k + 256]])
            for (n, here, which), was, had in zip(found, spans[k:k + 256], names[k:k + 256], strict=True):
                before = [] if was is None else [(s["first"], s["last"]) for s in was]
                out.append((n, [{"first": a, "last": b} for a, b in joined([*before, *here])],
                            sorted({*which, *([] if had is None else had)})))
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return search


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", size: int = WINDOW, found: str = "found") -> DataFrame:
    """``docs`` with a column ``found (n_words, spans, items)`` added.

    Words are runs of digits, letters a-z (A-Z counts as such) and characters
    beyond ASCII.  A window is ``size`` consecutive words of an item, or all words
    of a shorter one; ``spans`` are the document's words inside occurrences of
    windows, ``items`` the ids (as strings, sorted) of items with an occurring
    window.  Windows that several items share count for each.

    Null and wordless texts have no words and no finds; so do null items.  A null
    item id is left out of ``items`` but its windows count.  Rows are neither
    dropped nor moved: documents are not shuffled; other columns pass through, but one
    named like ``found``, in whatever case, gives way to it.  Texts are read whole, however
    long; an empty table stays empty.  Items go to the tasks in passes of bounded
    size, each adding to what the pass before found.
    """
    docs = docs.drop(*[c for c in docs.columns if c.lower() == found.lower()])
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text")).where("text is not null")
    size_of = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = 1 + size_of // PASS_BYTES
    text, spans, names = F.col(text_col), F.lit(None).cast("array<struct<first:long,last:long>>"), F.lit(None).cast("array<string>")
    out = docs.withColumn(found, F.struct(F.lit(None).cast("long").alias("n_words"), spans.alias("spans"), names.alias("items")))
    for k in range(passes):
        some = items.where(F.pmod(F.xxhash64("id", "text"), F.lit(passes)) == k).collect()       # at most about PASS_BYTES
        search = _search([(r.id, r.text) for r in some], size)
        out = out.withColumn(found, search(text, F.col(f"{found}.spans"), F.col(f"{found}.items")))
        if passes > 1:
            out = stored(out, f"pass-{k}")                  # the next pass's tables come alone
    return out


def hits(found: str = "found") -> Column:
    """Number of a document's words inside occurrences."""
    return F.aggregate(f"{found}.spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])


def digest_of_items(found: str = "found") -> Column:
    return F.sha2(F.array_join(f"{found}.items", ","), 256)

