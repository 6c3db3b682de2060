"""How far the sources of a language differ in the words they use, by exact sums over all kept terms.

The distance of two sources is a sum over all terms of their language.  Nearly
all of it is what terms give that a source does not have; only the rest is looked
at term by term: every term is a row of (source, share) for the sources that have
it, in the order of their names.  Rows go into a frequent-pattern tree with the
number of terms that have this row, and a node gives its correction for the pairs
it forms with its ancestors once, for all terms that pass through it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.distinct_words import release
from tidemark.llm.store import stored

LEAST_DOCS, UNIT, TOP = 10, 1_000_000_000, 10
#: Counts that a task gathers before it hands them on.
MOST_COUNTS = 400_000
#: Pairs of nodes that are worked out in one go.
PAIRS = 1_000_000
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and characters beyond ASCII, with A-Z in lower case, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


def counted(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences and documents of each term; a row with a null term for each group."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        found: dict[tuple[str, str], tuple[Counter, Counter]] = {}
        size = 0

        def rows() -> Iterator[pa.RecordBatch]:
            for (lang, source), (n, owners) in found.items():
                names = [None, *n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()),
                     pa.array(names, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *map(owners.__getitem__, n)], pa.int64())], ["lang", "source", "term", "n", "docs"])
            found.clear()

        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, owners = found.setdefault((lang, source), (Counter(), Counter()))
                words = terms_of(text)
                before = len(n)
                n.update(words)
                owners.update(set(words))
                size += len(n) - before
                if size > MOST_COUNTS:
                    yield from rows()
                    size = 0
        yield from rows()

    read = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    partial = read.mapInArrow(count, "lang string, source string, term string, n long, docs long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column | str, all_: Column | str) -> Column:
    """``1 + floor(UNIT * (count + 2) / all)``, exactly, where ``all`` is the group's occurrences and twice its number of terms."""
    top = (F.col(count) if isinstance(count, str) else count) + F.lit(2)
    return F.lit(1).cast("long") + F.call_function(
        "div", top.cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(18,0)"), (F.col(all_) if isinstance(all_, str) else all_).cast("decimal(20,0)"))


def distance(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))`` of two shares."""
    return F.call_function("div", (p - q) * (p - q), p + q)


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class Tree:
    """A frequent-pattern tree of sorted rows, built part by part; only the nodes of one part are held.

    ``add`` takes rows of ``(source, share, share of an absent term)`` with the number
    of terms that have the row.  A node's number of terms is the sum over the rows
    below it; with each ancestor it gives a correction once.
    """

    def __init__(self) -> None:
        self.names: dict[str, int] = {}
        self.strings: list[str] = []
        self.sums: dict[int, int] = {}

    def add(self, paths: list[list[tuple[str, int, int]]], terms: list[int]) -> None:
        node, open_ = [], []                            # nodes: (path, depth, terms); the open ones form the latest path
        before: list[tuple[str, int, int]] = []
        for k, (path, n) in enumerate(zip(paths, terms, strict=True)):
            same = 0
            while same < min(len(path), len(before)) and path[same] == before[same]:
                same += 1
            del open_[same:]
            for at in range(same, len(path)):
                open_.append(len(node))
                node.append([k, at, 0])
            for j in open_:
                node[j][2] += n
            before = path
        lengths = np.array([len(p) for p in paths], np.int64)
        first = np.cumsum(lengths) - lengths
        for source in {s for p in paths for s, _, _ in p}.difference(self.names):
            self.names[source] = len(self.strings)
            self.strings.append(source)
        source = np.array([self.names[s] for p in paths for s, _, _ in p], np.int64)
        here = np.array([v for p in paths for _, v, _ in p], np.int64)
        absent = np.array([v for p in paths for _, _, v in p], np.int64)
        nodes = np.array([x for x in node if x[1]], np.int64).reshape(-1, 3)     # a node below the root has no ancestors
        edges = np.cumsum(nodes[:, 1]) if len(nodes) else np.empty(0, np.int64)
        cuts = np.searchsorted(edges, np.arange(PAIRS, (int(edges[-1]) if len(edges) else 0) + PAIRS, PAIRS), side="left") + 1
        for some in np.split(nodes, cuts):
            if len(some):
                self._pairs(some, first, source, here, absent)

    def _pairs(self, nodes: np.ndarray, first: np.ndarray, source: np.ndarray, here: np.ndarray, absent: np.ndarray) -> None:
        path, at, n = nodes.T
        upper = np.repeat(first[path], at) + np.arange(at.sum()) - np.repeat(np.cumsum(at) - at, at)
        lower = np.repeat(first[path] + at, at)
        p, p0, q, q0 = here[lower], absent[lower], here[upper], absent[upper]
        more = (_distance(p, q) - _distance(p, q0) - _distance(p0, q) + _distance(p0, q0)) * np.repeat(n, at)
        pair, which = np.unique(source[upper] << 32 | source[lower], return_inverse=True)
        sums = np.zeros(len(pair), np.int64)
        np.add.at(sums, which, more)
        for name, value in zip(pair.tolist(), sums.tolist(), strict=True):
            self.sums[name] = self.sums.get(name, 0) + value

    def take(self) -> list[tuple[str, str, int]]:
        """``(lesser source, greater source, sum)`` since the last call."""
        out = [(self.strings[k >> 32], self.strings[k & (2**32 - 1)], v) for k, v in self.sums.items()]
        self.sums.clear()
        return out


def _corrections(rows: DataFrame) -> DataFrame:
    """``(lang, a, b, more)`` of sorted rows ``(lang, path, terms)``."""
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, now = Tree(), None

        def done() -> pa.RecordBatch:
            found = tree.take()
            return pa.RecordBatch.from_arrays(
                [pa.array([now] * len(found), pa.string()), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string()),
                 pa.array([f[2] for f in found], pa.int64())], ["lang", "a", "b", "more"])

        for batch in batches:
            langs, terms = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            at = 0
            while at < len(langs):
                if langs[at] != now or len(tree.sums) > MOST_COUNTS:
                    if tree.sums:
                        yield done()
                    now, tree = langs[at], Tree()
                end, size = at, 0
                while end < len(langs) and langs[end] == now and size < PAIRS // 4:
                    size += len(batch.column(1)[end])
                    end += 1
                paths = [[(x["source"], x["p"], x["p0"]) for x in path] for path in batch.column(1).slice(at, end - at).to_pylist()]
                tree.add(paths, terms[at:end])
                at = end
        if tree.sums:
            yield done()

    ordered = rows.repartitionByRange("lang", "path").sortWithinPartitions("lang", "path")
    return ordered.select("lang", "path", "terms").mapInArrow(grow, "lang string, a string, b string, more long").groupBy("lang", "a", "b").agg(
        F.sum("more").alias("more"))


def divergence(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least_docs: int = LEAST_DOCS,
               top: int = TOP) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: how far each source is from the others of its language, and by which terms.

    Terms are runs of letters (ASCII ones and all characters beyond ASCII, A-Z in
    lower case); a language keeps those in at least ``least_docs`` of its documents.
    A group, or a language, gives a kept term that occurs ``count`` times there the
    share ``1 + floor(10^9 (count + 2) / (N + 2 V))``, with V kept terms and N
    occurrences of them.  Part ``pair`` ranks all other sources by the sum over all
    kept terms of ``floor((p - q)^2 / (p + q))``; part ``term`` gives the ``top`` terms
    whose share exceeds that of the language.  Greater values come first, then
    the lesser name in UTF-8.

    Null texts, languages and sources count as ''.  Groups without terms take part;
    with no kept term at all distances are 0.  An empty table gives no rows.  Other
    columns are ignored, whatever their names.  A text is read whole, however long;
    a row of the tree has one entry for each source that has the term.
    """
    counts = stored(counted(docs, lang_col, source_col, text_col), "counts")
    kept = stored(counts.where("term is not null").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("in_lang"))
                  .where(F.col("docs") >= least_docs).select("lang", "term", "in_lang"), "kept")
    entries = stored(counts.where("term is not null").join(kept, ["lang", "term"]).select("lang", "term", "source", "n", "in_lang"), "entries")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("in_lang").alias("lang_n"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = (counts.where("term is null").select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", F.coalesce("v", F.lit(0).cast("long")).alias("v"),
                      (F.coalesce("n", F.lit(0).cast("long")) + 2 * F.col("v")).alias("all"), (F.col("lang_n") + 2 * F.col("v")).alias("lang_all")))
    groups = stored(groups.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0).cast("long"), "all"))), "groups")
    shares = stored(entries.join(groups, ["lang", "source"])
                    .select("lang", "term", "source", share("n", "all").alias("p"), share("in_lang", "lang_all").alias("q"), "p0"), "shares")

    first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    words = (shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top))

    # What the terms of one source give beside a source without them.
    one = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("terms")).withColumnRenamed("source", "a")
    ends = groups.select("lang", F.col("source").alias("a"), "v", F.col("p0").alias("p0_a"))
    others = groups.select("lang", F.col("source").alias("b"), F.col("p0").alias("p0_b"))
    pairs = ends.join(others, "lang").where("a <> b")
    alone = (one.join(pairs, ["lang", "a"]).groupBy("lang", "a", "b")
             .agg(F.sum((distance(F.col("p"), F.col("p0_b")) - distance(F.col("p0_a"), F.col("p0_b"))) * F.col("terms")).alias("more"))
             .select("lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "more"))
    nothing = pairs.where("a < b").select("lang", "a", "b", F.coalesce(distance(F.col("p0_a"), F.col("p0_b")) * F.col("v"), F.lit(0).cast("long")).alias("more"))
    entry = F.struct("source", "p", "p0")
    paths = (shares.groupBy("lang", "term").agg(F.array_sort(F.collect_list(entry)).alias("path"))
             .groupBy("lang", "path").agg(F.count(F.lit(1)).alias("terms")).where(F.size("path") > 1))
    sums = nothing.unionByName(alone).unionByName(_corrections(stored(paths, "paths"))).groupBy("lang", "a", "b").agg(F.sum("more").alias("value"))
    near = (sums.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")),
                                                  F.struct(F.col("b").alias("source"), F.col("a").alias("item")))).alias("e"), "value")
            .select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value").withColumn("rank", F.row_number().over(first)))
    return near.unionByName(words)
