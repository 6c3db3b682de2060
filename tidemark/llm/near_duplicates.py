"""MinHash near-duplicate groups: minima, bands, verification, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.distinct_words import release
from tidemark.llm.store import keys_of, stored
from tidemark.llm.words import mixed, shingles

HASHES, BANDS, SEED = 128, 32, 20261
#: Members of a bucket that are compared with its other members one by one; larger buckets go on in blocks.
PIVOTS, BLOCK = (1, 4), 200


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row per row of ``docs``.

    Two texts are linked if ``100 * shared >= percent * all`` over their sets of
    ``width``-word shingles, checked on the full sets; ``component_id`` is the
    least id reachable over links.  Equal sets form one class, and only one
    member of a class is compared.  Candidates are pairs that agree in a band of
    four of the 128 minima: a pair at the threshold of 0.8 is missed with
    probability (1 - 0.8^4)^32 < 1e-7.  Pairs within a band's bucket are not
    listed; its members are compared with up to 4 pivots of the bucket as long as it holds
    members of different components, so a group of n copies costs about n
    comparisons.  What larger buckets leave open is compared in blocks: all texts
    outside the main component against all texts, without a row for each pair.

    Ids are whole numbers.  Text that is null, empty or blank has no shingles and
    is linked with nothing.  Rows that share an id count as one node.  A row with a
    null id is linked with nothing, gets a null component and is kept.  Columns
    other than the two named are ignored, whatever their names.
    """
    signed = stored(_signed(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")), width), "signed")
    classes = stored(signed.where("digest is not null and doc_id is not null").groupBy("digest")
                     .agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("minima").alias("minima")), "classes")
    joined = _groups(docs, id_col, text_col, width, percent, classes)
    copies = classes.where("members > 1").select("digest", "rep")
    out = (signed.drop("minima").join(copies, "digest", "left")
           .withColumn("node", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")))
           .join(joined, "node", "left")
           .select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _constants() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    a, b = rng.integers(0, 2**63, (2, HASHES, 1), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def minima(found: np.ndarray) -> np.ndarray:
    """The low half of the least value of each of the universal hashes over a shingle set."""
    a, b = _constants()
    least = np.full(HASHES, 2**32 - 1, np.uint64)
    for k in range(0, len(found), 4096):
        least = np.minimum(least, ((a * found[k:k + 4096] + b) >> np.uint64(32)).min(axis=1))
    return least.astype(np.uint16)


def _signed(docs: DataFrame, width: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            counts, digests, lows = [], [], []
            for text in batch.column(1):
                found = shingles(text.as_py(), width)
                counts.append(len(found))
                digests.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                lows.append(minima(found).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.binary()), pa.array(lows, pa.binary())],
                ["doc_id", "n_shingles", "digest", "minima"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, minima binary")


def _buckets(classes: DataFrame) -> DataFrame:
    """``(bucket, rep)`` for every band of every class."""
    def band(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in batches:
            if batch.num_rows:
                lows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(-1, BANDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(mixed(lows + salt).view(np.int64).ravel()),
                     pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), BANDS))], ["bucket", "rep"])

    return classes.select("rep", "minima").mapInArrow(band, "bucket long, rep long")


def _groups(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, classes: DataFrame) -> DataFrame:
    """``(node, component)`` of the representatives with links."""
    buckets = _buckets(classes)
    shared = stored(buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "shared")
    in_order = Window.partitionBy("bucket").orderBy(F.xxhash64("rep"), "rep")
    members = stored(buckets.join(shared, "bucket").select("bucket", "rep", (F.row_number().over(in_order) - 1).alias("place")), "members")
    names = stored(members.select("rep").distinct(), "candidates")
    sets = stored(_sets(docs, id_col, text_col, width, names, classes), "sets")

    # First each member with the pivot that it meets in most bands.
    met = members.join(members.where("place = 0").select("bucket", F.col("rep").alias("pivot")), "bucket").where("place > 0 and rep <> pivot")
    best = (met.groupBy("rep", "pivot").count().groupBy("rep")
            .agg(F.max_by("pivot", F.struct("count", F.xxhash64("pivot"))).alias("pivot")))
    tested = _tested(best.select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct(), sets, percent)
    found, first = components(tested.where("linked")), 0
    for last in PIVOTS:
        open_ = _open(members, found, first)
        if open_.isEmpty():
            return found
        pivots = open_.where(F.col("place").between(first, last - 1)).select(
            "bucket", F.col("rep").alias("pivot"), F.col("component").alias("of"), F.col("place").alias("at"))
        pairs = (open_.join(pivots, "bucket").where("place > at and component <> of")
                 .select(F.least("rep", "pivot").alias("a"), F.greatest("rep", "pivot").alias("b")).distinct()
                 .join(tested.select("a", "b"), ["a", "b"], "left_anti"))
        more = _tested(pairs, sets, percent)
        found, tested, first = _merged(found, more.where("linked")), tested.unionByName(more), last
    open_ = _open(members, found, first)
    return found if open_.isEmpty() else _merged(found, _in_blocks(open_, sets, percent))


def _merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links: only the graph of the components that these connect is searched."""
    if links.isEmpty():
        return found
    for side in "ab":
        names = found.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
        links = links.join(names, side, "left").withColumn(f"of_{side}", F.coalesce(f"of_{side}", side))
    moved = stored(components(links.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))), "moved")
    renamed = (found.join(moved.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
               .select("node", F.coalesce("to", "component").alias("component")))
    return stored(renamed.unionByName(moved.join(found, "node", "left_anti")), "components")


def _open(members: DataFrame, found: DataFrame, first: int) -> DataFrame:
    """Members still to be compared, of the buckets where they belong to more than one component."""
    now = (members.where(F.col("place") >= first).join(found, F.col("rep") == F.col("node"), "left")
           .select("bucket", "rep", "place", F.coalesce("component", "rep").alias("component")))
    mixed_ = now.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("bucket")
    return stored(now.join(stored(mixed_, "mixed"), "bucket"), "open")


def _in_blocks(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components among the members of large buckets.

    Buckets that share members form a cluster.  Its members outside the cluster's
    largest component are the queries; blocks of queries meet blocks of members,
    and a block gives a link for each query and component, not for each pair.
    """
    centres = open_.groupBy("bucket").agg(F.min("rep").alias("b"))
    clusters = components(open_.join(stored(centres, "centres"), "bucket").select(F.col("rep").alias("a"), "b").distinct())
    members = (open_.select("rep", "component").distinct().join(clusters.withColumnRenamed("component", "cluster"), F.col("rep") == F.col("node"))
               .select("cluster", "rep", "component"))
    sizes = (members.groupBy("cluster", "component").count().groupBy("cluster")
             .agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.sum("count").alias("n"), F.max("count").alias("in_main")))
    placed = members.join(sizes, "cluster").select(
        "cluster", "rep", "component", F.xxhash64("rep").alias("lot"), (F.col("component") != F.col("main")).alias("asks"),
        F.ceil(F.col("n") / BLOCK).alias("across"), F.ceil((F.col("n") - F.col("in_main")) / BLOCK).alias("down"))
    rows = placed.select("cluster", "rep", "component", F.lit(False).alias("asks"), F.pmod("lot", "across").alias("x"),
                         F.explode(F.sequence(F.lit(0).cast("long"), F.col("down") - 1)).alias("y")).unionByName(
        placed.where("asks").select("cluster", "rep", "component", "asks", F.pmod("lot", "down").alias("y"),
                                    F.explode(F.sequence(F.lit(0).cast("long"), F.col("across") - 1)).alias("x")))

    def compare(block: pd.DataFrame) -> pd.DataFrame:
        asking, others = block[block.asks], block[~block.asks]
        rest = [(r, c, np.frombuffer(s, np.uint64)) for r, c, s in zip(others.rep, others.component, others.shingles, strict=True)]
        found = {}
        queries = [(r, c, np.frombuffer(s, np.uint64)) for r, c, s in zip(asking.rep, asking.component, asking.shingles, strict=True)]
        while queries:
            some, size = [], 0
            while queries and (not some or (size + len(queries[-1][2])) * (len(some) + 1) <= 20_000_000):
                some.append(queries.pop())
                size += len(some[-1][2])
            words, at = np.unique(np.concatenate([q[2] for q in some]), return_inverse=True)
            holds = np.zeros((len(some), len(words)), np.bool_)
            holds[np.repeat(np.arange(len(some)), [len(q[2]) for q in some]), at] = True
            lengths, own = np.array([len(q[2]) for q in some]), np.array([q[1] for q in some])
            for rep, component, theirs in rest:
                place = np.minimum(np.searchsorted(words, theirs), len(words) - 1)
                common = holds[:, place[words[place] == theirs]].sum(axis=1)
                near = (100 * common >= percent * (lengths + len(theirs) - common)) & (own != component)
                for k in np.flatnonzero(near):
                    found.setdefault((some[k][0], component), rep)
        return pd.DataFrame([(q, rep) for (q, _), rep in found.items()], columns=["a", "b"]).astype("int64")

    full = rows.join(sets.select("rep", "shingles"), "rep").select("cluster", "x", "y", "rep", "component", "asks", "shingles")
    return stored(full.groupBy("cluster", "x", "y").applyInPandas(compare, "a long, b long"), "block_links")


def _sets(docs: DataFrame, id_col: str, text_col: str, width: int, names: DataFrame, classes: DataFrame) -> DataFrame:
    """Full shingle sets of the candidates, made again from their texts."""
    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            found = [shingles(text.as_py(), width).tobytes() for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([xxhash.xxh3_128_digest(f) for f in found], pa.binary()), pa.array(found, pa.large_binary())],
                schema=pa.schema([("rep", pa.int64()), ("digest", pa.binary()), ("shingles", pa.large_binary())]))

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    rows = texts.join(keys_of(names, names.count()), "rep").mapInArrow(collect, "rep long, digest binary, shingles binary")
    wanted = classes.join(names, "rep").select("rep", "digest", "minima")
    return rows.join(wanted, ["rep", "digest"]).dropDuplicates(["rep", "digest"]).select("rep", "minima", "shingles")


def _tested(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, linked)``; a pair far below the threshold by its minima is not compared in full."""
    pairs = stored(pairs, "pairs")
    least_agreeing = int(HASHES * (percent / 100 - 0.2))            # 5.6 standard deviations below 0.8

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            linked = []
            for la, sa, lb, sb in zip(*(batch.column(k) for k in range(2, 6)), strict=True):
                near = np.count_nonzero(np.frombuffer(la.as_py(), np.uint16) == np.frombuffer(lb.as_py(), np.uint16)) >= least_agreeing
                if near:
                    a, b = (np.frombuffer(s.as_buffer(), np.uint64) for s in (sa, sb))
                    common = len(np.intersect1d(a, b, assume_unique=True))
                    near = 100 * common >= percent * (len(a) + len(b) - common)
                linked.append(bool(near))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], ["a", "b", "linked"])

    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "ids")
    some = sets.join(keys_of(ids, ids.count()), "rep")
    one = some.select(F.col("rep").alias("a"), F.col("minima").alias("la"), F.col("shingles").alias("sa"))
    two = some.select(F.col("rep").alias("b"), F.col("minima").alias("lb"), F.col("shingles").alias("sb"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "la", "sa", "lb", "sb")
    return stored(both.mapInArrow(compare, "a long, b long, linked boolean"), "tested")
