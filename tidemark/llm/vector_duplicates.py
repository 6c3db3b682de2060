"""Near-duplicate vectors by spherical-cap filters whose directions form a product code."""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.store import stored

BLOCKS, CODES, SEED = 4, 8, 20269
#: The most directions of one code that a vector is listed under.
MOST = 200
#: Expected number of filters that two vectors of cosine 0.9 share; more codes are drawn until it is reached.
SHARED = 32
#: With more codes than this, fewer directions are used instead.
MOST_CODES = 64


def near_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.9) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per row of ``vectors``.

    Two rows are linked if the cosine of their vectors, in double precision, is
    at least ``cosine``; ``n_links`` counts the other rows linked directly and
    ``component_id`` is the least id reachable over links.  Equal vectors form
    one class that is compared once and counted with its size.

    A filter direction joins one codeword of each of four blocks of a rotated
    space; a vector is listed under every direction whose inner product with it
    exceeds its limit, found block by block without visiting the other
    directions.  The limit makes exp(4 sqrt(d) inner product) at least 1/200 of
    its sum over all directions of the code, so a list has 200 entries at most
    without being cut.  Classes that share a direction are verified.  The number
    of directions grows with the number of classes, so chance meetings stay few;
    near vectors share fewer directions of one code then, so the number of codes
    grows as well, from eight, until two vectors of cosine 0.9 share 32 filters on
    average; where that takes over 64 codes, as for short vectors, there are fewer
    directions instead.  With the directions for 51,282, for 1 and for 10 million
    vectors of 64 components, each of 2,000 random pairs of cosine 0.9 shared one.  A lower ``cosine`` finds fewer.

    Vectors that are null, empty, zero or hold a null or non-finite component,
    and rows with a null id, have no links and are kept with their own id as
    component.  Vectors of different lengths are not compared.  Rows that share
    an id count as one node of a component.  Other columns are ignored.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = (F.coalesce(F.size("v") > 0, F.lit(False)) & F.col("vec_id").isNotNull()
             & F.coalesce(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))), F.lit(False))
             & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))
    key = F.sha2(F.array_join(F.transform("v", lambda x: (x + F.lit(0.0)).cast("string")), ","), 256)
    keyed = stored(rows.withColumn("key", F.when(sound, key)).withColumn("v", F.when(sound, F.col("v"))), "keyed")
    classes = stored(keyed.where("key is not null").groupBy("key").agg(
        F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("members"), F.first("v").alias("v"))
        .withColumn("name", F.xxhash64("key")), "vectors")
    near = _verified(classes, _candidates(classes), cosine)
    linked = components(near.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")))
    outside = (near.select(F.explode(F.array(F.struct(F.col("key_a").alias("key"), F.col("members_b").alias("n")),
                                             F.struct(F.col("key_b").alias("key"), F.col("members_a").alias("n")))).alias("e"))
               .groupBy("e.key").agg(F.sum("e.n").alias("outside")))
    facts = (classes.drop("v", "name").join(outside, "key", "left").join(linked, F.col("rep") == F.col("node"), "left")
             .where("members > 1 or node is not null")
             .select("key", (F.col("members") - 1 + F.coalesce("outside", F.lit(0))).alias("n"),
                     F.coalesce("component", "rep").alias("component")))
    return (keyed.drop("v").join(stored(facts, "facts"), "key", "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))))


class Filters:
    """The directions of one code for one dimension: a rotation and the codewords of each block."""

    def __init__(self, dim: int, words: int, code: int) -> None:
        rng = np.random.default_rng([SEED, code, dim])
        self.words, self.width = words, -(-dim // BLOCKS)
        size = self.width * BLOCKS
        self.turn = np.linalg.qr(rng.standard_normal((size, size)))[0][:dim]
        codes = rng.standard_normal((BLOCKS, words, self.width))
        self.codes = 4 * sqrt(size) * codes / np.linalg.norm(codes, axis=2, keepdims=True)

    def lists(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(row, filter)`` of every direction above the limit; a prefix goes once its best rest cannot reach it."""
        parts = (unit @ self.turn).reshape(len(unit), BLOCKS, self.width)
        scores = np.einsum("nbw,bkw->bnk", parts, self.codes)
        scores -= scores.max(axis=2, keepdims=True)
        scores -= np.log(np.exp(scores).sum(axis=2, keepdims=True))
        best = scores.max(axis=2)
        limit = np.minimum(-np.log(MOST), best.sum(axis=0) - 1e-9)  # the best direction of all is always listed
        row, name, total = np.arange(len(unit)), np.zeros(len(unit), np.int64), np.zeros(len(unit))
        for b in range(BLOCKS):
            sums = total[:, None] + scores[b][row]
            at, word = np.nonzero(sums >= (limit - best[b + 1:].sum(axis=0))[row][:, None])
            row, name, total = row[at], name[at] * self.words + word, sums[at, word]
        return row, name


def codes_of(dim: int, words: int, pairs: int = 300, tried: int = 4) -> int:
    """The number of codes that lets random pairs of cosine 0.9 share ``SHARED`` filters on average, counted on a few codes."""
    if dim < 2:
        return CODES
    x, y = np.random.default_rng([SEED, dim, words]).standard_normal((2, pairs, dim))
    x = _unit(x)
    y = 0.9 * x + sqrt(1 - 0.9**2) * _unit(y - (x * y).sum(axis=1, keepdims=True) * x)
    shared = 0
    for code in range(tried):
        of = Filters(dim, words, code)
        a, b = (np.stack(of.lists(v)).T for v in (x, y))
        shared += len(set(map(tuple, a.tolist())) & set(map(tuple, b.tolist())))
    return max(CODES, -(-SHARED * pairs * tried // max(1, shared)))


def plan_of(dim: int, classes: int) -> tuple[int, int]:
    """Codewords of a block and number of codes for so many classes; fewer codewords where near vectors would hardly meet."""
    words = min(max(16, round((256 * max(1, classes)) ** (1 / BLOCKS))), 4 ** -(-dim // BLOCKS))
    while (codes := codes_of(dim, words)) > MOST_CODES and words > 4:
        words = words * 3 // 4
    return words, codes


def _candidates(classes: DataFrame) -> DataFrame:
    """Distinct pairs of class hashes that share a filter."""
    lengths = {r.dim: r["count"] for r in classes.groupBy(F.size("v").alias("dim")).count().collect()}     # a row per length of vectors
    plan = {dim: plan_of(dim, sum(lengths.values())) for dim in lengths}

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[int, list[Filters]] = {}
        for batch in batches:
            names, values = batch.column(0).to_numpy(zero_copy_only=False), [np.array(v) for v in batch.column(1).to_pylist()]
            dims = np.array([len(v) for v in values])
            for dim in np.unique(dims).tolist():
                words, n_codes = plan[dim]
                codes.setdefault(dim, [Filters(dim, words, c) for c in range(n_codes)] if dim not in codes else [])
                places = np.flatnonzero(dims == dim)
                for k in range(0, len(places), 128):
                    some = places[k:k + 128]
                    unit = _unit(np.stack([values[i] for i in some]))
                    for code, of in enumerate(codes[dim]):
                        row, direction = of.lists(unit)
                        group = (direction * n_codes + code) * 65536 + dim % 65536     # vectors of other lengths meet nobody
                        yield pa.RecordBatch.from_arrays([pa.array(group), pa.array(names[some[row]])], ["filter", "name"])

    lists = stored(classes.select("name", "v").repartition("name").mapInArrow(listed, "filter long, name long"), "lists")
    a, b = (lists.withColumnRenamed("name", f"name_{x}") for x in "ab")
    return a.join(b, "filter").where("name_a < name_b").select("name_a", "name_b").distinct()


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)                    # no overflow for large components
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _verified(classes: DataFrame, pairs: DataFrame, cosine: float) -> DataFrame:
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch])
                a, b = (list(batch.column(k).to_numpy(zero_copy_only=False)) for k in (4, 5))
                good = [len(x) == len(y) and float(np.dot(x, y)) >= cosine for x, y in zip(_units(a), _units(b), strict=True)]
                yield from table.select([0, 1, 2, 3, 6, 7]).filter(pa.array(good)).to_batches()

    sides = [classes.select(F.col("name").alias(f"name_{x}"), F.col("key").alias(f"key_{x}"), F.col("rep").alias(f"rep_{x}"), F.col("members").alias(f"members_{x}"),
                            F.col("v").alias(f"v_{x}")) for x in "ab"]
    both = pairs.join(sides[0], "name_a").join(sides[1], "name_b").select(
        "key_a", "key_b", "rep_a", "rep_b", "v_a", "v_b", "members_a", "members_b")
    return stored(both.mapInArrow(compare, "key_a string, key_b string, rep_a long, rep_b long, members_a long, members_b long"), "near")


def _units(vectors: list) -> list[np.ndarray]:
    return [_unit(np.asarray(v, np.float64)[None])[0] for v in vectors]
