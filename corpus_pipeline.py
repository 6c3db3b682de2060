"""Five stages from raw documents to pieces; each reads what the stage before stored."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, language, near_duplicates, pieces, repeated_units
from tidemark.llm.queries import ship, table, tokenizer_file
from tidemark.llm.store import keep_only_last, stored, written



def unused(docs: DataFrame, *names: str) -> list[str]:
    """Column names that no column has, in whatever case."""
    taken = {c.lower() for c in docs.columns}
    return [next(n for n in (f"{name}{k or ''}" for k in range(len(taken) + 1)) if n not in taken) for name in names]


def columns(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages; null texts, texts without a letter and texts with too little of any language go.

    A quarter of the labelled texts teaches nothing and sets the limit of the score.
    """
    ship(spark)
    held_out = F.coalesce(language.lot_of(F.col("doc_id"), 4) == 2, F.lit(False))
    network = language.fit_languages(docs.where(~held_out))
    limit = language.least_score(network, docs.where(held_out))
    label, score = unused(docs, "label", "score")
    found = language.with_language(docs, network, label=label, score=score, evidence=True)
    return found.where((F.col(label) != language.UNKNOWN) & (F.col(score) >= limit)).select(*columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; of rows that share an id, all of a kept id stay."""
    ship(spark)
    gone = stored(near_duplicates.near_duplicates(docs).where("not kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, "doc_id", "left_anti").select(*columns(docs))


def drop_repeated_units(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines and sentences that an earlier document has; all rows stay."""
    ship(spark)
    shorter = repeated_units.without_repeats(docs, spans=unused(docs, "removed")[0])
    return shorter.withColumn("n_chars", F.length("text").cast("long")).select(*columns(docs))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    (name,) = unused(docs, "found")
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), found=name)
    return found.where(F.size(f"{name}.spans") == 0).select(*columns(docs))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the check that they decode to its text."""
    ship(spark)
    out = pieces.coded(docs.select("doc_id", "lang", "source", "text"), tokenizer_file("piece_bpe_32k.model"))
    return out.select("doc_id", "lang", "source", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), "ids",
                      F.crc32("ids").alias("ids_crc32"), (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("minhash_near_dedup", drop_near_duplicates),
    ("substring_dedup", drop_repeated_units),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", encode_pieces),
]
#: SQL cannot state a trained network, minima and the like; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored as Parquet and read again; what a stage needed on its way goes after it."""
    docs, since = table(spark, sf_dir, "documents"), written()
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
        keep_only_last(spark, since)
    return docs
