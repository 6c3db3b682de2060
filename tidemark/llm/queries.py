"""The operators applied to the whole test tables, with SQL where SQL can state the result."""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, conversations, decontaminate, divergence, language, near_duplicates, personal_data, pieces, repeated_units, sharding, token_files, toxicity, vector_duplicates
from tidemark.llm.sql import SQL  # noqa: F401
from tidemark.llm.store import stored

SHARDS = 40
#: Bytes of a batch that goes to an executor's Python, which holds several copies of it.
ARROW_BYTES = "16m"


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary file; ``TOKENIZER_FOLDER`` may name another folder."""
    if folder := os.environ.get("TOKENIZER_FOLDER"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the package's modules to the executors' Python, once per application."""
    name = spark.sparkContext.applicationId
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    if name not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        copy = tempfile.mkdtemp(prefix="package-")
        shutil.copytree(f"{top}/tidemark", f"{copy}/src/tidemark", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{copy}/tidemark", "zip", f"{copy}/src"))
        _SHIPPED.add(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), SHARDS)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0, vocabulary=50_257, added=True)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "found.n_words", decontaminate.hits().alias("n_hit"),
                        F.size("found.items").cast("long").alias("n_items"), decontaminate.digest_of_items().alias("items_sha256"),
                        (F.size("found.spans") > 0).alias("contaminated"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    probe = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"),
                                                              F.lit(role).alias("role"), F.lit(said).alias("text"))
                                                     for k, role in enumerate(("user", "assistant"))])).alias("r")).select("r.*")
    out = chat.formatted(chat.table_turns(rows.unionByName(probe), "conv_id"))
    turns = chat.parsed_turns(F.col("formatted"))
    return (out.withColumn("turns", turns).withColumn("learned", chat.under_loss(F.col("formatted"), F.col("loss")))
            .select(F.col("conversation").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256)
                    .alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language.lot_of(F.col("doc_id"), 4) == 2)
    network = language.fit_languages(docs.where(~F.col("held_out")))
    return language.with_language(docs.select("doc_id", "held_out", "text"), network).select("doc_id", "held_out", "lang_pred", "score")


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", language.lot_of(F.col("doc_id"), 3) == 1)
    classifier = toxicity.fit_toxicity(docs.where(~F.col("held_out")), table(spark, sf_dir, "labels"))
    return (toxicity.with_toxicity(docs, classifier).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))
            .select("doc_id", "held_out", "score", "predicted"))


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's piece ids and of the text decoded from them."""
    out = pieces.coded(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("piece_bpe_32k.model"))
    return out.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"),
                      F.length("decoded").cast("long").alias("decoded_chars"), F.crc32(F.encode("decoded", "UTF-8")).alias("decoded_crc32"),
                      (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("same_text"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_duplicates.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text without units that occur earlier, and the removed spans in the original text."""
    out = repeated_units.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    return out.select("doc_id", F.size("removed").cast("long").alias("n_removed"), removed.alias("removed_chars"), "removed", "text")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation after a damage that the checksum of its rows decides, and its cheapest repair."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    said = F.coalesce("text", F.lit(" "))
    damaged = rows.withColumn("lot", F.crc32(F.encode(name, "UTF-8")) % 20).select(
        "conv_id", "turn", F.when(F.col("lot") == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(F.col("lot") == 1, "").when(F.col("lot") == 2, F.regexp_replace(said, "[.!?]", "")).otherwise(said).alias("text"),
        F.explode(F.when(F.col("lot") == 0, F.array()).when(F.col("lot") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"))
    found = conversations.repairs(damaged, stored(conversations.plans(damaged), "plans"))
    ids = rows.select("conv_id").distinct()
    return ids.join(found, ids["conv_id"].eqNullSafe(found["conversation"]), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in conversations.REPORT],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("digest", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def _counting(kind: str) -> Callable[[Column, Column], Column]:
    return lambda n, s: n + (s["kind"] == kind).cast("long")


def op12_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the rules' spans, all spans as text, and the number of those that the trees add."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = personal_data.with_personal_data(docs, personal_data.fit_chooser(docs)).select(
        "doc_id", F.col("personal.base").alias("base"), F.transform("personal.added", lambda s: s.dropFields("chance")).alias("added"))
    of = [F.aggregate("base", F.lit(0).cast("long"), _counting(k)).alias(f"n_{k}") for k in personal_data.KINDS]
    return found.select("doc_id", *of, F.sha2(personal_data.listed(F.col("base")), 256).alias("base_sha256"),
                        personal_data.listed(F.concat("base", "added")).alias("spans"), F.size("added").cast("long").alias("n_added"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_sharding, op2_token_files, op3_decontamination, op4_chat, op5_language, op6_near_duplicates,
                            op7_toxicity, op8_pieces, op9_near_vectors, op10_repeated_units, op11_conversation_repair, op12_personal_data, op13_source_divergence)}
