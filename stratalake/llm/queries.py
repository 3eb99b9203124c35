"""The registered query of each operator: its whole table, production parameters, digests of what it returns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.checks.workspace import new_folder
from stratalake.llm import language, personal_data, quality
from stratalake.llm.chat import chain, format_conversations, read_conversations
from stratalake.llm.common import ascii_lower, table
from stratalake.llm.decontamination import hit_spans
from stratalake.llm.divergence import source_divergence
from stratalake.llm.jaccard_join import similar_groups
from stratalake.llm.labelled import held_out
from stratalake.llm.line_dedup import drop_shared_lines
from stratalake.llm.manifest import manifest_proofs, proof
from stratalake.llm.merkle import fingerprints
from stratalake.llm.mixing import mix
from stratalake.llm.sharding import shard_by_bytes
from stratalake.llm.token_files import read_token_files, write_token_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


@query("op1_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~held_out(F.col("doc_id"))))
    return language.identify(docs, model).withColumn("held_out", held_out(F.col("doc_id")))


@query("op3_quality_classifier")
def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = quality.score(docs, quality.train(docs, labels))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query("op4_mixing_sources")
def mixing_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")


@query("op6_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_shared_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


@query("op7_token_files")
def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "tokens")
    shards = write_token_files(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, shards)


@query("op8_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hit_spans(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


@query("op10_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents"))


@query("op9_merkle_fingerprints")
def merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fingerprints(table(spark, sf_dir, "documents"))
    return rows.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


@query("op2_chat_formatting")
def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    columns = ["conv_id", "turn", "role", "text"]
    return read_conversations(format_conversations(chain(given.select(columns).unionByName(own))))


@query("op5_personal_data")
def personal_data_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data.personal_data(table(spark, sf_dir, "documents"))
    counts = [personal_data.count_of(F.col("base"), kind).alias(f"n_{kind}") for kind in personal_data.KINDS]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(personal_data.span_list(F.col("base")), 256).alias("base_sha256"),
        personal_data.span_list(F.col("spans")).alias("spans"),
    )


@query("op11_source_divergence")
def divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


@query("op13_merkle_manifest")
def merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    text = F.when(tampered, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    rows = manifest_proofs(table(spark, sf_dir, "documents"), {"text": text})
    return rows.withColumn("proof_sha256", F.sha2(proof(F.col("path")), 256)).drop("path")


@query("op12_histogram_sharding")
def histogram_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), 40)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
