"""A training corpus from raw documents: good texts, one of each group of near copies, no benchmarks, mixed, as token files."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from stratalake.checks.workspace import new_folder
from stratalake.llm import quality
from stratalake.llm.common import table
from stratalake.llm.decontamination import contamination
from stratalake.llm.jaccard_join import similar_groups
from stratalake.llm.labelled import held_out
from stratalake.llm.mixing import mix, take_words
from stratalake.llm.token_files import read_token_files, write_token_files

#: Documents with a lower score are rejected.
LEAST_QUALITY = 0.7
TOKENIZER = "word_bpe_49k.json"


def _fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    while name in docs.columns:
        name = f"_{name}"
    return name


def _with_key(docs: DataFrame) -> tuple[DataFrame, str]:
    """The documents with a column that tells rows with another doc_id or text apart."""
    key, text = _fresh(docs, "row_key"), F.coalesce("text", F.lit(""))
    hashes = F.hex(F.xxhash64(text)), F.hex(F.xxhash64(F.lit("text"), text))
    return docs.withColumn(key, F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), *hashes)), key


def _once(docs: DataFrame) -> tuple[DataFrame, str]:
    """Keyed documents, one of those with equal doc_id and text; texts are shuffled for it only where there are such."""
    keyed, key = _with_key(docs)
    counts = keyed.groupBy(key).agg(F.count("*").alias("n"))
    return (keyed.dropDuplicates([key]) if counts.where("n > 1").limit(1).count() else keyed), key


def _without(keyed: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """The keyed rows but for those whose key is among the given ones (doc_id)."""
    other = _fresh(keyed, "other_key")
    return keyed.join(gone.select(F.col("doc_id").alias(other)).distinct(), F.col(key) == F.col(other), "left_anti")


def _in_order(keyed: DataFrame, key: str) -> tuple[DataFrame, str]:
    """The rows with their key in a form whose order is that of the doc_ids, null ids last, then of the texts' hashes."""
    name, number = _fresh(keyed, "ordered_key"), F.col("doc_id")
    if isinstance(keyed.schema["doc_id"].dataType, IntegralType):  # hex digits in the order of signed numbers
        number = F.lpad(F.hex(number.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    place = F.when(F.col("doc_id").isNull(), "1").otherwise(F.concat(F.lit("0"), number.cast("string")))
    return keyed.withColumn(name, F.concat_ws(":", place, F.col(key))), name


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labelled documents among these."""
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    name = _fresh(docs, "score")
    scored = quality.score(docs, quality.train(docs, labels), name)
    return scored.where(F.col(name) >= LEAST_QUALITY).drop(name)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents linked by similar word 5-grams the one with the smallest doc_id.

    Of rows with equal doc_id and text one stays. Rows are judged one by one, also where they share a doc_id or have none:
    null ids come after all others, and among equal ids a hash of the text decides.
    """
    once, key = _once(docs)
    rows, place = _in_order(once, key)
    ordered, own = _in_order(*_with_key(docs))
    groups = similar_groups(ordered.select(F.col(own).alias("doc_id"), "text"))
    return _without(rows, place, groups.where("doc_id <> component_id")).drop(key, place)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item; rows are judged one by one, also where they share a doc_id."""
    keyed, key = _with_key(docs)
    rows = keyed.select(F.col(key).alias("doc_id"), "text")
    found = contamination(rows, table(spark, sf_dir, "benchmark")).where("contaminated")
    return _without(keyed, key, found).drop(key)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts as the mix takes them: whole, twice, with extra blocks, or only the chosen blocks; n_chars follows.

    Rows with equal doc_id and text count once. Documents of which the mix takes nothing go.
    """
    once, key = _once(docs)
    plan, planned = _fresh(docs, "plan"), _fresh(docs, "planned")
    taken = mix(once.select(F.col(key).alias("doc_id"), "text", "source")).where("taken > 0")
    plans = taken.select(
        F.col("doc_id").alias(planned), F.struct("size", "place", "quota", "blocks", "offset").alias(plan)
    )
    mixed = once.join(plans, F.col(key) == F.col(planned)).withColumn("text", take_words(F.col("text"), F.col(plan)))
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(*(f"`{name}`" for name in docs.columns))


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of all texts, and what they hold by document."""
    folder = new_folder(spark, "pipeline-tokens")
    return read_token_files(spark, write_token_files(docs, folder, public_tokenizers.path(TOKENIZER)))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources to target weights", mix_sources),
    ("token-ID / binary output", write_tokens),
]

#: SQL has neither the classifier nor the tokenizer; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder, and the next one reads it from there."""
    docs = table(spark, sf_dir, "documents")
    folder = new_folder(spark, "pipeline")
    for number, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
