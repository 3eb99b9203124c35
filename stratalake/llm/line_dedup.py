"""Drops lines that many documents share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.common import WHITE, ascii_lower, let

#: Parts that the occurrences of one line are dealt into when they meet the shared lines.
SALTS = 16


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def _hashed(key: Column) -> list[Column]:
    """128 bits, so that different lines do not meet even among 10^12 of them."""
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2")]


def _row_key() -> list[Column]:
    text = F.coalesce("text", F.lit(""))
    return [F.col("doc_id").alias("k1"), F.xxhash64(text).alias("k2"), F.xxhash64(F.lit("text"), text).alias("k3")]


def drop_shared_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """Documents (doc_id, text) without the lines found in at least `min_docs` of them.

    Lines end at newlines. A line's key is the line without outer ASCII white space, A to Z in lower case; keys of fewer
    than `min_chars` code points are never dropped. Returns doc_id, n_lines (before), n_dropped and the kept text; other
    columns of the input are left out, whatever their names.

    Null and empty text is one empty line. Every row counts as a document of its own, also where a doc_id or a whole
    row repeats or the doc_id is null; a key that a text repeats counts once for it. A text that loses all lines becomes
    empty. An empty table gives no rows.

    A shared line reaches the count once for each map task. The line hashes are then matched with the shared ones alone,
    a line's occurrences in `SALTS` parts, and only positions go back to the texts, which are shuffled once.
    """
    docs = docs.select("doc_id", "text")
    keys = F.transform(F.split(F.coalesce("text", F.lit("")), "\n", -1), line_key)

    once = docs.select(F.explode(F.array_distinct(keys)).alias("key")).where(F.length("key") >= min_chars)
    shared = (
        once.select(*_hashed(F.col("key")))
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_docs)
        .select("h1", "h2")
    )

    placed = docs.select(*_row_key(), F.posexplode(keys).alias("at", "key")).where(F.length("key") >= min_chars)
    salt = F.pmod("k2", F.lit(SALTS)).cast("int").alias("salt")
    salted = shared.select("h1", "h2", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    dropped = (
        placed.select("k1", "k2", "k3", "at", salt, *_hashed(F.col("key")))
        .join(salted, ["h1", "h2", "salt"], "left_semi")
        .groupBy("k1", "k2", "k3")
        .agg(F.collect_set("at").alias("gone"))
    )

    texts = docs.select(*_row_key(), "doc_id", "text").alias("a")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ("k1", "k2", "k3")]
    joined = texts.join(dropped.alias("b"), same, "left")

    def kept(lines: Column) -> Column:
        stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
        some = F.when(F.col("gone").isNull(), lines).otherwise(F.transform(stay, lambda at: F.get(lines, at)))
        return F.struct(F.size(lines).cast("long").alias("n_lines"), F.array_join(some, "\n").alias("text"))

    return joined.select(
        "doc_id",
        let(F.split(F.coalesce("text", F.lit("")), "\n", -1), kept).alias("kept"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_dropped"),
    ).select("doc_id", "kept.n_lines", "n_dropped", "kept.text")
