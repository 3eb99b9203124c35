"""Mixes sources to target weights: Sainte-Laguë quotas of equal blocks, then seeded block selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.common import SPACED_WORD, let, numbered, scratch

#: Words in a block. Small, so that quotas are fine even for a source of few words; blocks are never rows.
BLOCK_WORDS = 16
#: Words in a shard of a source, about: what one window has in memory, and how a large source is split.
SHARD_WORDS = 1 << 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(SPACED_WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, share: float, weights: Sequence[float], most: float) -> DataFrame:
    """Adds target words to sources (source, source_size).

    In the order of their names (null last) sources weigh `weights`, repeating; they share `share` of all words. A
    target stops at `most` times its source's words, and the excess is shared by weight again until none is above.
    """
    placed = numbered(sources, [F.col("source").asc_nulls_last()], "sources")
    turn = F.array(*map(F.lit, map(float, weights)))
    weighed = scratch(
        placed.withColumn("weight", F.element_at(turn, ((F.col("place") - 1) % len(weights) + 1).cast("int"))).withColumn(
            "limit", most * F.col("source_size")
        ),
        "weights",
    )
    all_words, weight = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    goal = share * (all_words or 0)
    level, full = goal / (weight or 1.0), -1
    while True:
        at_limit = F.col("limit") <= level * F.col("weight")
        now, used, free = weighed.agg(
            F.count_if(at_limit),
            F.coalesce(F.sum(F.when(at_limit, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~at_limit, F.col("weight"))), F.lit(0.0)),
        ).first()
        if now == full or not free:
            break
        level, full = (goal - used) / free, now
    return weighed.withColumn("target", F.least(F.col("limit"), level * F.col("weight")))


def apportion(parties: DataFrame, purpose: str) -> DataFrame:
    """Sainte-Laguë: parties (grp, party, votes, seats of the whole group) get whole `quota`s.

    Seats go to the highest quotients votes / (2k + 1). Two divisors between which the group's own must lie give each
    party a number of seats it surely has and one it cannot pass, together at most four quotients apart for each party
    on average; only those in between are ranked, equal ones by party. A group without votes gets no seats.
    """
    sums = parties.groupBy("grp").agg(
        F.sum("votes").alias("all_votes"), F.count("*").alias("n"), F.first("seats").alias("all_seats")
    )
    known = parties.select("grp", "party", "votes").join(sums, "grp")
    half = F.col("n") / 2
    sure = F.when(
        F.col("all_seats") > half,
        F.greatest(F.round(F.col("votes") * (F.col("all_seats") - half) / F.col("all_votes")) - 1, F.lit(0.0)),
    ).otherwise(0.0)
    most = F.round(F.col("votes") * (F.col("all_seats") + half) / F.col("all_votes")) + 1
    bounds = scratch(
        known.where(F.col("all_votes") > 0).select(
            "grp", "party", "votes", "all_seats", sure.cast("long").alias("sure"), most.cast("long").alias("most")
        ),
        f"{purpose}-bounds",
    )
    open_rows = bounds.where(F.col("votes") > 0).select(
        "grp", "party", F.explode(F.sequence("sure", F.col("most"))).alias("k"), "votes"
    )
    quotients = open_rows.select("grp", "party", (F.col("votes") / (2 * F.col("k") + 1)).alias("quotient"))
    ranked = numbered(
        quotients, [F.col("grp"), F.col("quotient").desc(), F.col("party")], f"{purpose}-quotients"
    ).alias("r")
    starts = ranked.groupBy("grp").agg(F.min("place").alias("start"))
    left = bounds.groupBy("grp").agg((F.first("all_seats") - F.sum("sure")).alias("left"))
    won = (
        ranked.join(starts, "grp")
        .join(left, "grp")
        .where(F.col("place") - F.col("start") < F.col("left"))
        .groupBy("grp", "party")
        .agg(F.count("*").alias("won"))
    )
    return (
        parties.select("grp", "party")
        .join(bounds.select("grp", "party", "sure"), ["grp", "party"], "left")
        .join(won, ["grp", "party"], "left")
        .select("grp", "party", (F.coalesce("sure", F.lit(0)) + F.coalesce("won", F.lit(0))).alias("quota"))
    )


def _chosen_before(words: Column) -> Column:
    """Words taken among the first so many of a shard, each pass over all blocks and one over the evenly chosen."""
    n, rest = F.col("blocks"), F.col("quota") % F.col("blocks")
    whole = F.floor(words / BLOCK_WORDS)
    before = F.floor((whole * rest + F.col("offset")) / n)
    here = F.floor(((whole + 1) * rest + F.col("offset")) / n) - before
    return F.floor(F.col("quota") / n) * words + before * BLOCK_WORDS + here * (words - whole * BLOCK_WORDS)


def mix(
    docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), most: float = 2.0, seed: int = 7
) -> DataFrame:
    """How many words of each document (doc_id, text, source) a mix takes, and which.

    A word is a run without ASCII white space; null text has none, and its document is taken 0 times. Sources get
    `targets`. Each source is split by a seeded hash into shards, whose documents follow each other in seeded order and
    are cut into blocks of `BLOCK_WORDS` words. The target's blocks are apportioned to sources and then to their
    shards by Sainte-Laguë; a shard takes all its blocks as often as its quota allows, and for the rest a seeded choice of
    evenly spread blocks, so no word is taken more than `most` times (rounded up).

    Returns doc_id, source, size, source_size, target, taken, and as `place` where the document begins in its shard, with
    the shard's quota, blocks and offset (what `take_words` needs). Null sources are one source, null doc_ids are
    documents like others, repeated rows are documents of their own. Other columns are left out. An empty table, or one
    without words, gives rows that take nothing.

    Only names and numbers are shuffled, never text; windows hold one shard each.
    """
    if most != int(most):
        raise ValueError("most must be a whole number of passes")
    sized = scratch(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share, weights, most)
    sources = scratch(sources, "targets")

    goal = sources.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    source_quota = apportion(
        sources.select(
            F.lit(0).alias("grp"),
            F.col("place").alias("party"),
            F.col("target").alias("votes"),
            F.lit(round(goal / BLOCK_WORDS)).cast("long").alias("seats"),
        ),
        "source",
    ).select(F.col("party").alias("place"), F.col("quota").alias("seats"))
    sources = sources.join(source_quota, "place").withColumnRenamed("place", "source_no")

    s, d = sources.alias("s"), sized.alias("d")
    shard = F.pmod(F.xxhash64(F.lit(seed), "d.doc_id"), F.ceil(F.greatest(F.col("s.source_size"), F.lit(1)) / SHARD_WORDS))
    placed = scratch(
        d.join(s, F.col("d.source").eqNullSafe(F.col("s.source"))).select(
            "d.doc_id", "d.source", "d.size", "s.source_no", "s.source_size", "s.target", "s.seats", shard.alias("shard")
        ),
        "shards",
    )
    shards = scratch(
        placed.groupBy("source_no", "shard").agg(F.sum("size").alias("words"), F.first("seats").alias("seats")), "quotas"
    )
    quotas = apportion(
        shards.select(
            F.col("source_no").alias("grp"), F.col("shard").alias("party"), F.col("words").cast("double").alias("votes"), "seats"
        ),
        "shard",
    )
    blocks = F.greatest(F.ceil(F.col("words") / BLOCK_WORDS), F.lit(1))
    filled = (
        shards.join(
            quotas.select(F.col("grp").alias("source_no"), F.col("party").alias("shard"), "quota"), ["source_no", "shard"]
        )
        .withColumn("blocks", blocks)
        .select(
            "source_no",
            "shard",
            "blocks",
            F.least(F.col("quota"), F.lit(int(most)) * F.col("blocks")).alias("quota"),
            F.pmod(F.xxhash64(F.lit(seed), "source_no", "shard"), F.col("blocks")).alias("offset"),
        )
    )
    order = Window.partitionBy("source_no", "shard").orderBy(
        F.xxhash64(F.lit(seed), F.lit("order"), "doc_id"), "doc_id", "size"
    )
    run = placed.withColumn("place", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)))
    run = run.withColumn("place", F.coalesce("place", F.lit(0))).join(filled, ["source_no", "shard"])
    taken = _chosen_before(F.col("place") + F.col("size")) - _chosen_before(F.col("place"))
    return run.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        F.col("target").cast("double").alias("target"),
        taken.cast("long").alias("taken"),
        "place",
        "quota",
        "blocks",
        "offset",
    )


def take_words(text: Column, plan: Column) -> Column:
    """The text as a mix takes it (`plan`: a struct of size, place, quota, blocks and offset from `mix`).

    Full passes give the text as it is; the words of chosen blocks follow, joined by single spaces. Newlines divide passes.
    """
    rest = plan["quota"] % plan["blocks"]

    def upto(block: Column) -> Column:
        return F.floor((block * rest + plan["offset"]) / plan["blocks"])

    def pieces(words: Column) -> Column:
        first = F.floor(plan["place"] / BLOCK_WORDS)
        last = F.floor((plan["place"] + plan["size"] - 1) / BLOCK_WORDS)
        chosen = F.filter(F.sequence(first, last), lambda j: upto(j + 1) > upto(j))

        def piece(j: Column) -> Column:
            start = F.greatest(j * BLOCK_WORDS - plan["place"], F.lit(0))
            end = F.least((j + 1) * BLOCK_WORDS - plan["place"], plan["size"])
            return F.array_join(F.slice(words, (start + 1).cast("int"), (end - start).cast("int")), " ")

        return F.nullif(F.array_join(F.transform(chosen, piece), " "), F.lit(""))

    whole = F.array_repeat(text, F.floor(plan["quota"] / plan["blocks"]).cast("int"))
    extra = F.when(rest > 0, let(F.regexp_extract_all(text, F.lit(SPACED_WORD), F.lit(0)), pieces))
    return F.when(plan["size"] > 0, F.array_join(F.concat(whole, F.array(extra)), "\n")).otherwise("")
