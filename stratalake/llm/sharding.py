"""Shards of near equal bytes by histogram sort: exact bytes below key boundaries, refined until splitters fit, one exchange."""

from __future__ import annotations

import os
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from stratalake.llm.common import scratch

#: Hex digits of a row's key that the first round and each later round look at: 4,096 and 256 boundaries in an interval.
FIRST_DIGITS, MORE_DIGITS = 3, 2
#: A key is the digest of the text, of the id with the text, and a number that tells equal rows apart.
TEXT_DIGITS, KEY_DIGITS = 32, 80
#: Bytes counted for a row besides its text.
ROW_BYTES = 16
#: A shard is numbered in pieces of about so many bytes, and all shards together in at least so many pieces a shard.
PIECE_BYTES, LEAST_PIECES = 256 << 20, 32
#: Comes after all hex digits.
END = "g"


@dataclass(frozen=True)
class Splitters:
    """Shard k holds the keys from splitter k - 1 up to splitter k. `hot`: equal rows that a splitter had to part."""

    keys: list[str]
    hot: list[str]
    rounds: int

    def shard(self, key: Column) -> Column:
        return reduce(lambda n, s: n + (key >= F.lit(s)).cast("int"), self.keys, F.lit(0))


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with size, text_crc32 and their key, whose order is that of the shards: rows of one text are neighbours."""
    text, number = F.coalesce("text", F.lit("")), F.lower(F.hex(F.monotonically_increasing_id()))
    mark = F.when(F.col("text").isNull(), "null").otherwise(F.md5(text))
    own = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), mark))
    return docs.select(
        *(F.col(f"`{name}`") for name in docs.columns if name not in ("size", "text_crc32", "key", "shard", "slot", "piece")),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.concat(F.md5(text), own, F.lpad(number, 16, "0")).alias("key"),
    )


def _after(prefix: str) -> str:
    """The least prefix of this length after the given one."""
    number = int(prefix, 16) + 1
    return END if number == 16 ** len(prefix) else f"{number:0{len(prefix)}x}"


def _digits(prefix: str) -> int:
    """How many digits are looked at inside an interval of keys with this prefix."""
    steps = -(-(len(prefix) + 1 - FIRST_DIGITS) // MORE_DIGITS)
    return min(FIRST_DIGITS + MORE_DIGITS * max(0, steps), KEY_DIGITS)


def _histogram(rows: DataFrame, prefixes: Sequence[str]) -> dict[str, list[Row]]:
    """For each interval of keys the parts it has rows in, in order, with rows, bytes, least and greatest key."""
    of = F.coalesce(*(F.when(F.col("key").startswith(p), F.lit(p)) for p in prefixes))
    part = F.coalesce(*(F.when(F.col("key").startswith(p), F.substring("key", 1, _digits(p))) for p in prefixes))
    counts = rows.groupBy(of.alias("interval"), part.alias("part")).agg(
        F.count("*").alias("n"), F.sum("size").alias("bytes"), F.min("key").alias("low"), F.max("key").alias("high")
    )
    parts: dict[str, list[Row]] = {p: [] for p in prefixes}
    for row in sorted(counts.where("interval is not null").collect(), key=lambda r: r["part"]):
        parts[row["interval"]].append(row)
    return parts


def splitters(rows: DataFrame, shards: int, tolerance: float) -> Splitters:
    """Splitters of rows (key, size) into shards whose bytes differ from an equal share by little more than `tolerance` at each end.

    Each round counts, in one pass, the exact bytes between candidate boundaries: equal parts of every interval that still has to
    hold a splitter. A splitter is placed at the boundary nearest to its share of all bytes once that is within the
    tolerance (of an equal share), else its interval shrinks to the keys of the part that has its share. Where that part is one row,
    the nearest boundary is taken, so a row larger than the tolerance is the only other reason to be off. Any group of copies, however
    large, costs three or four rounds more. The driver gets at most 4,096 counts at first, then 256 an interval.
    """
    found: dict[int, str] = {}
    open_at: dict[int, tuple[str, int]] = dict.fromkeys(range(1, shards), ("", 0))
    hot, total, rounds = set(), None, 0
    while open_at:
        rounds += 1
        parts = _histogram(rows, sorted({prefix for prefix, _ in open_at.values()}))
        if total is None:
            total = sum(r["bytes"] for r in parts[""])
            if not total:
                return Splitters([END] * (shards - 1), [], rounds)
        still: dict[int, tuple[str, int]] = {}
        for k, (prefix, below) in open_at.items():
            share = total * k  # in bytes by the number of shards, so whole
            for part in parts[prefix]:
                above = below + part["bytes"]
                if above * shards > share:
                    break
                below = above
            down, up = share - below * shards, above * shards - share
            name = part["part"]
            if min(down, up) <= tolerance * total or part["n"] == 1 or len(name) == KEY_DIGITS:
                found[k] = name if down <= up else _after(name)
                continue
            inner = os.path.commonprefix([part["low"], part["high"]])
            if len(inner) >= 2 * TEXT_DIGITS:
                hot.add(inner[: 2 * TEXT_DIGITS])
            still[k] = (inner, below)
        open_at = still
    return Splitters([found[k] for k in range(1, shards)], sorted(hot), rounds)


def _pieces(counts: Sequence[tuple[int, int]], goal: int) -> list[int]:
    """How many pieces each shard (rows, bytes) is numbered in: `goal` in all, by rows or bytes, whichever asks for more."""
    rows, size = sum(n for n, _ in counts), sum(b for _, b in counts)
    return [max(1, -(-goal * n // max(rows, 1)), -(-goal * b // max(size, 1))) for n, b in counts]


def shard_by_bytes(docs: DataFrame, shards: int = 40, tolerance: float = 0.005) -> DataFrame:
    """Documents (doc_id, text) in shards of near equal bytes: the given columns, size, text_crc32, shard and slot.

    A row's size are the UTF-8 bytes of its text and 16; `slot` numbers a shard's rows from 0 without gaps. Equal texts are
    neighbours in the order of the shards, so they stay together unless a splitter within the tolerance can only be had
    between them; then they are parted by their ids. Rows equal in id and text are parted by their place in the input.

    Null text has no bytes and comes with the empty ones; null and repeated doc_ids are kept row by row; given columns named as the new ones (or
    `key`, `piece`) are replaced. A text larger than a shard's share fills its shard alone, and shards beside it may be empty.
    An empty table gives no rows.

    The keyed rows are written once, so that every round and the exchange see the same keys. Rounds read keys and sizes only. The
    exchange deals each shard in pieces of bounded rows and bytes, whose first slots come from counts by piece.
    """
    rows = scratch(keyed(docs), "shard-rows")
    cuts = splitters(rows.select("key", "size"), shards, tolerance)
    dealt = rows.withColumn("shard", cuts.shard(F.col("key")))
    counted = {r["shard"]: (r["n"], r["bytes"]) for r in dealt.groupBy("shard").agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).collect()}
    counts = [counted.get(k, (0, 0)) for k in range(shards)]
    goal = max(LEAST_PIECES * shards, -(-sum(b for _, b in counts) // PIECE_BYTES))
    of_shard = F.get(F.array(*map(F.lit, _pieces(counts, goal))), F.col("shard"))

    number = F.conv(F.substring("key", TEXT_DIGITS + 1, 8), 16, 10).cast("long")
    if cuts.hot:  # many equal rows: their ids tell nothing
        own = F.conv(F.substring(F.md5(F.col("key")), 1, 8), 16, 10).cast("long")
        number = F.when(F.substring("key", 1, 2 * TEXT_DIGITS).isin(cuts.hot), own).otherwise(number)
    dealt = dealt.withColumn("piece", F.pmod(number, of_shard.cast("long")))
    starts = dealt.groupBy("shard", "piece").agg(F.count("*").alias("n"))
    return _numbered(dealt, starts).drop("key", "piece")


def _numbered(dealt: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds each row's slot: the rows of its shard's earlier pieces, and those before it in its own by key."""
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("piece")) - F.col("n")
    starts = sizes.select(F.col("shard").alias("of"), F.col("piece").alias("at"), before.alias("before"))
    within = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("key")) - 1
    placed = dealt.withColumn("within", within)
    joined = placed.join(starts, (F.col("shard") == F.col("of")) & (F.col("piece") == F.col("at")))
    return joined.withColumn("slot", F.col("before") + F.col("within")).drop("of", "at", "before", "within")


def write_shards(docs: DataFrame, folder: str, shards: int = 40, tolerance: float = 0.005) -> DataFrame:
    """Writes whole rows as Parquet, a folder for each shard, and gives the table read back from there."""
    shard_by_bytes(docs, shards, tolerance).write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.parquet(folder)
