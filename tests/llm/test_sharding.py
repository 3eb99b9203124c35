"""Shards of near equal bytes, against the splitters that all rows in order give."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from stratalake.llm import sharding
from stratalake.llm.common import scratch
from stratalake.llm.sharding import keyed, shard_by_bytes, splitters, write_shards


def edges(sizes, keys, shards, tolerance):
    """Bytes below each splitter: by the rule of the rounds, from all rows in order of their keys."""
    order = sorted(range(len(keys)), key=lambda i: keys[i])
    total, out = sum(sizes), []
    for k in range(1, shards):
        below = 0
        for at in order:
            if below * shards <= total * k < (below + sizes[at]) * shards:
                break
            below += sizes[at]
        for digits in [*range(3, 80, 2), 80]:
            same = [i for i in order if keys[i][:digits] == keys[at][:digits]]
            down = sum(sizes[i] for i in order if keys[i][:digits] < keys[at][:digits])
            up = down + sum(sizes[i] for i in same)
            off = (total * k - down * shards, up * shards - total * k)
            if min(off) <= tolerance * total or digits == 80:
                out.append(down if off[0] <= off[1] else up)
                break
    return out


def random_rows(seed, copies):
    pick = random.Random(seed)
    rows = [(k, "".join(pick.choices("abc é\n", k=pick.choice([0, 5, 40, 300])))) for k in range(250)]
    rows += [(1000 + k, "copy of one text, many times over") for k in range(copies)]
    return rows + [(None, None), (None, ""), (7, "x"), (7, "x"), (3, "long " * 4000)]


@pytest.mark.parametrize(("seed", "copies", "shards", "tolerance"), [(1, 0, 4, 0.005), (2, 400, 7, 0.05), (3, 30, 40, 0.005), (4, 5, 1, 0.1)])
def test_as_all_rows_in_order(spark, seed, copies, shards, tolerance):
    docs = spark.createDataFrame(random_rows(seed, copies), "doc_id long, text string").repartition(6)
    rows = scratch(keyed(docs.withColumn("size", F.lit("theirs"))), "keyed")
    cuts = splitters(rows.select("key", "size"), shards, tolerance)
    assert cuts.keys == sorted(cuts.keys) and len(cuts.keys) == shards - 1
    own = rows.collect()
    below = [sum(r["size"] for r in own if r["key"] < cut) for cut in cuts.keys]
    assert below == edges([r["size"] for r in own], [r["key"] for r in own], shards, tolerance)


def test_rows_slots_and_texts(spark):
    given = random_rows(5, 300)
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumns({"shard": F.lit("x"), "extra": F.col("doc_id") + 1})
    got = shard_by_bytes(docs.repartition(5), 6, 0.02).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(given, key=str)
    slots, texts = defaultdict(list), defaultdict(set)
    for r in got:
        raw = (r["text"] or "").encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
        assert r["extra"] == (None if r["doc_id"] is None else r["doc_id"] + 1)
        slots[r["shard"]].append(r["slot"])
        texts[r["text"] or ""].add(r["shard"])
    assert set(slots) <= set(range(6)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sum(len(s) > 1 for s in texts.values()) <= 5  # only where a splitter parts a group


def test_equal_rows_are_parted_evenly(spark):
    docs = spark.createDataFrame([(5, "the same row")] * 4000 + [(k, f"row {k}") for k in range(40)], "doc_id long, text string")
    cuts = splitters(scratch(keyed(docs.repartition(8)), "keyed"), 8, 0.01)
    assert cuts.hot == [hashlib.md5(b"the same row").hexdigest() + hashlib.md5(b"5:" + hashlib.md5(b"the same row").hexdigest().encode()).hexdigest()]
    got = shard_by_bytes(docs.repartition(8), 8, 0.01)
    counts = [r["bytes"] for r in got.groupBy("shard").agg(F.sum("size").alias("bytes")).collect()]
    assert len(counts) == 8 and max(counts) <= 1.02 * sum(counts) / 8 + 28
    sizes = [r["count"] for r in got.withColumn("piece", F.col("slot") % 1).groupBy("shard").count().collect()]
    assert sum(sizes) == 4040


def test_rounds_do_not_follow_the_length_of_keys(spark):
    docs = spark.createDataFrame([(k, "copies of one text") for k in range(3000)], "doc_id long, text string")
    assert splitters(scratch(keyed(docs), "keyed"), 40, 0.005).rounds <= 4


def test_shares_of_pieces():
    assert sharding._pieces([(100, 10), (0, 0), (100, 990)], 10) == [5, 1, 10]
    assert sharding._pieces([(0, 0)], 10) == [1]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert shard_by_bytes(docs, 5).columns == ["doc_id", "text", "size", "text_crc32", "shard", "slot"]
    assert shard_by_bytes(docs, 5).count() == 0


def test_written_shards_hold_whole_rows(spark, tmp_path):
    given = random_rows(6, 20)
    docs = spark.createDataFrame(given, "doc_id long, text string")
    back = write_shards(docs, str(tmp_path / "shards"), 4)
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=str) == sorted(given, key=str)
    assert {p.name for p in (tmp_path / "shards").iterdir() if p.is_dir()} == {f"shard={k}" for k in range(4)}
