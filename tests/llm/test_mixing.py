"""Targets, Sainte-Laguë quotas and what documents give to a mix."""

from __future__ import annotations

import heapq
import re

import pytest
from pyspark.sql import functions as F

from stratalake.llm import mixing
from stratalake.llm.mixing import BLOCK_WORDS, apportion, mix, take_words, targets

SCHEMA = "doc_id long, text string, source string"


def water_level(sizes, share, weights, most):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    goal, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = goal - sum(fixed.values())
        got = {s: left * weight[s] / sum(weight[f] for f in free) for s in free}
        over = {s: most * sizes[s] for s in free if got[s] > most * sizes[s]}
        if not over:
            return fixed | got
        fixed |= over


def seats_one_by_one(votes, seats):
    won = dict.fromkeys(votes, 0)
    queue = [(-v, party) for party, v in votes.items()]
    heapq.heapify(queue)
    for _ in range(seats):
        _, party = heapq.heappop(queue)
        won[party] += 1
        heapq.heappush(queue, (-votes[party] / (2 * won[party] + 1), party))
    return won


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 5, "é": 70, None: 300}, {"a": 1}, {"a": 0, "b": 0}, {None: 4, "": 90}])
def test_targets(spark, sizes):
    rows = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in targets(rows, 1.5, (5, 2, 1), 2.0).collect()}
    want = water_level(sizes, 1.5, (5, 2, 1), 2.0)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_quotas_are_those_of_seat_by_seat_awards(spark):
    groups = {
        1: ({1: 53.0, 2: 24.0, 3: 23.0}, 7),
        2: ({k: 1.0 / (k + 1) for k in range(40)}, 97),
        3: ({1: 0.0, 2: 5.0}, 3),
        4: ({1: 1.0, 2: 1.0, 3: 1.0}, 2),
        5: ({1: 1e6, 2: 1.0, 3: 1.0}, 1000),
        6: ({1: 0.0}, 5),
        7: ({k: 10.0 for k in range(9)}, 0),
    }
    rows = [(g, p, v, seats) for g, (votes, seats) in groups.items() for p, v in votes.items()]
    parties = spark.createDataFrame(rows, "grp int, party long, votes double, seats long")
    got = {(r["grp"], r["party"]): r["quota"] for r in apportion(parties, "test").collect()}
    for g, (votes, seats) in groups.items():
        want = seats_one_by_one(votes, seats) if any(votes.values()) else dict.fromkeys(votes, 0)
        assert {p: got[g, p] for p in votes} == want, g


def test_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_WORDS", 2000)
    rows = [(i, "w " * (i * 37 % 211), f"s{i % 7}" if i % 9 else None) for i in range(400)]
    rows += [(1000, "long " * 9000, "s1"), (1001, None, "s2"), (1002, "", "s3"), (None, "a b c", "s4"), (7, rows[7][1], rows[7][2])]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("target", F.lit("clash")).withColumn("place", F.lit(0))
    got = mix(docs).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["size"]) for r in got) == sorted(
        (d is None, d or 0, len(re.findall(r"[^ \t\n\x0b\x0c\r]+", t or ""))) for d, t, _ in rows
    )
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in got)
    sums = {}
    for r in got:
        sums.setdefault(r["source"], [0, r["target"], 0])[0] += r["taken"]
        sums[r["source"]][2] += r["size"]
    want = water_level({s: v[2] for s, v in sums.items()}, 1.5, (5, 2, 1), 2.0)
    assert all(abs(v[1] - want[s]) < 1e-6 and abs(v[0] - v[1]) <= 40 * BLOCK_WORDS for s, v in sums.items())
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mix(docs).collect()), key=str)


def test_taken_words_are_as_many_as_planned(spark):
    rows = [(i, " ".join(f"w{k}" for k in range(i * 17 % 150)), f"s{i % 4}") for i in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    plans = mix(docs).alias("p")
    texts = docs.select("doc_id", "text").join(plans, "doc_id")
    plan = F.struct("size", "place", "quota", "blocks", "offset")
    for row in texts.select("taken", "text", take_words(F.col("text"), plan).alias("out")).collect():
        assert len(row["out"].split()) == row["taken"]
        assert set(row["out"].split()) <= set(row["text"].split())


def test_empty_and_wordless(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    got = mix(spark.createDataFrame([(1, None, None), (2, " ", "a")], SCHEMA)).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in got] == [(0, 0, 0.0), (0, 0, 0.0)]
