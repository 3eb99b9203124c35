"""Similar word n-grams: every link found, components whole, however texts share tokens."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import jaccard_join
from stratalake.llm.common import BATCH_BYTES, batches_of
from stratalake.llm.components import components
from stratalake.llm.jaccard_join import similar_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def grams(text, size=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return set()
    k = min(size, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}


def brute(rows, percent=75):
    sets = [grams(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(doc_id, least.get(find(i), doc_id))
    return sorted(((d, len(s), least.get(find(i), d)) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def family(pick, n, length, edits, base=None):
    base = base or [f"w{pick.randrange(10**6)}" for _ in range(length)]
    out = []
    for _ in range(n):
        words = list(base)
        for _ in range(pick.randint(0, edits)):
            words[pick.randrange(len(words))] = f"x{pick.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus():
    pick = random.Random(5)
    texts = family(pick, 60, 80, 2) + family(pick, 40, 200, 9) + family(pick, 20, 12, 1)
    # a passage that many otherwise different texts share, and a chain of small changes
    passage = [f"p{k}" for k in range(40)]
    texts += [" ".join(passage + [f"q{pick.randrange(10**6)}" for _ in range(pick.randint(5, 60))]) for _ in range(60)]
    chain = [f"c{k}" for k in range(100)]
    for step in range(12):
        chain = chain[4:] + [f"d{step}-{k}" for k in range(4)]
        texts.append(" ".join(chain))
    texts += ["A b c", "a  B\tc", "a b", None, None, "", " \n", "Same words HERE now ok", "same words here now ok", "é É x y z w"]
    texts += [texts[0]] * 5 + [" ".join(f"long{k}" for k in range(20000))] * 2
    pick.shuffle(texts)
    rows = list(enumerate(texts, 100))
    return [*rows, (None, texts[3]), rows[7], (50, texts[9])]


@pytest.mark.parametrize(("open_pairs", "small"), [(jaccard_join.OPEN_PAIRS, jaccard_join.SMALL_TOKEN), (0, 1), (10**9, 3)])
def test_as_brute_force(spark, monkeypatch, open_pairs, small):
    monkeypatch.setattr(jaccard_join, "OPEN_PAIRS", open_pairs)
    monkeypatch.setattr(jaccard_join, "SMALL_TOKEN", small)
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("x")).withColumn("n", F.lit(1))
    got = similar_groups(docs.repartition(6)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_ids_beyond_the_broadcast_bound_are_joined(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MAX_BROADCAST_IDS", 0)
    rows = corpus()[:120]
    got = similar_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_empty_table(spark):
    assert similar_groups(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    lone = spark.createDataFrame([(1, None), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, similar_groups(lone).collect())) == [(1, 0, 1), (2, 0, 2)]


def test_components(spark):
    links = [(i, i + 1) for i in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(300, 300), (200, 201), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == dict.fromkeys(range(1, 41), 1) | dict.fromkeys(range(100, 160), 100) | {200: 200, 201: 200}


def test_texts_reach_python_in_batches_of_bounded_bytes(spark, monkeypatch):
    bounds, write = [], jaccard_join.scratch

    def noted(df, purpose):
        bounds.append(int(spark.conf.get(BATCH_BYTES)))
        return write(df, purpose)

    monkeypatch.setattr(jaccard_join, "scratch", noted)
    own = spark.conf.get(BATCH_BYTES)
    texts = [(1, "a b c d e f g"), (2, "A b c d e f g"), (3, "h i j k l m n")]
    groups = similar_groups(spark.createDataFrame(texts, "doc_id long, text string"))
    assert bounds and set(bounds) == {jaccard_join.SLICE_BYTES}
    assert spark.conf.get(BATCH_BYTES) == own
    assert {tuple(r) for r in groups.collect()} == {(1, 3, 1), (2, 3, 1), (3, 3, 3)}


def test_batches_are_bounded_by_bytes_inside_and_as_before_afterwards(spark):
    wide = spark.range(60, numPartitions=1).select(F.repeat(F.lit("x"), 100_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes])], names=["n"])

    seen = wide.mapInArrow(sizes, "n long")
    own = spark.conf.get(BATCH_BYTES)
    with pytest.raises(ZeroDivisionError), batches_of(spark, 1 << 20):
        inside = [r["n"] for r in seen.collect()]
        raise ZeroDivisionError
    assert len(inside) > 1 and max(inside) < 2 << 20
    assert spark.conf.get(BATCH_BYTES) == own
    assert len(seen.collect()) == 1
    spark.conf.set(BATCH_BYTES, "64k")
    try:
        with batches_of(spark, 1 << 20):
            assert spark.conf.get(BATCH_BYTES) == "64k"
    finally:
        spark.conf.set(BATCH_BYTES, own)
