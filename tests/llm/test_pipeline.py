"""The corpus pipeline on small tables, stage by stage, against plain Python."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontamination import brute as contaminated
from tests.llm.test_jaccard_join import brute as groups

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """150 documents of prose and 50 of symbols, with copies, near copies, benchmark passages, nulls and odd columns."""
    pick, folder = random.Random(9), tmp_path_factory.mktemp("tables")
    vocabulary = ["".join(pick.choice("etaoinshrdlu") for _ in range(pick.randint(2, 9))) for _ in range(800)]

    def prose(n):
        return " ".join(pick.choice(vocabulary) for _ in range(n)) + "."

    passage = prose(14)
    texts = [prose(pick.randint(20, 200)) for _ in range(120)]
    texts += [texts[k] for k in range(0, 20, 2)] + [texts[k] + " end" for k in range(20, 40, 2)]
    texts += [f"{prose(30)} {passage} {prose(30)}" for _ in range(10)]
    bad = ["### $$$ %%% " * pick.randint(5, 50) for _ in range(50)]
    rows = [(i, t, None if i % 5 else "en", None if i % 11 == 0 else f"s{i % 3}", len(t)) for i, t in enumerate([*texts, *bad])]
    rows += [(None, prose(60), None, "s1", None), (900, None, None, None, None), (901, "", "fr", "s2", 0)]
    docs = spark.createDataFrame([*rows, rows[3]], SCHEMA).withColumn("score", F.lit("clash")).withColumn("plan", F.lit(1))
    docs.repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, passage), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i < len(texts)), 0) for i in range(len(texts) + len(bad))]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), set(range(len(texts)))


def test_every_stage_on_what_the_one_before_kept(spark, tables, tmp_path):
    folder, good = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, kept = docs.columns, [docs.collect()]
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        kept.append(docs.collect())
        assert number == 4 or docs.columns == columns
    _, first, second, third, fourth, last = kept

    ids = {r["doc_id"] for r in first}
    assert good - ids == set() and len(ids & set(range(len(good), len(good) + 50))) == 0
    once = {(r["doc_id"], r["text"]) for r in first}
    members = groups(sorted(once, key=str))
    assert {r["doc_id"] for r in second} == {d for d, _, component in members if d == component}
    assert len(second) == len({(r["doc_id"], r["text"]) for r in second})
    found = {d for d, *_, hit in contaminated([(r["doc_id"], r["text"]) for r in second], [(1, spark.read.parquet(f"{folder}/benchmark.parquet").where("item_id = 1").first()["text"])], 10) if hit}
    assert found and {r["doc_id"] for r in third} == {r["doc_id"] for r in second} - found

    sizes, taken = {r["doc_id"]: len((r["text"] or "").split()) for r in third}, {r["doc_id"]: len(r["text"].split()) for r in fourth}
    assert all(taken[d] <= 2 * sizes[d] for d in taken) and len(fourth) == len(taken)
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) < 0.02 * sum(sizes.values())
    assert all(r["n_chars"] == len(r["text"]) for r in fourth)

    tokenizer, at, want = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER)), 0, []
    for r in sorted(fourth, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        tokens = tokenizer.encode(r["text"], add_special_tokens=False).ids + [1]
        want.append((r["doc_id"], at, len(tokens), zlib.crc32(np.array(tokens, "<u4").tobytes())))
        at += len(tokens)
    assert sorted(map(tuple, last), key=lambda r: r[1]) == want


def test_run_is_its_stages(spark, tables):
    result = corpus_pipeline.run(spark, tables[0])
    assert result.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and result.count() > 100


def test_rows_are_judged_one_by_one(spark, tmp_path):
    """Rows without an id, and rows that share one, are removed for their own text only."""
    pick = random.Random(3)

    def prose(n):
        return " ".join("".join(pick.choice("etaoinshrdlu") for _ in range(6)) for _ in range(n))

    texts = [prose(60) for _ in range(8)]
    rows = [
        (None, texts[0]), (None, texts[0] + " end"), (None, texts[0] + " other end"),  # near copies without any id
        (None, texts[1]), (None, texts[2]), (None, None),  # not linked
        (-3, texts[3]), (2, texts[3] + " end"), (10, texts[3] + " more"), (None, texts[3] + " last"),  # the smallest is negative
        (4, texts[4]), (4, texts[4] + " end"), (4, texts[5]), (4, texts[5]),  # one id, near and unlike texts, a repeated row
        (9, texts[6]), (70, texts[6] + " end"), (70, texts[7]),  # only one of the rows of 70 is linked
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit(1)).repartition(4)
    got = corpus_pipeline.keep_one_of_each_group(spark, docs, "")
    assert got.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert len([r for r in kept if r in rows[:3]]) == 1 and len([r for r in kept if r in rows[10:12]]) == 1
    rest = [r for r in kept if r not in rows[:3] and r not in rows[10:12]]
    assert sorted(rest, key=str) == sorted([*rows[3:7], rows[12], rows[14], rows[16]], key=str)

    passage = prose(14)
    dirty = f"{texts[0]} {passage} {texts[1]}"
    rows = [(None, dirty), (None, texts[1]), (None, None), (5, dirty), (5, texts[2]), (5, texts[2]), (6, dirty + " x"), (7, texts[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row_key", F.lit(1)).repartition(4)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.drop_contaminated(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    assert sorted(kept, key=str) == sorted([r for r in rows if passage not in (r[1] or "")], key=str)
