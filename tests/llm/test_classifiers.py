"""Language and quality: held-out accuracy, and what is defined for odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.llm import language, quality
from stratalake.llm.labelled import bounded, held_out

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_rows(spark):
    got = spark.range(500).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in got)


def test_bounded_sample(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    assert bounded(ids, 30_000).count() == 20_000
    assert 1500 < bounded(ids, 2000).count() < 2500


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return language.train(docs.where(~held_out(F.col("doc_id"))), max_docs=300)


def test_language_of_held_out_texts(spark, model):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where(held_out(F.col("doc_id")))
    got = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    right, n, low, high = got.agg(
        F.count_if(F.col("lang") == F.col("lang_pred")), F.count("*"), F.min("score"), F.max("score")
    ).first()
    assert right / n > 0.97 and 0 <= low and high <= 1


def test_language_of_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "123 !? 4"), (None, "the and of"), (5, "漢字"), (6, "THE AND " * 20000), (6, "the")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("x")).withColumn("lang", F.lit("zz"))
    got = {(r["doc_id"], r["lang_pred"]) for r in language.identify(docs, model).collect()}
    assert got == {(1, "und"), (2, "und"), (3, "und"), (None, "en"), (5, "en"), (6, "en")}
    nothing = language.train(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_words_come_before_shorter_and_shorter_grams():
    logs = np.log(np.array([[0.9, 0.1], [0.2, 0.8], [0.6, 0.4]], np.float32))
    m = language.LanguageModel(["a", "b"], np.zeros(2), {"known": 0}, logs, {" ab": 1, "q": 2}, logs, 3)
    scorer = language.Scorer(m)
    assert (scorer.word("known") == logs[0]).all()
    assert (scorer.word("abc") == logs[1]).all() and (scorer.word("zq") == logs[2]).all()
    assert (scorer.word("zz") == 0).all() and scorer.spaced("abc-known")[0] == 2


def test_quality_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.train(docs, labels.where(~held_out(F.col("doc_id"))))
    scored = quality.score(docs, model).join(labels.where(held_out(F.col("doc_id"))), "doc_id").collect()
    right = [(r["score"] >= 0.7) == (r["quality"] == 1) for r in scored]
    assert np.mean(right) > 0.97 and all(0 <= r["score"] <= 1 for r in scored)


def test_discriminant_is_that_of_two_normal_densities():
    pick = np.random.default_rng(4)
    x = np.concatenate([pick.multivariate_normal([0, 0], [[2, 0.5], [0.5, 1]], 4000), pick.multivariate_normal([2, 1], [[0.5, 0], [0, 0.3]], 6000)])
    y = np.repeat([0, 1], [4000, 6000])
    got = quality.fit(x, y, shrinkage=0.0).scores(x[::50])

    def log_density(v, k):
        d, cov = v - x[y == k].mean(axis=0), np.cov(x[y == k], rowvar=False)
        return np.log((y == k).mean()) - 0.5 * (np.log(np.linalg.det(cov)) + np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d))

    want = 1 / (1 + np.exp(log_density(x[::50], 0) - log_density(x[::50], 1)))
    assert np.allclose(got, want, atol=1e-6)


def test_quality_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, " \n"), (4, "x" * 100_000), (4, "é " * 1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", F.lit("x")).withColumn("quality", F.lit(7))
    labels = spark.createDataFrame([(1, 1), (2, 0), (4, None), (None, 1), (4, 5)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        scored = quality.score(docs, quality.train(docs, some)).collect()
        assert len(scored) == 5 and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.score(docs.limit(0), quality.train(docs, labels)).count() == 0
    with pytest.raises(ValueError, match="score"):
        quality.score(docs.withColumn("score", F.lit(1)), quality.train(docs, labels))


def test_features_are_finite_for_any_text():
    rows = pa.array(["", " ", "a", "é😀\n\n", "THE!! END!!", "\x00", "1 2 3 | 4"])
    values = quality.features(rows)
    assert values.shape == (7, len(quality.FEATURES)) and np.isfinite(values).all()
    sliced = quality.features(pa.concat_arrays([pa.array(["pad pad"]), rows]).slice(1))
    assert np.allclose(values, sliced)


@pytest.mark.parametrize("texts", [[None], ["", None], [" \n\t"], [" " * (5 << 20)], [None, "the and of", " "]])
def test_language_of_batches_without_words(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(docs, model).collect()}
    assert all((got[k] == ("und", 0.0)) == (not (t or "").strip()) for k, t in enumerate(texts))
