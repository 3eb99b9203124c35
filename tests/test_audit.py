"""Counts, reports and previews."""

from __future__ import annotations

import threading

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stratalake import preview, row_count, schema_report
from stratalake.operators.audit import observed_counts, step_counts, table_report
from tests.conftest import rows


@pytest.fixture
def dirty(spark):
    return spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("b", None), ("c", 2)], "s string, n int")


def test_row_count(dirty):
    assert rows(row_count(dirty)) == [(5,)]
    assert row_count(dirty, "x").columns == ["x"]


def test_step_counts(spark, dirty):
    assert rows(step_counts(dirty)) == [(5, 3, 2)]
    assert rows(step_counts(dirty.limit(0))) == [(0, 0, 0)]


def test_step_counts_of_a_table_with_the_helper_columns_name(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "__COPIES string")
    assert rows(step_counts(df)) == [(3, 2, 1)]


def test_schema_report_and_table_report(dirty):
    assert rows(schema_report(dirty)) == [(1, "s", "string"), (2, "n", "int")]
    assert rows(table_report(dirty)) == [(1, "s", "string", 5), (2, "n", "int", 5)]


def test_preview(spark):
    assert preview(spark.range(100)).count() == 20
    assert preview(spark.range(100), 1).count() == 1
    assert preview(spark.range(3)).count() == 3


def test_observed_counts_come_with_the_action(spark, dirty, tmp_path):
    counts = Observation()
    dirty.observe(counts, F.count(F.lit(1)).alias("n_rows")).write.parquet(str(tmp_path / "t"))

    def recount():
        raise AssertionError("the counts were there")

    assert observed_counts(counts, recount) == {"n_rows": 5}


def test_counts_that_never_come_are_taken_again(dirty):
    class Lost:
        @property
        def get(self):
            threading.Event().wait()

    assert observed_counts(Lost(), lambda: row_count(dirty), patience=0.1) == {"n_rows": 5}
