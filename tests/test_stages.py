"""The stages and the whole pipeline."""

from __future__ import annotations

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import (
    StageFailure,
    TableDirectory,
    bronze_to_silver,
    extract_to_landing,
    landing_to_bronze,
    read_landing,
    read_table,
    run_pipeline,
)
from stratalake.checks.database import load_database
from stratalake.checks.workspace import new_folder
from stratalake.operators.cleaning import dedupe_rows
from stratalake.plans.sizing import BYTES_PER_TASK, DROP_SHUFFLES, INITIAL_PARTITIONS, MOST_TASKS, reduce_tasks, session_sized_for
from stratalake.sinks.landing import rows_for, write_landing
from stratalake.sinks.layers import write_layer
from tests.conftest import STAMP, rows


@pytest.fixture
def source(spark, tmp_path):
    root = tmp_path / "source"
    people = spark.createDataFrame(
        [(1, "ana", 1.5), (1, "ana", 1.5), (2, None, 2.5), (3, "Bo", 1e7)], "CD int, NM string, amount double"
    )
    people.coalesce(1).write.parquet(f"{root}/people.parquet")
    spark.createDataFrame([("x",)], "DS string").write.parquet(f"{root}/words.parquet")
    spark.createDataFrame([], "DT string, n int").write.parquet(f"{root}/nothing.parquet")
    return TableDirectory(str(root))


def test_pipeline_end_to_end(spark, source, layout, stamp_at):
    results = run_pipeline(spark, source, layout, ingested_at=stamp_at, refined_at=stamp_at)
    assert rows(results.drop("error")) == [
        ("bronze", "nothing", "written", 0, None, None, 0),
        ("bronze", "people", "written", 4, None, None, 4),
        ("bronze", "words", "written", 1, None, None, 1),
        ("extract", "nothing", "written", 0, None, None, 0),
        ("extract", "people", "written", 4, None, None, 4),
        ("extract", "words", "written", 1, None, None, 1),
        ("silver", "nothing", "written", 0, 0, 0, 0),
        ("silver", "people", "written", 4, 3, 2, 2),
        ("silver", "words", "written", 1, 1, 1, 1),
    ]
    assert rows(read_table(spark, layout.silver_path("people"))) == [
        ("1", "ANA", "1.5", STAMP, STAMP, STAMP),
        ("3", "BO", "10000000.0", STAMP, STAMP, STAMP),
    ]
    assert read_table(spark, layout.silver_path("people")).columns[:3] == ["CODIGO", "NOME", "amount"]
    assert read_table(spark, layout.silver_path("nothing")).columns[:2] == ["DATA", "n"]


def test_pipeline_can_be_run_again(spark, source, layout):
    run_pipeline(spark, source, layout, tables=["people"])
    run_pipeline(spark, source, layout, tables=["people"])
    assert read_table(spark, layout.silver_path("people")).count() == 2


def test_pipeline_from_a_database(spark, layout, stamp_at):
    table = spark.createDataFrame([(1, "a"), (2, None)], "CD int, NM string")
    database = load_database(spark, {"t": table}, {"t": ["CD"]})
    run_pipeline(spark, database, layout, ingested_at=stamp_at, refined_at=stamp_at)
    assert rows(read_table(spark, layout.silver_path("t"))) == [("1", "A", STAMP, STAMP, STAMP)]


def test_bronze_is_text_and_one_stamp_per_load(spark, source, layout):
    extract_to_landing(spark, source, layout)
    landing_to_bronze(spark, layout)
    people = read_table(spark, layout.bronze_path("people"))
    assert [f.dataType for f in people.schema] == [T.StringType()] * 3 + [T.TimestampType()]
    assert people.select("_ingestion_timestamp").distinct().count() == 1
    assert people.count() == 4


def test_landing_without_columns_becomes_a_stamp_only_table(spark, layout):
    (Path(layout.landing)).mkdir(parents=True)
    (Path(layout.landing) / "none.csv").write_text("\n")
    landing_to_bronze(spark, layout)
    bronze = read_table(spark, layout.bronze_path("none"))
    assert bronze.columns == ["_ingestion_timestamp"] and bronze.isEmpty()
    bronze_to_silver(spark, layout)
    assert read_table(spark, layout.silver_path("none")).isEmpty()


@pytest.mark.parametrize("audit", [True, False])
def test_silver_with_and_without_counts(spark, source, layout, stamp_at, audit):
    extract_to_landing(spark, source, layout)
    landing_to_bronze(spark, layout, now=stamp_at)
    results = bronze_to_silver(spark, layout, tables=["people"], now=stamp_at, audit=audit)
    counts = rows(results.select("rows_read", "rows_distinct", "rows_complete", "rows_written"))
    assert counts == ([(4, 3, 2, 2)] if audit else [(None, None, None, None)])
    assert read_table(spark, layout.silver_path("people")).count() == 2


def test_one_write_job_reads_bronze_once(spark, layout, stamp_at):
    bronze = spark.createDataFrame([("1",)], "CD string").withColumn("_ingestion_timestamp", stamp_at)
    write_layer(bronze, layout.bronze_path("t"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("silver", "one table")
    bronze_to_silver(spark, layout, parallelism=1)
    # Jobs: two stages of the adaptive write, and one footer read for the schema.
    assert len(tracker.getJobIdsForGroup("silver")) <= 3
    spark.sparkContext._jsc.clearJobGroup()


def test_own_rename_map(spark, source, layout, stamp_at):
    run_pipeline(spark, source, layout, {"amount": "VALOR"}, ["people"], stamp_at, stamp_at)
    assert read_table(spark, layout.silver_path("people")).columns[:3] == ["CD", "NM", "VALOR"]


def broken_lake(spark, layout, stamp_at):
    good = spark.createDataFrame([("1",)], "CD string").withColumn("_ingestion_timestamp", stamp_at)
    write_layer(good, layout.bronze_path("a"))
    write_layer(spark.createDataFrame([("1",)], "CD string"), layout.bronze_path("b"))
    write_layer(good, layout.bronze_path("c"))


def test_first_failure_stops_the_stage_and_keeps_what_is_written(spark, layout, stamp_at):
    broken_lake(spark, layout, stamp_at)
    with pytest.raises(StageFailure, match="table b") as failure:
        bronze_to_silver(spark, layout, parallelism=1)
    outcome = [(r.table_name, r.status) for r in failure.value.results]
    assert outcome == [("a", "written"), ("b", "failed"), ("c", "skipped")]
    assert read_table(spark, layout.silver_path("a")).count() == 1
    assert not Path(layout.silver_path("c")).exists()


def test_failures_can_be_reported_instead(spark, layout, stamp_at):
    broken_lake(spark, layout, stamp_at)
    results = bronze_to_silver(spark, layout, on_error="continue")
    assert rows(results.select("table_name", "status")) == [("a", "written"), ("b", "failed"), ("c", "written")]
    assert "_ingestion_timestamp is missing" in results.filter("status = 'failed'").first().error


def test_missing_table_fails(spark, layout):
    with pytest.raises(StageFailure, match="absent"):
        bronze_to_silver(spark, layout, tables=["absent"])


def test_policy_names_are_checked(spark, layout):
    with pytest.raises(ValueError, match="on_error"):
        bronze_to_silver(spark, layout, tables=[], on_error="ignore")


def test_no_tables_is_an_empty_result(spark, layout):
    assert bronze_to_silver(spark, layout, tables=[]).isEmpty()


def test_rows_with_very_many_copies(spark, layout, stamp_at):
    hot = spark.range(30_000).select(F.expr("IF(id < 10000, 'hot', CAST(id AS STRING))").alias("CD"))
    write_layer(hot.withColumn("_ingestion_timestamp", stamp_at), layout.bronze_path("t"))
    results = bronze_to_silver(spark, layout)
    assert rows(results.select("rows_read", "rows_distinct", "rows_complete")) == [(30000, 20001, 20001)]


def test_shuffles_grow_with_the_input_within_bounds():
    assert reduce_tasks(0, 8) == 8
    assert reduce_tasks(BYTES_PER_TASK * 100 + 1, 8) == 101
    assert reduce_tasks(100 * 1024**4, 200) == MOST_TASKS


def test_each_table_has_its_own_shuffle_setting_and_the_users_own_is_respected(spark):
    small, large = session_sized_for(spark, 1), session_sized_for(spark, BYTES_PER_TASK * 50)
    assert small.conf.get(INITIAL_PARTITIONS) == "8" and large.conf.get(INITIAL_PARTITIONS) == "50"
    assert large.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    spark.conf.set(INITIAL_PARTITIONS, 7)
    assert session_sized_for(spark, BYTES_PER_TASK * 50).conf.get(INITIAL_PARTITIONS) == "7"
    spark.conf.unset(INITIAL_PARTITIONS)


def test_the_users_own_choice_about_shuffle_files_stays(spark):
    assert session_sized_for(spark, 1).conf.get(DROP_SHUFFLES) == "true"
    spark.conf.set(DROP_SHUFFLES, "false")
    assert session_sized_for(spark, 1).conf.get(DROP_SHUFFLES) == "false"
    spark.conf.unset(DROP_SHUFFLES)


@pytest.mark.parametrize("distinct", ["rows", "fingerprints"])
def test_silver_leaves_no_shuffle_files(spark, layout, stamp_at, distinct):
    def shuffled():
        found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
        return {name for name in found.splitlines() if "/shuffle_" in name}

    rows_ = spark.range(1000).selectExpr("CAST(id % 700 AS STRING) AS a").withColumn("_ingestion_timestamp", stamp_at)
    write_layer(rows_, layout.bronze_path("t"))
    before = shuffled()
    assert bronze_to_silver(spark, layout, distinct=distinct).first()["rows_written"] == 700
    assert not shuffled() - before


def test_silver_shuffles_into_as_many_partitions_as_the_session_of_the_table_says(spark, layout):
    path = layout.bronze_path("rows")
    spark.range(1000).selectExpr("CAST(id % 10 AS STRING) AS a").write.parquet(path)
    plans = []
    for stored in (1, BYTES_PER_TASK * 50):
        silver = dedupe_rows(session_sized_for(spark, stored).read.parquet(path))
        plans.append(silver._jdf.queryExecution().executedPlan().toString())
    assert "hashpartitioning(a" in plans[0]
    counts = [int(re.search(r"hashpartitioning\([^)]*, (\d+)\)", plan)[1]) for plan in plans]
    assert counts == [8, 50]


def test_wide_rows_land_in_files_of_about_the_goal(spark, layout):
    rows_ = spark.range(4000).selectExpr("id", "repeat('x', 5000) AS text").coalesce(1)
    goal = 4 * 1024 * 1024
    write_landing(rows_, layout.landing_path("wide"), rows_for(rows_, goal))
    folder = Path(layout.landing_path("wide"))
    sizes = [f.stat().st_size for f in folder.glob("part-*")]
    assert len(sizes) >= 4 and max(sizes) <= 2 * goal
    assert read_landing(spark, str(folder)).count() == 4000


def test_pipeline_passes_the_policy_on(spark, layout, tmp_path):
    class Half:
        def tables(self, spark):
            return ["bad", "good"]

        def read(self, spark, table):
            if table == "bad":
                raise RuntimeError("no such table")
            return spark.range(100).selectExpr("id AS a")

    results = run_pipeline(spark, Half(), layout, on_error="continue", rows_per_file=10, parallelism=1)
    assert {(r["stage"], r["table_name"], r["status"]) for r in results.collect()} >= {
        ("extract", "bad", "failed"),
        ("silver", "good", "written"),
    }
    assert len(list(Path(layout.landing_path("good")).glob("part-*"))) >= 10


def test_scratch_folders_lie_in_the_sessions_shared_directory(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    first, second = new_folder(spark, "x"), new_folder(spark, "x")
    assert first.startswith(shared) and first != second
