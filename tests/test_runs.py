"""What stages hand over, what replaced tables leave behind, and the distinct of wide rows."""

from __future__ import annotations

import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from stratalake import NotRun, RunRecord, StageFailure, bronze_to_silver, extract_to_landing, landing_to_bronze, read_table, run_pipeline
from stratalake.operators.cleaning import clean, clean_counted, dedupe_rows, dedupe_wide, fingerprint, mark_repeated
from stratalake.sinks.layers import SchemaChanged, write_layer
from stratalake.sources.listing import bronze_tables, recover, recover_all
from tests.conftest import rows


class Tables:
    """A source some of whose tables are out of reach."""

    def __init__(self, **found):
        self.found, self.down = found, set()

    def tables(self, spark):
        return sorted(self.found)

    def read(self, spark, table):
        if table in self.down:
            raise ConnectionError(f"{table} is down")
        return self.found[table]


@pytest.fixture
def source(spark):
    return Tables(**{name: spark.createDataFrame([(name, 1), (name, 2)], "v string, n int") for name in "abc"})


def statuses(results):
    return {(r["stage"], r["table_name"]): r["status"] for r in results.collect()}


def at(day):
    return F.lit(f"2024-01-{day:02} 00:00:00").cast("timestamp")


def test_a_table_that_fails_keeps_its_former_rows_and_stamps(spark, source, layout):
    run_pipeline(spark, source, layout, ingested_at=at(1), refined_at=at(1))
    before = {layer: rows(read_table(spark, path)) for layer, path in (("bronze", layout.bronze_path("a")), ("silver", layout.silver_path("a")))}
    source.down = {"a"}
    done = statuses(run_pipeline(spark, source, layout, ingested_at=at(2), refined_at=at(2), on_error="continue"))
    assert done == {(s, t): ("failed" if s == "extract" else "skipped") if t == "a" else "written" for s in ("extract", "bronze", "silver") for t in "abc"}
    assert rows(read_table(spark, layout.bronze_path("a"))) == before["bronze"]
    assert rows(read_table(spark, layout.silver_path("a"))) == before["silver"]
    assert {r["_ingestion_timestamp"].day for r in read_table(spark, layout.bronze_path("b")).collect()} == {2}


def test_a_table_that_left_the_source_is_not_stamped_again(spark, source, layout):
    run_pipeline(spark, source, layout, ingested_at=at(1), refined_at=at(1))
    del source.found["c"]
    done = statuses(run_pipeline(spark, source, layout, ingested_at=at(2), refined_at=at(2)))
    assert {table for _, table in done} == {"a", "b"}
    assert {r["_ingestion_timestamp"].day for r in read_table(spark, layout.bronze_path("c")).collect()} == {1}


def test_stages_as_jobs_of_their_own(spark, source, layout):
    source.down = {"b"}
    extract_to_landing(spark, source, layout, run="2024-01-01", on_error="continue")
    loaded = statuses(landing_to_bronze(spark, layout, run="2024-01-01"))
    assert loaded == {("bronze", "a"): "written", ("bronze", "b"): "skipped", ("bronze", "c"): "written"}
    refined = bronze_to_silver(spark, layout, tables=["a", "b", "z"], run="2024-01-01")
    assert statuses(refined) == {("silver", "a"): "written", ("silver", "b"): "skipped", ("silver", "z"): "skipped"}
    assert {r["table_name"]: r["error"] for r in refined.collect()}["z"] == "not there in the stage before"


def test_a_failure_leaves_its_record_too(spark, source, layout):
    source.down = {"a"}
    with pytest.raises(StageFailure):
        extract_to_landing(spark, source, layout, run="r", parallelism=1)
    assert statuses(landing_to_bronze(spark, layout, run="r")) == {("bronze", t): "skipped" for t in "abc"}


def test_a_stage_waits_for_the_one_before(spark, source, layout):
    extract_to_landing(spark, source, layout, run="one")
    with pytest.raises(NotRun, match="two"):
        landing_to_bronze(spark, layout, run="two")
    with pytest.raises(NotRun):
        bronze_to_silver(spark, layout, run="one")


@pytest.mark.parametrize("name", ["", "../x", "a/b", ".hidden"])
def test_names_of_runs(layout, name):
    with pytest.raises(ValueError):
        RunRecord(layout, name)


# Replacements that ended between their two renames


def half_done(path, written=True):
    """What is there when the driver ends after the first rename."""
    table = Path(path)
    table.rename(table.parent / f"_{table.name}-0123456789ab-old")
    if written:
        (table.parent / f"_{table.name}-0123456789ab-new").mkdir()


@pytest.fixture
def table(spark, layout):
    path = layout.bronze_path("t")
    write_layer(spark.createDataFrame([(1, "x")], "k int, v string"), path)
    return path


def test_the_next_read_brings_the_former_rows_back(spark, table):
    half_done(table)
    assert rows(read_table(spark, table)) == [(1, "x")]
    assert [p.name for p in Path(table).parent.iterdir()] == ["t"]


def test_the_next_listing_does(spark, layout, table):
    half_done(table, written=False)
    assert bronze_tables(spark, layout) == ["t"]
    assert recover_all(spark, layout.bronze) == []


def test_the_next_write_minds_the_former_columns(spark, table):
    half_done(table)
    with pytest.raises(SchemaChanged):
        write_layer(spark.createDataFrame([(1,)], "k int"), table)
    write_layer(spark.createDataFrame([(2, "y")], "k int, v string"), table)
    assert rows(read_table(spark, table)) == [(2, "y")]


def test_a_table_that_is_there_stays(spark, table):
    former = Path(table).parent / "_t-0123456789ab-old"
    former.mkdir()
    assert not recover(spark, table)
    assert rows(read_table(spark, table)) == [(1, "x")] and former.exists()


def test_other_tables_names_do_not_match(spark, layout):
    path = layout.bronze_path("a-b")
    write_layer(spark.createDataFrame([(1,)], "k int"), path)
    half_done(path)
    assert not recover(spark, layout.bronze_path("b")) and not recover(spark, layout.bronze_path("a"))
    assert recover_all(spark, layout.bronze) == ["a-b"]


def test_two_former_versions_are_left_to_the_user(spark, layout, table):
    half_done(table)
    (Path(layout.bronze) / "_t-ba9876543210-old").mkdir()
    assert not recover(spark, table)


# Distinct by fingerprint

GIVEN = [("a", 1, 0.0), ("a", 1, -0.0), ("a", 1, float("nan")), ("a", 1, float("nan")), (None, 1, None), (None, 1, None), ("b", None, 2.0), (None, None, None), ("x", 2, 1.5)]
SCHEMA = "v string, n int, d double"


def as_rows(df):
    return Counter(tuple("nan" if x != x else x for x in r) for r in df.collect())


@pytest.mark.parametrize("copies", [1, 3])
def test_same_rows_as_the_exchange(spark, copies):
    df = spark.createDataFrame(GIVEN * copies, SCHEMA).repartition(4)
    assert as_rows(dedupe_wide(df)) == as_rows(dedupe_rows(df))
    counted = dedupe_wide(df, "copies")
    assert counted.agg(F.sum("copies")).first()[0] == len(GIVEN) * copies
    assert as_rows(counted.drop("copies")) == as_rows(dedupe_rows(df))


@pytest.mark.parametrize("hashes", [lambda df: [F.lit(1).cast("long"), F.lit(2).cast("long")], lambda df: [F.length(F.coalesce("v", F.lit(""))).cast("long"), F.lit(-5).cast("long")]])
@pytest.mark.parametrize("map_bits", [1, 8, 1 << 26])
def test_forced_collisions_change_nothing(spark, hashes, map_bits):
    df = spark.createDataFrame([*GIVEN, *GIVEN, ("only", 7, 7.0)], SCHEMA)
    assert as_rows(dedupe_wide(df, hashes=hashes, map_bits=map_bits)) == as_rows(dedupe_rows(df))


def test_only_rows_with_copies_move(spark):
    text = F.repeat(F.col("id").cast("string"), 200)
    df = spark.range(5000).select("id", text.alias("text"))
    df = df.unionAll(df.where("id % 100 = 0"))
    moved = mark_repeated(df, "moved").where("moved")
    assert moved.select("id").distinct().count() == 50 and moved.count() == 100
    assert dedupe_wide(df).count() == 5000


def test_one_hash_of_a_row_is_shuffled(spark):
    plan = mark_repeated(spark.range(10).selectExpr("id", "CAST(id AS STRING) AS text"), "moved")._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(h1#\w+, \d+\)", plan) and "h2#" not in plan


def test_equal_rows_have_equal_fingerprints(spark):
    df = spark.createDataFrame(GIVEN, SCHEMA)
    prints = df.select("v", "n", "d", *(h.alias(f"h{k}") for k, h in enumerate(fingerprint(df)))).collect()
    by_row = {}
    for r in prints:
        by_row.setdefault(("nan" if r["d"] != r["d"] else r["d"], r["v"], r["n"]), set()).add((r["h0"], r["h1"]))
    assert all(len(p) == 1 for p in by_row.values()) and len({next(iter(p)) for p in by_row.values()}) == len(by_row)


def test_nested_floats_take_the_exchange(spark):
    df = spark.createDataFrame([([0.0],), ([-0.0],), ([1.0],)], "d array<double>")
    assert dedupe_wide(df).count() == dedupe_rows(df).count()


@pytest.mark.parametrize("copies", [1, 2])
def test_cleaning_and_its_counts_are_the_same(spark, copies):
    bronze = spark.createDataFrame([("a", "x"), ("b", None), ("c", "y")] * copies + [("d", "z")], "TP string, v string")
    bronze = bronze.withColumn("_ingestion_timestamp", at(1))
    assert rows(clean(bronze, now=at(2), distinct="fingerprints")) == rows(clean(bronze, now=at(2)))
    counts = {}
    for distinct in ("rows", "fingerprints"):
        seen = Observation()
        clean_counted(bronze, seen, now=at(2), distinct=distinct).collect()
        counts[distinct] = seen.get
    assert counts["rows"] == counts["fingerprints"] == {"rows_read": 3 * copies + 1, "rows_distinct": 4, "rows_complete": 3}
    with pytest.raises(ValueError):
        clean(bronze, distinct="hash")


def test_the_silver_stage_by_fingerprints(spark, layout):
    bronze = spark.createDataFrame([("a",), ("a",), (None,)], "v string").withColumn("_ingestion_timestamp", at(1))
    write_layer(bronze, layout.bronze_path("t"))
    done = bronze_to_silver(spark, layout, now=at(2), distinct="fingerprints").first()
    assert (done["rows_read"], done["rows_distinct"], done["rows_written"]) == (3, 2, 1)
