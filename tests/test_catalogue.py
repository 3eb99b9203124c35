"""Tables of a metastore as a source."""

from __future__ import annotations

import uuid

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from stratalake import CatalogueSource, extract_to_landing, read_landing, run_pipeline
from stratalake.sources.catalogue import identifier
from tests.conftest import rows

JDBC_CATALOG = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"
DERBY = "org.apache.derby.jdbc.EmbeddedDriver"


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}'")
    spark.createDataFrame([(1, "a"), (2, None)], "k long, v string").write.saveAsTable(f"{name}.first")
    spark.createDataFrame([(3,)], "k long").write.saveAsTable(f"{name}.odd_name")
    spark.sql(f"CREATE VIEW {name}.seen AS SELECT k FROM {name}.first")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def relational(spark):
    """A DataSource V2 catalogue over an in-process database."""
    name = f"cat{uuid.uuid4().hex}"
    url = f"jdbc:derby:memory:{name};create=true"
    settings = {"": JDBC_CATALOG, ".url": url, ".driver": DERBY}
    for key, value in settings.items():
        spark.conf.set(f"spark.sql.catalog.{name}{key}", value)
    spark.range(7).withColumn("t", F.lit("x")).write.jdbc(url, '"APP"."numbers"', mode="append", properties={"driver": DERBY})
    yield name
    for key in settings:
        spark.conf.unset(f"spark.sql.catalog.{name}{key}")


def test_tables_and_views_without_temporary_ones(spark, database):
    spark.range(1).createOrReplaceTempView("passing")
    assert CatalogueSource(database).tables(spark) == ["first", "odd_name", "seen"]
    assert CatalogueSource(("spark_catalog", database), include_views=False).tables(spark) == ["first", "odd_name"]
    assert rows(CatalogueSource(database).catalog(spark)) == [("first",), ("odd_name",), ("seen",)]
    spark.catalog.dropTempView("passing")


def test_rows_of_a_table_and_of_a_view(spark, database):
    source = CatalogueSource(database)
    assert rows(source.read(spark, "first")) == [(1, "a"), (2, None)]
    assert rows(source.read(spark, "odd_name")) == [(3,)]
    assert rows(source.read(spark, "seen")) == [(1,), (2,)]


def test_extract_and_whole_pipeline(spark, database, layout):
    source = CatalogueSource(database)
    extract_to_landing(spark, source, layout, ["first"])
    assert rows(read_landing(spark, layout.landing_path("first"))) == [("1", "a"), ("2", None)]
    done = run_pipeline(spark, source, layout)
    assert {(r["stage"], r["table_name"], r["rows_written"]) for r in done.collect()} >= {("silver", "first", 1), ("silver", "odd_name", 1)}


def test_namespaces_of_another_catalogue(spark, relational):
    source = CatalogueSource((relational, "APP"))
    assert source.tables(spark) == ["numbers"]
    assert source.read(spark, "numbers").agg(F.sum("id")).first()[0] == 21
    assert CatalogueSource((relational, "APP"), include_views=False).tables(spark) == ["numbers"]


def test_filters_reach_another_catalogue(spark, relational):
    plan = CatalogueSource((relational, "APP")).read(spark, "numbers").where("id > 5")._jdf.queryExecution().toString()
    assert "PushedPredicates: [ID IS NOT NULL, ID > 5]" in plan.replace('"', "").replace("id", "ID") or "PushedFilters" in plan or "> 5" in plan


def test_nested_namespaces(spark, relational, database):
    source = CatalogueSource((relational,), nested=True)
    assert source.tables(spark) == ["APP.numbers"]
    assert source.read(spark, "APP.numbers").count() == 7
    below = CatalogueSource("spark_catalog", nested=True)
    assert {f"{database}.first", f"{database}.seen"} <= set(below.tables(spark))
    assert rows(below.read(spark, f"{database}.seen")) == [(1,), (2,)]
    with pytest.raises(ValueError, match="no table"):
        below.read(spark, "first")


def test_probe(spark, database):
    assert rows(CatalogueSource(database).probe(spark)) == [(1,)]
    with pytest.raises(AnalysisException):
        CatalogueSource("not_there").probe(spark)


def test_odd_names():
    assert identifier(["a.b", "c`d"]) == "`a.b`.`c``d`"
    for bad in ((), "", ("a", "")):
        with pytest.raises(ValueError):
            CatalogueSource(bad)
