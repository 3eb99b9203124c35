"""Registered queries against their SQL on the smallest given tables."""

from __future__ import annotations

import contextlib
import io
import os
import subprocess
import sys
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from stratalake.checks import catalogue
from stratalake.checks.catalogue import ORACLES, QUERIES
from stratalake.plans import stages
from stratalake.sources.files import read_landing
from tests.oracle import TESTDATA, connect, differences

SF_DIR = f"{TESTDATA}/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the given tables are not here")

# The operators every one of which must be registered.
OPERATORS = """
    jdbc_table_scan jdbc_single_table_extract jdbc_table_discovery collection_discovery document_collection_flatten
    landing_csv_scan landing_csv_text_fidelity bronze_table_scan text_line_scan landing_table_list bronze_table_list
    silver_events bronze_stamp silver_provenance_copy rename_by_map upper_strings drop_incomplete_rows dedupe_rows
    row_count stage_row_audit schema_report preview_rows extract_schema_counts extract_collections_counts
    landing_to_bronze medallion_full source_probe
""".split()


@pytest.fixture(scope="module")
def database():
    return connect(SF_DIR)


def test_every_operator_is_registered():
    assert set(OPERATORS) <= set(queries())
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_gives_the_rows_of_its_sql(spark, database, name):
    assert differences(QUERIES[name](spark, SF_DIR), database, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


@pytest.mark.parametrize("absent", ["regex", "xxhash", "stratalake.llm", "corpus_pipeline"])
def test_the_other_queries_do_not_need_the_text_operators(absent):
    code = f"""
import sys, importlib.util
real = importlib.util.find_spec
importlib.util.find_spec = lambda name, *a: None if name == {absent!r} else real(name, *a)
sys.modules[{absent!r}] = None
import __spark_entry__
from stratalake.checks.catalogue import QUERIES
assert set(QUERIES) <= set(__spark_entry__.queries()), "lost"
assert {absent!r} == "corpus_pipeline" or not any(n.startswith("op") for n in __spark_entry__.queries()), "there"
assert "pipeline" not in __spark_entry__.queries()
"""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-600:]


@pytest.mark.parametrize("name", ["silver_events", "silver_lineitem", "dedupe_rows", "schema_report", "source_probe"])
def test_plans_have_no_pair_joins_and_no_python(spark, name):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        queries()[name](spark, SF_DIR).explain()
    assert not any(word in text.getvalue() for word in ("Cartesian", "NestedLoop", "Python"))


@pytest.mark.parametrize("name", ["medallion_audit", "medallion_orders"])
def test_layers_of_whole_tables_do_not_shuffle_rows_without_a_copy(spark, monkeypatch, name):
    plans, write = [], stages.write_layer

    def noted(df, path, *args):
        if "/silver/" in path:
            plans.append(df._jdf.queryExecution().analyzed().toString())
        return write(df, path, *args)

    monkeypatch.setattr(stages, "write_layer", noted)
    monkeypatch.setattr(catalogue, "ALL_TABLES", ["nation", "orders"])
    found = QUERIES[name](spark, SF_DIR).collect()
    assert plans and all("bitmap_construct_agg" in plan for plan in plans)
    if name == "medallion_audit":
        silver = {r["table_name"]: r["rows_written"] for r in found if r["stage"] == "silver"}
        whole = {t: catalogue.given(spark, SF_DIR, t).distinct().count() for t in ("nation", "orders")}
        assert silver == whole


def test_the_audits_layers_lie_compressed_and_whole(spark, monkeypatch, tmp_path):
    layouts, lake = [], catalogue.new_lake

    def noted(*args):
        layouts.append(lake(*args))
        return layouts[-1]

    monkeypatch.setattr(catalogue, "new_lake", noted)
    monkeypatch.setattr(catalogue, "ALL_TABLES", ["few", "many"])
    whole = {"few": 3, "many": 2000}
    for name, n in whole.items():
        spark.range(n).selectExpr("id", "CONCAT('row ', id, ', with \"quotes\"') AS text").write.parquet(str(tmp_path / f"{name}.parquet"))
    found = QUERIES["medallion_audit"](spark, str(tmp_path)).collect()
    assert {(r["stage"], r["table_name"], r["rows_written"]) for r in found} == {(s, t, n) for t, n in whole.items() for s in ("extract", "bronze", "silver")}
    for name, n in whole.items():
        landed = layouts[0].landing_path(name)
        parts = list(Path(landed).glob("part-*"))
        assert parts and all(p.name.endswith(".csv.gz") for p in parts)
        assert read_landing(spark, landed).count() == n
        for path in (layouts[0].bronze_path(name), layouts[0].silver_path(name)):
            files = [pq.ParquetFile(p).metadata for p in Path(path).glob("part-*")]
            assert sum(f.num_rows for f in files) == n
            assert {f.row_group(0).column(0).compression for f in files if f.num_row_groups} == {"ZSTD"}
