"""The stages of the pipeline: source to landing, landing to bronze, bronze to silver."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.layout import LakeLayout
from stratalake.operators.audit import observed_counts, row_count, step_counts
from stratalake.operators.cleaning import INGESTION_STAMP, RENAME_MAP, clean, clean_counted, stamp
from stratalake.plans.runs import RESULT_SCHEMA, RunRecord, TableResult
from stratalake.plans.sizing import session_sized_for
from stratalake.sinks.landing import rows_for, write_landing
from stratalake.sinks.layers import write_layer
from stratalake.sources.files import read_landing, read_table
from stratalake.sources.listing import bronze_tables, landing_tables, size_in_bytes

log = logging.getLogger(__name__)

class Source(Protocol):
    """Whatever has named tables that can be read whole."""

    def tables(self, spark: SparkSession) -> list[str]: ...

    def read(self, spark: SparkSession, table: str) -> DataFrame: ...


class StageFailure(RuntimeError):
    """A table failed and the stage stopped; ``results`` tells which tables were written before."""

    def __init__(self, results: Sequence[TableResult]):
        self.results = tuple(results)
        failed = next(r for r in results if r.status == "failed")
        super().__init__(f"{failed.stage} stopped at table {failed.table_name}: {failed.error}")


def extract_to_landing(
    spark: SparkSession,
    source: Source,
    layout: LakeLayout,
    tables: Sequence[str] | None = None,
    *,
    rows_per_file: int | None = None,
    on_error: str = "fail",
    parallelism: int = 4,
    run: str | None = None,
) -> DataFrame:
    """Writes every table of the source, or those named, to the landing area.

    ``rows_per_file`` bounds the rows of a file; by default it follows from the width of the rows (see ``rows_for``).
    With ``run`` the outcome of every table is kept under that name for the stages that follow (``RunRecord``).
    """

    def extract(table: str) -> TableResult:
        counts = Observation()
        rows = source.read(spark, table)
        if not rows.columns:
            write_landing(rows, layout.landing_path(table), codec=layout.landing_codec)
            return TableResult("extract", table, "written", rows_read=0, rows_written=0)
        path = layout.landing_path(table)
        write_landing(_counted(rows, counts), path, rows_per_file or rows_for(rows), codec=layout.landing_codec)
        n = observed_counts(counts, lambda: row_count(read_landing(spark, path), "n"))["n"]
        return TableResult("extract", table, "written", rows_read=n, rows_written=n)

    names = source.tables(spark) if tables is None else tables
    return _run_stage(spark, "extract", names, extract, on_error, parallelism, record=run and RunRecord(layout, run))


def landing_to_bronze(
    spark: SparkSession,
    layout: LakeLayout,
    tables: Sequence[str] | None = None,
    now: Column | None = None,
    *,
    on_schema_change: str = "fail",
    on_error: str = "fail",
    parallelism: int = 4,
    run: str | None = None,
) -> DataFrame:
    """Loads every landing CSV, or those named, as an all-text table with an ingestion stamp.

    With ``run`` only the tables that this run's extract wrote are loaded; it must have left its record. The others are reported as
    skipped, and their former versions stay as they are.
    """

    def load(table: str) -> TableResult:
        counts = Observation()
        rows = read_landing(spark, layout.landing_path(table)).transform(stamp, INGESTION_STAMP, now)
        path = layout.bronze_path(table)
        write_layer(_counted(rows, counts), path, layout.table_format, on_schema_change, None, layout.table_codec)
        n = observed_counts(counts, lambda: row_count(read_table(spark, path, layout.table_format), "n"))["n"]
        return TableResult("bronze", table, "written", rows_read=n, rows_written=n)

    record = run and RunRecord(layout, run)
    names, skipped = _handed_over(spark, "bronze", tables, lambda: landing_tables(spark, layout), record)
    sizes = {table: size_in_bytes(spark, layout.landing_path(table)) for table in names}
    return _run_stage(spark, "bronze", _largest_first(sizes, parallelism), load, on_error, parallelism, skipped, record)


def bronze_to_silver(
    spark: SparkSession,
    layout: LakeLayout,
    rename_map: Mapping[str, str] = RENAME_MAP,
    tables: Sequence[str] | None = None,
    now: Column | None = None,
    *,
    audit: bool = True,
    distinct: str = "rows",
    on_schema_change: str = "fail",
    on_error: str = "fail",
    parallelism: int = 4,
    run: str | None = None,
) -> DataFrame:
    """Cleans every bronze table, or those named, into silver.

    With ``audit`` the counts of each step come with the one pass that writes the table. Without it they stay
    null, and incomplete rows are already left out by the scan, before the shuffle. Each table's shuffle is sized by the
    table, in a session of its own. ``distinct="fingerprints"`` shuffles hashes in place of rows that have no copy, for
    tables of wide rows. With ``run`` only the tables that this run's bronze stage wrote are cleaned, as in ``landing_to_bronze``.
    """

    def refine(table: str) -> TableResult:
        source_path, path = layout.bronze_path(table), layout.silver_path(table)
        bronze = read_table(session_sized_for(spark, sizes[table]), source_path, layout.table_format)
        counts = Observation()
        silver = (
            clean_counted(bronze, counts, rename_map, now, distinct) if audit else clean(bronze, rename_map, now, distinct)
        )
        write_layer(silver, path, layout.table_format, on_schema_change, source_path, layout.table_codec)
        if not audit:
            return TableResult("silver", table, "written")
        n = observed_counts(counts, lambda: step_counts(bronze))
        return TableResult(
            "silver",
            table,
            "written",
            rows_read=n["rows_read"],
            rows_distinct=n["rows_distinct"],
            rows_complete=n["rows_complete"],
            rows_written=n["rows_complete"],
        )

    record = run and RunRecord(layout, run)
    names, skipped = _handed_over(spark, "silver", tables, lambda: bronze_tables(spark, layout), record)
    sizes = {table: size_in_bytes(spark, layout.bronze_path(table)) for table in names}
    return _run_stage(spark, "silver", _largest_first(sizes, parallelism), refine, on_error, parallelism, skipped, record)


def run_pipeline(
    spark: SparkSession,
    source: Source,
    layout: LakeLayout,
    rename_map: Mapping[str, str] = RENAME_MAP,
    tables: Sequence[str] | None = None,
    ingested_at: Column | None = None,
    refined_at: Column | None = None,
    *,
    rows_per_file: int | None = None,
    audit: bool = True,
    distinct: str = "rows",
    on_schema_change: str = "fail",
    on_error: str = "fail",
    parallelism: int = 4,
    run: str | None = None,
) -> DataFrame:
    """All three stages, each begun when the one before has written all its tables.

    A stage takes the tables that the one before wrote in this run and reports the others as skipped: with
    ``on_error="continue"`` a table that fails keeps its former rows and stamps in the later layers. ``run`` names the run's
    records; by default it gets a name of its own.
    """
    policy = {"on_error": on_error, "parallelism": parallelism, "run": run or uuid.uuid4().hex}
    writes = {"on_schema_change": on_schema_change, **policy}
    extracted = extract_to_landing(spark, source, layout, tables, rows_per_file=rows_per_file, **policy)
    loaded = landing_to_bronze(spark, layout, tables, ingested_at, **writes)
    refined = bronze_to_silver(spark, layout, rename_map, tables, refined_at, audit=audit, distinct=distinct, **writes)
    return extracted.unionByName(loaded).unionByName(refined)


def _handed_over(
    spark: SparkSession,
    stage: str,
    tables: Sequence[str] | None,
    listed: Callable[[], list[str]],
    record: RunRecord | None,
) -> tuple[list[str], list[TableResult]]:
    """The tables a stage is to take, and those it skips because the stage before did not write them in this run."""
    if record is None:
        return list(listed() if tables is None else tables), []
    before = record.before(spark, stage)
    names = list(before if tables is None else tables)
    written = [name for name in names if before.get(name) == "written"]
    skipped = [
        TableResult(stage, name, "skipped", error=f"{before.get(name, 'not there')} in the stage before")
        for name in names
        if name not in written
    ]
    return written, skipped


def _counted(df: DataFrame, counts: Observation) -> DataFrame:
    return df.observe(counts, F.count(F.lit(1)).alias("n"))


def _largest_first(sizes: Mapping[str, int], parallelism: int) -> list[str]:
    """The order to begin tables in: beside others, a large one begun last would run on alone."""
    return sorted(sizes, key=lambda table: -sizes[table]) if parallelism > 1 else list(sizes)


def _run_stage(
    spark: SparkSession,
    stage: str,
    tables: Iterable[str],
    work: Callable[[str], TableResult],
    on_error: str,
    parallelism: int,
    skipped: Sequence[TableResult] = (),
    record: RunRecord | None = None,
) -> DataFrame:
    """Runs ``work`` for each table, a few at a time, and returns one row per table.

    Tables do not depend on each other, so several keep the cluster busy while the last tasks of one run out.
    With ``on_error="fail"`` the first failure keeps further tables from starting; those written stay. ``skipped`` are results of
    tables that are not begun at all, and ``record`` keeps all of them.
    """
    if on_error not in ("fail", "continue"):
        raise ValueError(f"on_error is 'fail' or 'continue', not {on_error!r}")

    failures: list[Exception] = []

    def step(table: str) -> TableResult:
        if failures and on_error == "fail":
            return TableResult(stage, table, "skipped")
        try:
            result = work(table)
        except Exception as error:
            log.error("%s: table %s failed", stage, table, exc_info=True)
            failures.append(error)
            return TableResult(stage, table, "failed", error=f"{type(error).__name__}: {error}")
        log.info("%s: table %s written", stage, table)
        return result

    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        results = [*pool.map(inheritable_thread_target(spark)(step), tables), *skipped]
    if record is not None:
        record.write(spark, stage, results)
    if failures and on_error == "fail":
        raise StageFailure(results) from failures[0]
    return spark.createDataFrame([r.as_row() for r in results], RESULT_SCHEMA)
