"""Layered ELT on Spark: extract to landing CSV, load to bronze, clean to silver."""

from stratalake.layout import LakeLayout
from stratalake.operators.audit import preview, row_count, schema_report
from stratalake.operators.cleaning import (
    RENAME_MAP,
    clean,
    copy_provenance,
    dedupe_rows,
    dedupe_wide,
    drop_incomplete_rows,
    rename_by_map,
    stamp,
    upper_strings,
)
from stratalake.plans.runs import NotRun, RunRecord
from stratalake.plans.stages import (
    StageFailure,
    bronze_to_silver,
    extract_to_landing,
    landing_to_bronze,
    run_pipeline,
)
from stratalake.sources.catalogue import CatalogueSource
from stratalake.sources.documents import DocumentSource
from stratalake.sources.files import TableDirectory, read_landing, read_lines, read_table
from stratalake.sources.relational import DERBY, INFORMATION_SCHEMA, Dialect, RelationalSource

__all__ = [
    "DERBY",
    "INFORMATION_SCHEMA",
    "RENAME_MAP",
    "CatalogueSource",
    "Dialect",
    "DocumentSource",
    "LakeLayout",
    "NotRun",
    "RelationalSource",
    "RunRecord",
    "StageFailure",
    "TableDirectory",
    "bronze_to_silver",
    "clean",
    "copy_provenance",
    "dedupe_rows",
    "dedupe_wide",
    "drop_incomplete_rows",
    "extract_to_landing",
    "landing_to_bronze",
    "preview",
    "read_landing",
    "read_lines",
    "read_table",
    "rename_by_map",
    "row_count",
    "run_pipeline",
    "schema_report",
    "stamp",
    "upper_strings",
]
