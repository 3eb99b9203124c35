"""What a run's stages leave each other: one record for each stage of how every table came out."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratalake.layout import LakeLayout
from stratalake.sources.listing import exists

RESULT_SCHEMA = (
    "stage string, table_name string, status string, rows_read bigint, rows_distinct bigint, "
    "rows_complete bigint, rows_written bigint, error string"
)

# The stages in their order.
STAGES = ("extract", "bronze", "silver")


@dataclass(frozen=True)
class TableResult:
    """How a table came out of a stage: ``written``, ``failed`` or ``skipped``."""

    stage: str
    table_name: str
    status: str
    rows_read: int | None = None
    rows_distinct: int | None = None
    rows_complete: int | None = None
    rows_written: int | None = None
    error: str | None = None

    def as_row(self) -> tuple:
        return (
            self.stage,
            self.table_name,
            self.status,
            self.rows_read,
            self.rows_distinct,
            self.rows_complete,
            self.rows_written,
            self.error,
        )


class NotRun(ValueError):
    """A stage that should have run before left no record in this run."""


@dataclass(frozen=True)
class RunRecord:
    """The records of one run, JSON below ``_runs`` in the landing area, so that stages may be jobs of their own."""

    layout: LakeLayout
    run: str

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._+:-]*", self.run):
            raise ValueError(f"{self.run!r} cannot name a run: letters, digits and ._+:- only")

    def path(self, stage: str) -> str:
        return f"{self.layout.landing}/_runs/{self.run.replace(':', '_')}/{stage}"

    def write(self, spark: SparkSession, stage: str, results: Sequence[TableResult]) -> None:
        rows = spark.createDataFrame([r.as_row() for r in results], RESULT_SCHEMA)
        rows.coalesce(1).write.mode("overwrite").json(self.path(stage))

    def read(self, spark: SparkSession, stage: str) -> DataFrame:
        """The stage's results; raises ``NotRun`` where it left none."""
        if not exists(spark, f"{self.path(stage)}/_SUCCESS"):
            raise NotRun(f"run {self.run} has no record of its {stage} stage")
        return spark.read.schema(RESULT_SCHEMA).json(self.path(stage))

    def before(self, spark: SparkSession, stage: str) -> dict[str, str] | None:
        """How each table came out of the stage before this one; None for the first."""
        place = STAGES.index(stage)
        if not place:
            return None
        return {r["table_name"]: r["status"] for r in self.read(spark, STAGES[place - 1]).collect()}
