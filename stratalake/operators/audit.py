"""Row counts, schema reports and previews."""

from __future__ import annotations

import logging
import queue
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from stratalake.functions.names import columns, unused
from stratalake.operators.cleaning import is_complete

log = logging.getLogger(__name__)

# How long counts may lag behind the write they were taken in.
PATIENCE_SECONDS = 300.0


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    """The number of rows, as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def step_counts(df: DataFrame) -> DataFrame:
    """Rows read, rows left after the distinct and rows left after the null-drop, without writing anything.

    One pass: equal rows are counted together, then the groups are added up.
    """
    copies = unused(df, "__copies")
    complete = F.count_if(is_complete(df.schema))
    return (
        df.groupBy(*columns(df))
        .agg(F.count(F.lit(1)).alias(copies))
        .agg(
            F.coalesce(F.sum(copies), F.lit(0)).alias("rows_read"),
            F.count(F.lit(1)).alias("rows_distinct"),
            complete.alias("rows_complete"),
        )
    )


def observed_counts(
    counts: Observation, recount: Callable[[], DataFrame], patience: float = PATIENCE_SECONDS
) -> dict[str, int]:
    """The counts left in an observation, or those of ``recount`` if they do not come.

    They come over Spark's listener bus. A job of very many tasks can flood it, and it then drops what it cannot
    hold; waiting for counts that were dropped would never end.
    """
    arrived: queue.Queue[dict[str, int]] = queue.Queue()
    threading.Thread(target=lambda: arrived.put(counts.get), daemon=True).start()
    try:
        return arrived.get(timeout=patience)
    except queue.Empty:
        log.warning("no counts came with the write, counting again")
        return recount().first().asDict()


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: ordinal from 1, name, type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, start=1)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")


def table_report(df: DataFrame) -> DataFrame:
    """The schema report with the table's row count beside every column."""
    lines = [
        F.struct(
            F.lit(i).alias("ordinal"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
        )
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return row_count(df).select(F.inline(F.array(*lines)), "n_rows")


def preview(df: DataFrame, n: int = 20) -> DataFrame:
    """The first ``n`` rows Spark comes by; no order is implied."""
    return df.limit(n)
