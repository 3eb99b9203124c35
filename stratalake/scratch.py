"""Folders for what a job writes for itself and reads again."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from stratalake.sources.listing import scratch_directory

CHECKPOINT_DIR = "spark.checkpoint.dir"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the shared directory the session names, removed when the driver ends.

    Executors read there what other executors wrote, so on a cluster a folder of one machine will not do. In local mode the
    session's warehouse takes the place of a directory that is not named.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return scratch_directory(spark, f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}")
