"""Where the registered queries keep the layers they write."""

from __future__ import annotations

from pyspark.sql import SparkSession

from stratalake.layout import LakeLayout
from stratalake.scratch import CHECKPOINT_DIR, new_folder

__all__ = ["CHECKPOINT_DIR", "new_folder", "new_lake"]


def new_lake(spark: SparkSession, purpose: str) -> LakeLayout:
    return LakeLayout.under(new_folder(spark, purpose))
