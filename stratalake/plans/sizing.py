"""How many reduce tasks a shuffle over a given number of bytes gets."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
# Shuffle files go when their query has ended. Else they stay until the driver happens to collect its garbage, and those of
# all tables lie on the executors' disks at once.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Stored bytes per reduce task. Compressed columns unfold several times over in the shuffle.
BYTES_PER_TASK = 64 * 1024 * 1024
# Beyond this many reduce tasks the bookkeeping of the shuffle costs more than larger, spilling tasks: 100 TB of
# stored bytes are then 760 MB for each.
MOST_TASKS = 131_072


def reduce_tasks(stored_bytes: int, configured: int) -> int:
    """Never fewer than the session asks for; adaptive execution joins the small ones again."""
    return max(configured, min(MOST_TASKS, -(-stored_bytes // BYTES_PER_TASK)))


def session_like(spark: SparkSession, settings: Mapping[str, str]) -> SparkSession:
    """A session of its own with the given settings and otherwise those of ``spark``, which stays as it is."""
    session = spark.newSession()
    ours, theirs = spark.conf.getAll, session.conf.getAll
    for name, value in (ours | dict(settings)).items():
        if theirs.get(name) != value and session.conf.isModifiable(name):
            session.conf.set(name, value)
    return session


def session_sized_for(spark: SparkSession, stored_bytes: int) -> SparkSession:
    """A session whose adaptive shuffles begin with enough partitions for one table, and whose shuffle files go after each query.

    The session's fixed number fits one size of table only: adaptive execution can join partitions that turn
    out small, but an aggregate's partitions are never split. What the user has set stays.
    """
    tasks = reduce_tasks(stored_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    settings = {INITIAL_PARTITIONS: str(tasks), DROP_SHUFFLES: "true"}
    return session_like(spark, {name: value for name, value in settings.items() if spark.conf.get(name, None) is None})
