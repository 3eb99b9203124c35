"""Where registered queries may write."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from stratalake.checks.database import load_database
from stratalake.checks.workspace import new_folder, new_lake


def session(master: str):
    conf = SimpleNamespace(get=lambda key, default=None: default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"])
def test_a_cluster_must_name_its_shared_folder(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        new_folder(session(master), "x")


@pytest.mark.parametrize("master", ["yarn", "local-cluster[2,1,1024]"])
def test_the_in_process_database_is_for_local_mode(master):
    with pytest.raises(RuntimeError, match="local mode"):
        load_database(session(master), {})


def test_lakes_lie_in_the_named_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    lake = new_lake(spark, "lake")
    assert lake.bronze.startswith(f"{shared}/lake-") and lake.bronze.endswith("/bronze")
