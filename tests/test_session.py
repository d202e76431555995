"""Where intermediate tables go."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

from sunledger.session import materialise, work_folder


def session(master, folder=None):
    conf = SimpleNamespace(get=lambda key, default=None: folder or default)
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


@pytest.mark.parametrize("master", ["spark://head:7077", "yarn", "local-cluster[3,2,1024]", "k8s://https://head"])
def test_a_cluster_has_to_name_a_shared_folder(master):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(session(master), "table")
    assert work_folder(session(master, "hdfs://shared/"), "table").startswith("hdfs://shared/table-")


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]"])
def test_a_local_session_has_a_folder_of_its_own(master):
    assert "/table-" in work_folder(session(master), "table")


def test_materialised_tables_are_parquet(spark):
    df = materialise(spark.range(10).selectExpr("id", "id % 3 AS k"))
    assert df.count() == 10
    assert "FileScan parquet" in df._jdf.queryExecution().toString()
