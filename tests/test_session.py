"""Where lineage is cut."""

from types import SimpleNamespace

import os

import pytest

from procurelytics.session import cut_lineage, cut_result, scratch_path, shared_folder


def session(named, master="local[2]"):
    """What ``shared_folder`` reads of a session."""
    settings = {} if named is None else {"spark.checkpoint.dir": named}
    return SimpleNamespace(conf=SimpleNamespace(get=settings.get), sparkContext=SimpleNamespace(applicationId=f"app-{named}", master=master))


def test_named_folder_is_used():
    assert shared_folder(session("hdfs:///shared/x")) == "hdfs:///shared/x"
    first, second = (scratch_path(session("hdfs:///shared/x/"), "t") for _ in range(2))
    assert first.startswith("hdfs:///shared/x/t-") and first != second


def test_unset_folder_falls_back_once():
    folder = shared_folder(session(None))
    assert os.path.isdir(folder) and shared_folder(session(None)) == folder


@pytest.mark.parametrize("master", ["yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"])
def test_a_cluster_without_shared_folder_is_an_error(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session(None, master))
    assert shared_folder(session("hdfs:///x", master)) == "hdfs:///x"


def test_cut_reads_stored_rows(spark):
    out = cut_lineage(spark.range(10).selectExpr("id", "id * 2 AS v"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan parquet" in plan and "Range" not in plan and shared_folder(spark).split(":")[-1] in plan
    assert out.count() == 10 and out.columns == ["id", "v"]


def test_tables_on_the_way_go_with_the_result(spark):
    folder = shared_folder(spark).split(":")[-1]
    before, made = set(os.listdir(folder)), []

    def inner():
        made.append(cut_lineage(spark.range(5)))
        return made[0].selectExpr("id + 1 AS id")

    def outer():
        found = cut_result(spark, inner)
        assert len(set(os.listdir(folder)) - before) == 1  # the inner result only
        return found.unionByName(cut_lineage(spark.range(2)))

    out = cut_result(spark, outer)
    assert len(set(os.listdir(folder)) - before) == 1
    assert sorted(r[0] for r in out.collect()) == [0, 1, 1, 2, 3, 4, 5]
    kept = cut_lineage(spark.range(3))
    with pytest.raises(ZeroDivisionError):
        cut_result(spark, lambda: 1 / 0)
    assert kept.count() == 3 and cut_lineage(spark.range(4)).count() == 4
    assert len(set(os.listdir(folder)) - before) == 3
