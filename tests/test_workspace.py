"""Where intermediate tables go."""

from types import SimpleNamespace

import pytest

from staywise import workspace


def session(master, conf):
    get = conf.get
    return SimpleNamespace(
        conf=SimpleNamespace(get=get, set=conf.__setitem__),
        sparkContext=SimpleNamespace(
            master=master, getConf=lambda: SimpleNamespace(get=lambda key: None)
        ),
    )


def test_the_named_folder_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace.new_folder(spark, "x").startswith(root + "/x-")
    assert workspace.new_folder(spark, "x") != workspace.new_folder(spark, "x")


def test_a_cluster_must_name_one():
    with pytest.raises(ValueError):
        workspace.shared_root(session("spark://host:7077", {}))
    with pytest.raises(ValueError):
        workspace.shared_root(session("local-cluster[2,1,1024]", {}))
    named = session("spark://host:7077", {"spark.checkpoint.dir": "s3://b/cp/"})
    assert workspace.shared_root(named) == "s3://b/cp"


def test_one_machine_falls_back_to_a_temporary_folder():
    local = session("local[2]", {})
    assert workspace.shared_root(local) == workspace.shared_root(local)


def test_written_copy_has_the_same_rows(spark):
    df = spark.range(100).selectExpr("id", "id / 3 AS x", "cast(NULL AS string) AS s")
    copy = workspace.cut_lineage(df)
    assert copy.columns == df.columns
    assert copy.exceptAll(df).count() == df.exceptAll(copy).count() == 0
    assert len(copy.inputFiles()) > 0
