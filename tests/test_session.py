from types import SimpleNamespace

import pytest

from playmart.session import checkpoint_dir


def fake(master, conf=None, current=None):
    kept = dict(conf or {})
    sc = SimpleNamespace(master=master, getCheckpointDir=lambda: current, setCheckpointDir=lambda p: kept.update(set=p))
    get = lambda k, d=None: kept.get(k, d)
    return SimpleNamespace(conf=SimpleNamespace(get=get, set=kept.__setitem__), sparkContext=sc), kept


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    spark, _ = fake(master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(spark)
    spark, kept = fake(master, {"spark.checkpoint.dir": "hdfs:///shared"})
    assert checkpoint_dir(spark) == "hdfs:///shared" == kept["set"]


@pytest.mark.parametrize("master", ["local", "local[4]", "local[*]", "local[4,2]"])
def test_a_local_master_gets_a_folder(master):
    spark, kept = fake(master)
    assert checkpoint_dir(spark) == kept["spark.checkpoint.dir"] == kept["set"]
