from types import SimpleNamespace

import pytest

from ecoledger import session


def stub(master, named=None, current=None):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: named),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: current),
    )


def test_shared_folder_comes_from_the_session():
    assert session.shared_root(stub("yarn", named="hdfs://n/ckpt/")) == "hdfs://n/ckpt"
    assert session.shared_root(stub("yarn", current="s3://b/c")) == "s3://b/c"


def test_a_cluster_never_falls_back_to_a_local_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(stub("spark://host:7077"))


def test_broadcast_depends_on_size(spark):
    def hinted(df):
        return "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()

    table = session.settle(spark.range(100))
    assert hinted(session.broadcast_if_small(table, 100))
    assert not hinted(session.broadcast_if_small(table, 99))
