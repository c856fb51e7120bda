from types import SimpleNamespace

import pytest

from quillspan import session


def _cluster(master, shared=None):
    """A session that looks like one of `master` without a checkpoint folder of its own."""
    own = SimpleNamespace(folder=None)
    current = SimpleNamespace(isDefined=lambda: own.folder is not None, get=lambda: own.folder)
    context = SimpleNamespace(
        master=master,
        _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: current)),
        setCheckpointDir=lambda folder: setattr(own, "folder", folder),
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda _name, _default: shared))


def test_checkpoints_go_to_the_shared_folder():
    assert session.ensure_checkpoint_dir(_cluster("spark://host:7077", "file:///shared")) == "file:///shared"
    assert session.ensure_checkpoint_dir(_cluster("local[4]", "/own")) == "/own"
    assert "quillspan-checkpoints" in session.ensure_checkpoint_dir(_cluster("local[4]"))


@pytest.mark.parametrize("master", ["spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://host"])
def test_a_cluster_without_a_shared_folder_is_an_error(master):
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(_cluster(master))


def test_only_small_scans_are_dealt_out(spark, monkeypatch):
    df = spark.range(0, 100, 1, 1)
    assert session.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "SPREAD_BYTES", 8)
    assert session.spread(df).rdd.getNumPartitions() == 1
