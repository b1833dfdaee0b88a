"""Shared storage: a cluster must name its folder; folders are made by their own file system."""

from types import SimpleNamespace

import pytest

from tidepool import session as S


def _fake(master, setting=None):
    conf = SimpleNamespace(get=lambda key, default=None: setting if key == "spark.checkpoint.dir" else default)
    context = SimpleNamespace(master=master, applicationId="fake", getConf=lambda: SimpleNamespace(get=lambda key: setting),
                              getCheckpointDir=lambda: "set")
    return SimpleNamespace(conf=conf, sparkContext=context)


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://https://host", "local-cluster[2,1,1024]"])
def test_a_cluster_without_a_shared_folder_is_refused(master):
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.ensure_checkpoint_dir(_fake(master))
    assert S.ensure_checkpoint_dir(_fake(master, "hdfs://store/ckpt")) == "hdfs://store/ckpt"


def test_a_local_session_gets_a_scratch_folder():
    assert S.ensure_checkpoint_dir(_fake("local[2]")) == S.ensure_checkpoint_dir(_fake("local[2]"))


def test_folders_are_made_by_the_file_system_of_the_path(spark, scratch):
    S.ensure_folder(spark, f"{scratch}/x/y z")
    fs, path = S.folder(spark, f"{scratch}/x/y z")
    assert fs.exists(path) and S.work_dir(spark, "a") != S.work_dir(spark, "a")
