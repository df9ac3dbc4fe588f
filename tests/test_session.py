"""Session helpers: partition sizing and the shared scratch folder."""

from types import SimpleNamespace

import pytest

from bourse.session import ensure_checkpoint_dir, scale_conf, scratch_path


def test_scale_conf_sizes_partitions():
    conf = scale_conf(100 * 10 ** 12, 4000)
    reducers = int(conf["spark.sql.shuffle.partitions"])
    assert reducers == 100 * 10 ** 12 // (256 << 20)
    assert conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] == str(reducers)
    small = scale_conf(10 << 20, 64)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 64   # at least 3 waves


def test_scratch_is_under_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b
    assert a.startswith(base.rstrip("/")) or base.rstrip("/").split(":")[-1] in a


def test_a_cluster_must_name_its_folder():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: conf, master="yarn", setCheckpointDir=None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=conf))
