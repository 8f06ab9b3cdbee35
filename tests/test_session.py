from __future__ import annotations

from barsmith.session import CLUSTER_CONF, ensure_checkpoint_dir
from barsmith.sources.tables import spread, table
from tests.conftest import SF0001


def test_checkpoint_dir_is_set_and_stable(spark):
    first = ensure_checkpoint_dir(spark)
    assert first and ensure_checkpoint_dir(spark) == first
    assert spark.sparkContext.getCheckpointDir()


def test_spread_only_touches_small_scans(spark):
    li = table(spark, SF0001, "lineitem")
    cores = spark.sparkContext.defaultParallelism
    assert li.rdd.getNumPartitions() < cores  # the test file is one small split
    assert spread(li, "l_orderkey").rdd.getNumPartitions() == cores
    wide = spark.range(0, 1000, numPartitions=cores * 2)
    assert spread(wide, "id") is wide


def test_cluster_profile_values_are_sane():
    assert int(CLUSTER_CONF["spark.sql.shuffle.partitions"]) >= 1000
    assert CLUSTER_CONF["spark.sql.files.maxPartitionBytes"].endswith("m")
