from types import SimpleNamespace

import pytest

from ledgerloom.session import settings_for, shared_folder, shuffles_for


def session(master, folder=None, app="app-1"):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId=app),
    )


def test_the_named_folder_is_used():
    assert shared_folder(session("yarn", "hdfs://shared/work/")) == "hdfs://shared/work"


def test_a_cluster_must_name_a_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session("yarn"))


def test_a_local_session_keeps_its_own_folder():
    first = shared_folder(session("local[4]", app="a"))
    assert first == shared_folder(session("local[4]", app="a"))
    assert first != shared_folder(session("local[4]", app="b"))


def test_partition_counts_grow_with_the_input():
    small, large = settings_for(10**9), settings_for(10**13)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(large["spark.sql.shuffle.partitions"]) == -(-(10**13) // 2**29)
    most = settings_for(10**14)["spark.sql.shuffle.partitions"]
    assert int(most) == -(-(10**14) // 2**29) == 186265


def test_shuffles_begin_with_more_partitions_for_more_input(spark):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    try:
        assert shuffles_for(spark, 1000) == given
        assert spark.conf.get(name, None) is None
        assert shuffles_for(spark, 2**30) == 128
        assert spark.conf.get(name) == "128"
        assert shuffles_for(spark, 1000) == 128
    finally:
        spark.conf.unset(name)
