import types

import pytest

from regpanel.operators import scan
from regpanel.session import ensure_checkpoint_dir


class _Conf(dict):
    def get(self, key, default=None):
        return dict.get(self, key, default)

    def set(self, key, value):
        self[key] = value


def _fake(master):
    sc = types.SimpleNamespace(master=master, getCheckpointDir=lambda: None,
                               setCheckpointDir=lambda d: None)
    return types.SimpleNamespace(conf=_Conf(), sparkContext=sc)


def test_unset_checkpoint_dir_is_an_error_on_a_cluster():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_fake("yarn"))
    shared = ensure_checkpoint_dir(_fake("yarn"), scratch_dir="s3://bucket/base/_checkpoints")
    assert shared == "s3://bucket/base/_checkpoints"


def test_session_checkpoint_dir_is_read_not_replaced(spark):
    before = ensure_checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark, scratch_dir="/elsewhere") == before


def test_scan_width_setting(spark):
    df = spark.range(10)
    old = spark.conf.get("regpanel.scan.partitions", None)
    spark.conf.set("regpanel.scan.partitions", "50")
    try:
        assert scan._num_buckets(df) == 50
    finally:
        if old is None:
            spark.conf.unset("regpanel.scan.partitions")
        else:
            spark.conf.set("regpanel.scan.partitions", old)
    assert scan._num_buckets(df) == max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
