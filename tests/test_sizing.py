"""Checked broadcasts notice a rewritten table and wide rows; scratch paths never meet."""

import tempfile

import pytest
from pyspark.sql import functions as F

from smelter import session
from smelter.operators import sizing


def test_rewritten_table_is_checked_again(spark):
    path = tempfile.mkdtemp(prefix="dim-", dir="/tmp") + "/t"
    spark.range(10).write.parquet(path)
    assert sizing.is_bounded(spark.read.parquet(path), bound=1000)
    spark.range(3000).write.mode("overwrite").parquet(path)
    assert not sizing.is_bounded(spark.read.parquet(path), bound=1000)


def test_few_wide_rows_are_not_small(spark):
    wide = spark.range(50).select(F.repeat(F.lit("x"), 2000).alias("s"))
    assert sizing.is_bounded(wide) and not sizing.is_bounded(wide, bytes_bound=50_000)


class _Conf(dict):
    def set(self, key, value):
        self[key] = value


class _Session:
    def __init__(self, master, **conf):
        self.conf, self.sparkContext = _Conf(conf), self
        self.master, self.dir = master, None

    def getCheckpointDir(self):
        return self.dir

    def setCheckpointDir(self, path):
        self.dir = path


def test_cluster_must_name_the_shared_folder():
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_Session("spark://host:7077"))
    remote = _Session("yarn", **{"spark.checkpoint.dir": "hdfs://nn/ckpt/"})
    first, second = session.scratch_dir(remote, "landing"), session.scratch_dir(remote, "landing")
    assert first != second and first.startswith("hdfs://nn/ckpt/landing-") and remote.dir == "hdfs://nn/ckpt/"
