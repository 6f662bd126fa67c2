from types import SimpleNamespace

import pytest

from eventlab.session import checkpoint_dir, sized_for, written


class FakeContext:
    """Just enough of a context to ask where checkpoints go."""

    def __init__(self, master, folder=None):
        self.master, self.folder, self.conf = master, None, {"spark.checkpoint.dir": folder}

    def getConf(self):
        return self.conf

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def session(master, folder=None):
    return SimpleNamespace(sparkContext=FakeContext(master, folder), conf=SimpleNamespace(get=lambda key, default: default))


def test_the_named_folder_is_used():
    cluster = session("spark://host:7077", "hdfs:///shared")
    assert checkpoint_dir(cluster) == "hdfs:///shared" == cluster.sparkContext.getCheckpointDir()


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session("spark://host:7077"))


def test_a_local_session_may_use_its_own():
    local = session("local[2]")
    assert checkpoint_dir(local) == local.sparkContext.getCheckpointDir()


def test_written_tables_keep_rows_and_types(spark):
    df = spark.sql("SELECT 1L a, timestamp_millis(5) t, named_struct('x', 'y') s, CAST(NULL AS STRING) n")
    kept = written(df)
    assert kept.dtypes == df.dtypes and kept.collect() == df.collect()
    assert "Project" not in kept._jdf.queryExecution().logical().toString()


def test_tasks_grow_with_the_data():
    assert sized_for(0)["spark.sql.shuffle.partitions"] == "200"
    assert sized_for(100 << 40)["spark.sql.shuffle.partitions"] == str(100 << 12)
