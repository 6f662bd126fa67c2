"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
CHANGES = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

# Event time is UTC, late joins may be skewed, streaming state can be large.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    CHANGES: "true",
    "spark.python.unix.domain.socket.enabled": "true",
}


def build_session(app_name: str = "eventlab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``conf`` entries win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(shuffled_bytes: int, task_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a job that shuffles about this much: that many tasks to begin with.

    Adaptive execution joins those that turn out small and splits skewed ones in joins.
    """
    tasks = max(200, -(-shuffled_bytes // task_bytes))
    return {
        "spark.sql.shuffle.partitions": str(tasks),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(task_bytes),
        "spark.sql.files.maxPartitionBytes": str(task_bytes),
    }


def use_utc(spark: SparkSession) -> None:
    """Pin the session zone: window borders and parsed times are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state on disk, as processors with timers need it, and write what a batch changed."""
    for name in ("spark.sql.streaming.stateStore.providerClass", CHANGES):
        spark.conf.set(name, SETTINGS[name])


@contextmanager
def state_tasks(spark: SparkSession) -> Iterator[None]:
    """Streams that run in here keep their state in two parts per core, or fewer if the session has fewer shuffle tasks.

    Every part of every stateful step is opened and committed in each micro-batch, with rows or
    without, and adaptive execution joins none of them, so hundreds cost more than their rows do.
    """
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, min(int(before), 2 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediate tables.

    ``spark.checkpoint.dir`` names it.  Only a local session, whose driver is its
    one executor, may fall back to a temporary folder of its own.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="eventlab-")
        context.setCheckpointDir(folder)
    return folder or context.getCheckpointDir()


def written(df: DataFrame) -> DataFrame:
    """The same table, computed once and kept in the shared checkpoint folder."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
