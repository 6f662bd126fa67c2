import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlab.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", **{
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "2",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def files(spark, tmp_path):
    """Write tables as files of a folder, one file each, in the order in which a stream reads them."""
    def write(name, tables):
        folder = tmp_path / name
        folder.mkdir()
        for i, table in enumerate(tables):
            table.toPandas().to_parquet(folder / f"{i:05d}.parquet", coerce_timestamps="us")
            os.utime(folder / f"{i:05d}.parquet", (time.time() - 1000 + i,) * 2)
        return str(folder)
    return write
