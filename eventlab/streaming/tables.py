"""Tables a stream writes batch by batch into a shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlab.streaming.sinks import overwrite_batch


class OutputTable:
    """Rows written by each micro-batch, ``<folder>/batch=<id>``."""

    def __init__(self, folder: str, schema: str):
        self.folder, self.schema = folder, schema

    def write(self, rows: DataFrame, batch_id: int) -> None:
        overwrite_batch(rows, self.folder, batch_id)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(self.schema).parquet(f"{self.folder}/batch={batch_id}")

    def all(self, spark: SparkSession) -> DataFrame:
        """Rows of all batches."""
        return spark.read.schema(self.schema).parquet(f"{self.folder}/batch=*")


class StateTable:
    """What one micro-batch leaves for the next, in two slots used in turn.

    Batch ``n`` reads what batch ``n - 1`` wrote and writes the other slot.  A batch that
    has to be repeated therefore starts from the same state, and old states do not pile up.
    """

    def __init__(self, folder: str, schema: str):
        self.folder, self.schema = folder, schema

    def before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(f"{self.folder}/slot={(batch_id - 1) % 2}")

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/slot={batch_id % 2}")
