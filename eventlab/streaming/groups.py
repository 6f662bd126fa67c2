"""Handing over the rows of a stream in groups of a fixed size, across micro-batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventlab.operators.running import chunked
from eventlab.streaming.counters import schema_of
from eventlab.streaming.sinks import to_batches
from eventlab.streaming.tables import OutputTable, StateTable


class RowGroups:
    """Writes groups of exactly ``size`` rows in the order of ``seq``, which rises from batch to batch.

    What a batch leaves over, fewer than ``size`` rows, opens the first group of the next
    one; :meth:`all` also lists it, so no row is lost.
    """

    def __init__(self, stream: DataFrame, seq: str, size: int, folder: str):
        self.stream, self.seq, self.size = stream, seq, size
        schema = f"{schema_of(stream, *stream.columns)}, `group` bigint"
        self.groups = OutputTable(f"{folder}/groups", schema)
        self.rest = StateTable(f"{folder}/rest", schema)
        self.done = StateTable(f"{folder}/done", "next bigint, batch bigint")

    def writer(self, checkpoint: str) -> DataStreamWriter:
        return to_batches(self.stream, self._flush, checkpoint)

    def _flush(self, batch: DataFrame, batch_id: int) -> None:
        spark, columns = batch.sparkSession, self.stream.columns
        state = self.done.before(spark, batch_id).first()
        begun = state["next"] if state else 0
        rows = self.rest.before(spark, batch_id).select(*columns).unionByName(batch.select(*columns)).persist()
        complete = rows.count() // self.size
        grouped = chunked(rows, [], self.seq, self.size).withColumn("group", F.col("chunk") + F.lit(begun)).drop("chunk")
        self.groups.write(grouped.filter(F.col("group") < begun + complete), batch_id)
        self.rest.write(grouped.filter(F.col("group") >= begun + complete), batch_id)
        self.done.write(spark.createDataFrame([(begun + complete, batch_id)], self.done.schema), batch_id)
        self.last = batch_id
        rows.unpersist()

    def all(self, spark: SparkSession) -> DataFrame:
        """Rows with their ``group``, the unfinished last one included."""
        return self.groups.all(spark).unionByName(self.rest.before(spark, self.last + 1))
