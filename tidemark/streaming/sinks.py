"""Running streams and keeping their results."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
EMPTY_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries started inside, put back afterwards."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def custom_state(spark: SparkSession, processing_time: bool = False):
    """Settings for custom stateful operators: state outside the heap.

    With processing-time timers Spark would start batch after batch without input and never be
    done with what is available, so such queries get no batches without input.
    """
    values = {STATE_PROVIDER: ROCKSDB}
    if processing_time:
        values[EMPTY_BATCHES] = "false"
    return settings(spark, values)


def run_available(writer: DataStreamWriter, checkpoint: str, end_input: Callable[[], None] | None = None) -> None:
    """Processes what the sources hold now, then stops; a rerun resumes from the checkpoint.

    With `end_input` the stream is ended: that adds the last rows to the sources, and the stream
    goes on with them, so that its watermark passes everything before.
    """
    writer = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.start().awaitTermination()
    if end_input is not None:
        end_input()
        writer.start().awaitTermination()


def append_available(stream: DataFrame, folder: str, end_input: Callable[[], None] | None = None) -> DataFrame:
    """Runs an append-mode stream into a parquet table and returns the table."""
    table = f"{folder}/table"
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", table)
    run_available(writer, f"{folder}/checkpoint", end_input)
    return stream.sparkSession.read.schema(stream.schema).parquet(table)


def each_batch(
    stream: DataFrame, folder: str, write: Callable[[DataFrame, int], None], mode: str = "append"
) -> None:
    """Runs a stream through `write(batch, batch_id)`, which may run again after a failure."""
    run_available(stream.writeStream.outputMode(mode).foreachBatch(write), f"{folder}/checkpoint")


def print_to_console(stream: DataFrame, label: str, mode: str = "append") -> StreamingQuery:
    """Shows results under a label while trying things out."""
    return stream.writeStream.outputMode(mode).format("console").queryName(label).start()


class BatchLog:
    """A table of what each micro-batch wrote.

    A batch writes its own folder and replaces it when it is retried, so every batch counts once.
    Keyed results are read back as the newest row per key: an upsert that never rewrites old data.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: str):
        self.spark, self.folder, self.schema = spark, folder, f"{schema}, batch_id bigint"
        # an empty batch before the first, so that the log can be read when no input has come yet
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{folder}/batch_id=-1")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{self.folder}/batch_id={batch_id}")

    def read(self, before: int | None = None) -> DataFrame:
        """All rows with their `batch_id`, optionally only of batches before one."""
        rows = self.spark.read.schema(self.schema).parquet(self.folder)
        return rows if before is None else rows.filter(F.col("batch_id") < before)

    def latest(self, keys: Sequence[str]) -> DataFrame:
        rows = self.read()
        values = [c for c in rows.columns if c not in keys and c != "batch_id"]
        newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("_newest"))
        return newest.select(*keys, *(F.col("_newest")[v].alias(v) for v in values))
