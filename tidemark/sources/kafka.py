"""Kafka topics of comma-separated records. Needs the Kafka connector on the class path."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.text import parse_records


def read_options(
    brokers: str, topic: str, group_id: str | None = None, starting: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Source options. `starting` seeds the first run; later runs resume from the checkpoint."""
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_records(spark: SparkSession, options: dict[str, str], schema: T.StructType) -> DataFrame:
    raw = spark.readStream.format("kafka").options(**options).load()
    return parse_records(decode(raw), schema)


def decode(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("value").cast("string").alias("value"))


def encode(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """`value` (and `key`) as text, ready to be written to a topic; null becomes an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
    value = F.concat_ws(",", *fields).alias("value")
    return df.select(*([F.col(key).cast("string").alias("key")] if key else []), value)


def publish(encoded: DataFrame, brokers: str, topic: str) -> None:
    """Writes a batch of encoded rows to a topic, from all tasks in parallel."""
    writer = encoded.write.format("kafka")
    writer.option("kafka.bootstrap.servers", brokers).option("topic", topic).save()


def publish_stream(encoded: DataFrame, brokers: str, topic: str, checkpoint: str):
    writer = encoded.writeStream.format("kafka").option("checkpointLocation", checkpoint)
    return writer.option("kafka.bootstrap.servers", brokers).option("topic", topic).start()
