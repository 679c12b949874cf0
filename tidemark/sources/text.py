"""Delimited records and access-log lines, from files, streams of files, sockets or Kafka values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
# Positions in a space-separated access-log line and its time format.
LOG_FIELDS = {"ip": 0, "user_id": 1, "method": 5, "url": 6}
LOG_TIME_FIELD = 3
LOG_TIME_FORMAT = "dd/MM/yyyy:HH:mm:ss"


def read_records(
    spark: SparkSession, path: str, schema: T.StructType, strict: bool = True, stream: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Comma-separated files without header, as typed rows with an event-time column `ts`.

    A malformed line fails the job; with `strict=False` it is kept in `_corrupt_record` instead.
    """
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if strict:
        raw = reader.schema(schema).csv(path, mode="FAILFAST")
    else:
        with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        raw = reader.schema(with_corrupt).csv(path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return with_event_time(raw)


def parse_records(lines: DataFrame, schema: T.StructType, line: str = "value") -> DataFrame:
    """Typed rows from text lines such as Kafka values; a malformed line fails the job."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    record = F.from_csv(F.col(line), fields, {"mode": "FAILFAST"})
    return with_event_time(lines.select(record.alias("_r")).select("_r.*"))


def with_event_time(df: DataFrame, seconds: str = "ts") -> DataFrame:
    return df.withColumn(seconds, F.timestamp_seconds(seconds))


def read_lines(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return (spark.readStream if stream else spark.read).text(path)


def read_socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket, for trying things out: Spark cannot replay it after a failure."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def parse_access_log(lines: DataFrame, line: str = "value", strict: bool = True) -> DataFrame:
    """`ip`, `user_id`, `ts`, `method`, `url` of access-log lines; the zone field is ignored.

    A malformed line is an error. With `strict=False` it gives nulls where it can't be read, and
    `bad_line` keeps it; that column is null for good lines.
    """
    parts = F.split(F.col(line), " ")
    if strict:
        fields = {name: parts[at] for name, at in LOG_FIELDS.items()}
        fields["ts"] = F.to_timestamp(parts[LOG_TIME_FIELD], LOG_TIME_FORMAT)
    else:
        fields = {name: F.get(parts, F.lit(at)) for name, at in LOG_FIELDS.items()}
        fields["ts"] = F.try_to_timestamp(F.get(parts, F.lit(LOG_TIME_FIELD)), F.lit(LOG_TIME_FORMAT))
        good = fields["ts"].isNotNull()
        for name in LOG_FIELDS:
            good = good & fields[name].isNotNull()
        fields["bad_line"] = F.when(~good, F.col(line))
    names = ["ip", "user_id", "ts", "method", "url", *([] if strict else ["bad_line"])]
    return lines.select(*(fields[n].alias(n) for n in names))


def not_empty(column: str) -> Column:
    """Neither null nor empty: CSV readers turn an empty field into null."""
    return F.coalesce(F.col(column), F.lit("")) != ""
