from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.eventtime import next_midnight
from tidemark.functions.hashing import rolling_offset
from tidemark.runtime import scratch_dir
from tidemark.sources import kafka, schemas, text
from tidemark.sources.tables import Tables

LOGINS = "5402,83.149.11.115,success,1558430815\n23064,66.249.3.15,fail,1558430826\n"
ORDERS = "34729,create,,1558430842\n34729,pay,sd76f87d6,1558430844\n"


def write(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content)
    return str(path)


def test_records_are_typed(spark, tmp_path):
    rows = text.read_records(spark, write(tmp_path, "logins.csv", LOGINS), schemas.LOGIN)
    assert [f.dataType.simpleString() for f in rows.schema] == ["bigint", "string", "string", "timestamp"]
    first = rows.orderBy("ts").select("user_id", "ip", "event_type", F.unix_seconds("ts")).first()
    assert tuple(first) == (5402, "83.149.11.115", "success", 1558430815)


def test_malformed_lines_fail_or_are_kept(spark, tmp_path):
    path = write(tmp_path, "bad.csv", LOGINS + "oops,1.2.3.4,fail,1558430830\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        text.read_records(spark, path, schemas.LOGIN).collect()
    kept = text.read_records(spark, path, schemas.LOGIN, strict=False).cache()
    assert [r[text.CORRUPT] for r in kept.filter(F.col(text.CORRUPT).isNotNull()).collect()] == [
        "oops,1.2.3.4,fail,1558430830"
    ]


def test_empty_transaction_id(spark, tmp_path):
    orders = text.read_records(spark, write(tmp_path, "orders.csv", ORDERS), schemas.ORDER)
    assert [r.tx_id for r in orders.filter(text.not_empty("tx_id")).collect()] == ["sd76f87d6"]
    assert spark.createDataFrame([("",), (None,)], "tx_id string").filter(text.not_empty("tx_id")).count() == 0


def test_access_log(spark, tmp_path):
    line = "83.149.9.216 u7 - 17/05/2015:10:05:03 +0000 GET /presentations/logo.png\n"
    lines = text.read_lines(spark, write(tmp_path, "access.log", line))
    (row,) = text.parse_access_log(lines).select("ip", "user_id", F.unix_seconds("ts").alias("s"), "method", "url").collect()
    assert tuple(row) == ("83.149.9.216", "u7", 1431857103, "GET", "/presentations/logo.png")


def test_kafka_values_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, "create", None, 10), (1, "pay", "tx", 12)], schemas.ORDER)
    encoded = kafka.encode(rows, schemas.ORDER.fieldNames(), key="order_id")
    assert [tuple(r) for r in encoded.collect()] == [("1", "1,create,,10"), ("1", "1,pay,tx,12")]
    values = encoded.select(F.encode("value", "UTF-8").alias("value"))
    parsed = text.parse_records(kafka.decode(values), schemas.ORDER).withColumn("ts", F.unix_seconds("ts"))
    assert [tuple(r) for r in parsed.collect()] == [(1, "create", None, 10), (1, "pay", "tx", 12)]
    with pytest.raises(Exception, match="(?i)malformed"):
        bad = spark.createDataFrame([("x,create,,10",)], "value string")
        text.parse_records(bad, schemas.ORDER).collect()


def test_kafka_options():
    options = kafka.read_options("b:9092", "hotitems", group_id="g", max_offsets_per_trigger=5)
    assert options == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "hotitems",
        "startingOffsets": "latest",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "5",
    }


def offset_of(value: str, multiplier: int) -> int:
    units, result = value.encode("utf-16-le"), 0
    for i in range(0, len(units), 2):
        result = result * multiplier + int.from_bytes(units[i : i + 2], "little")
    return result % (1 << 30)


@pytest.mark.parametrize("multiplier", [79, 61])
def test_rolling_offset(spark, multiplier):
    values = ["143", "", "937166", "-9223372036854775808", "naïve", "日本", "a😀b"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    found = df.select("v", rolling_offset(F.col("v"), multiplier).alias("o")).collect()
    assert {r.v: r.o for r in found} == {v: offset_of(v, multiplier) for v in values}
    assert offset_of("143", 79) == 309968


def test_next_midnight(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 28, 23, 59, 59),), (datetime(2024, 2, 29),)], "t timestamp_ntz")
    found = df.select(F.date_format(next_midnight(F.col("t").cast("timestamp")), "yyyy-MM-dd HH:mm").alias("m"))
    assert [r.m for r in found.collect()] == ["2024-02-29 00:00", "2024-03-01 00:00"]


def test_scratch_folders_are_below_the_named_folder_and_differ(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second and first.startswith(f"{root}/tidemark/x-")


def test_lenient_access_log(spark):
    good = '1.2.3.4 7 - 17/05/2015:10:05:03 +0000 GET /a'
    lines = spark.createDataFrame([(good,), ("too short",), (good.replace("17/05", "99/99"),), ("",), (None,)], "value string")
    rows = {row.bad_line: row for row in text.parse_access_log(lines, strict=False).collect()}
    assert rows.keys() == {None, "too short", good.replace("17/05", "99/99"), ""}
    assert rows[good.replace("17/05", "99/99")].url == "/a" and rows["too short"].ts is None


def test_every_order_has_its_create(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    kinds = {r.event_type: r["count"] for r in tables.order_events().groupBy("event_type").count().collect()}
    assert kinds == {"create": tables.table("orders").count(), "pay": tables.table("lineitem").count()}
