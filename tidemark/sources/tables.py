"""The parquet tables of a data folder in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
ORDERS_SCHEMA = (
    "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string"
)
LINEITEM_SCHEMA = "l_orderkey bigint, l_shipdate timestamp_ntz"
#: Above all ids of tables.
LAST_ID = 9_000_000_000_000_000
#: Rows that end an input, by table; no event type shares a user, so they match nothing.
ENDINGS = {
    "events": ", ".join(
        f"({LAST_ID + k}L, timestamp_ntz'2200-01-01', {LAST_ID + k}L, '{kind}', 0D, '{{\"k\": 0}}')"
        for k, kind in enumerate(("view", "click", "purchase", "error"), 1)
    ) + " AS rows(event_id, ts, user_id, event_type, value, props)",
    "orders": f"({LAST_ID + 1}L, {LAST_ID + 1}L, 'O', 0D, timestamp_ntz'2200-01-01', '')"
    " AS rows(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)",
}


class Tables:
    """Adapters over one folder. `stream=True` reads the same tables as streams.

    With `ending`, a folder that is empty while a bounded input is read, streams go on with what
    `end_input` writes there: rows far in the future, which let the watermark pass all others.
    """

    def __init__(
        self,
        spark: SparkSession,
        folder: str,
        stream: bool = False,
        files_per_trigger: int = 64,
        ending: str | None = None,
    ):
        self.ending = ending
        # the tables hold UTC times without zone; casts to timestamp follow the session zone
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark, self.folder, self.stream, self.files_per_trigger = spark, folder, stream, files_per_trigger

    def table(self, name: str, schema: str | None = None) -> DataFrame:
        folder = self.folder.rstrip("/")
        if self.stream:
            reader = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", self.files_per_trigger)
            # as a pattern, since a stream takes a plain path for a folder and the table may be a file
            rows = reader.parquet(f"{folder}/{{{name}.parquet}}")
            if self.ending is None or name not in ENDINGS:
                return rows
            return rows.unionByName(self.spark.readStream.schema(schema).parquet(f"{self.ending}/{name}/*.parquet"))
        return self.spark.read.parquet(f"{folder}/{name}.parquet")

    def end_input(self) -> None:
        """Ends the input of streams that have read it all, by a row for each role a table has."""
        for name, rows in ENDINGS.items():
            schema = EVENTS_SCHEMA if name == "events" else ORDERS_SCHEMA
            self.spark.sql(f"SELECT * FROM VALUES {rows}").to(StructType.fromDDL(schema)).coalesce(1).write.parquet(
                f"{self.ending}/{name}"
            )

    def events(self) -> DataFrame:
        return self.table("events", EVENTS_SCHEMA).withColumn("ts", F.col("ts").cast("timestamp"))

    def behaviors(self) -> DataFrame:
        """User behaviour: event_id, user_id, item_id, category_id, behavior, ts."""
        return self.events().select(
            "event_id",
            "user_id",
            _k().alias("item_id"),
            (_k() % 10).cast("int").alias("category_id"),
            F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behavior"),
            "ts",
        )

    def page_views(self) -> DataFrame:
        """Item views only; the filter is on the stored column, so it reaches the scan."""
        return self.events().filter(F.col("event_type") == "view").select(
            "event_id", "user_id", _k().alias("item_id"), "ts"
        )

    def log_lines(self) -> DataFrame:
        """Access-log lines of the views."""
        ip = F.concat_ws(".", F.lit("10"), F.lit("0"), _text(F.floor(F.col("user_id") / 256)), _text(F.col("user_id") % 256))
        line = F.concat_ws(
            " ",
            ip,
            _text(F.col("user_id")),
            F.lit("-"),
            F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
            F.lit("+0000"),
            F.lit("GET"),
            F.concat(F.lit("/page/"), _text(_k())),
        )
        return self.events().filter(F.col("event_type") == "view").select("event_id", line.alias("value"))

    def url_hits(self) -> DataFrame:
        """Page hits with `arrival`, a numbering that leaves event-time order in blocks of 97."""
        return self.page_views().select(
            "event_id",
            arrival_number(F.col("event_id")).alias("arrival"),
            F.concat(F.lit("/page/"), _text(F.col("item_id"))).alias("url"),
            "ts",
        )

    def marketing(self) -> DataFrame:
        """Marketing events: user_id, behavior, channel, ts; `error` takes the uninstall role."""
        # The four channels.
        channels = F.array(*(F.lit(c) for c in ("appstore", "huaweiStore", "weibo", "wechat")))
        return self.events().select(
            F.col("user_id").cast("string").alias("user_id"),
            F.col("event_type").alias("behavior"),
            channels[(_k() % 4).cast("int")].alias("channel"),
            "ts",
        )

    def ad_clicks(self) -> DataFrame:
        """Ad clicks: event_id, user_id, ad_id, province, ts."""
        # Five of the provinces.
        provinces = F.array(*(F.lit(p) for p in ("beijing", "shanghai", "guangdong", "zhejiang", "jiangsu")))
        return self.events().filter(F.col("event_type") == "click").select(
            "event_id",
            "user_id",
            (_k() % 5).alias("ad_id"),
            provinces[(F.col("user_id") % 5).cast("int")].alias("province"),
            "ts",
        )

    def logins(self) -> DataFrame:
        """Logins: event_id, user_id, event_type (`fail` / `success`), ts."""
        outcome = F.when(F.col("event_type") == "error", "fail").otherwise("success")
        return self.events().select("event_id", "user_id", outcome.alias("event_type"), "ts")

    def order_events(self) -> DataFrame:
        """Orders as create events, all their shipments as pay events."""
        creates = self.table("orders", ORDERS_SCHEMA).select(
            F.col("o_orderkey").alias("order_id"),
            F.lit("create").alias("event_type"),
            F.col("o_orderdate").cast("timestamp").alias("ts"),
            F.lit(0).alias("seq"),
        )
        pays = self.table("lineitem", LINEITEM_SCHEMA).select(
            F.col("l_orderkey").alias("order_id"),
            F.lit("pay").alias("event_type"),
            F.col("l_shipdate").cast("timestamp").alias("ts"),
            F.lit(1).alias("seq"),
        )
        return creates.unionByName(pays)

    def pays(self) -> DataFrame:
        return self._side("click", "pay_id")

    def receipts(self) -> DataFrame:
        return self._side("purchase", "receipt_id")

    def _side(self, event_type: str, id_name: str) -> DataFrame:
        rows = self.events().filter(F.col("event_type") == event_type)
        return rows.select(F.col("event_id").alias(id_name), F.col("user_id").alias("tx_id"), "ts")


def arrival_number(event_id: Column) -> Column:
    """Reorders numbers within blocks of 97 by multiplication modulo 97."""
    offset = event_id % 97
    return event_id - offset + offset * 31 % 97


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def _text(column: Column) -> Column:
    return column.cast("string")
