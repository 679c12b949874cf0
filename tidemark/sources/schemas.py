"""Record layouts. Times are epoch seconds in the files and `timestamp` columns afterwards."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()

USER_BEHAVIOR = _schema(user_id=LONG, item_id=LONG, category_id=INT, behavior=TEXT, ts=LONG)
MARKETING = _schema(user_id=TEXT, behavior=TEXT, channel=TEXT, ts=LONG)
AD_CLICK = _schema(user_id=LONG, ad_id=LONG, province=TEXT, city=TEXT, ts=LONG)
LOGIN = _schema(user_id=LONG, ip=TEXT, event_type=TEXT, ts=LONG)
ORDER = _schema(order_id=LONG, event_type=TEXT, tx_id=TEXT, ts=LONG)
RECEIPT = _schema(tx_id=TEXT, pay_channel=TEXT, ts=LONG)
