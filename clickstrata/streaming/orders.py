"""Order-stream lines: visits (314), orders (316), order details (317), clicks (319)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import null_if_blank

# Field positions of each line type, minimum field counts and status codes.
VISIT_FIELDS = {"time": 1, "code": 2, "msg": 3, "template_id": 4, "carrier": 33}
ORDER_FIELDS = {
    "time": 1, "order_id": 3, "template_id": 4, "cart_no": 5, "buyer_name": 6, "mobile_phone": 7, "receiver_prov": 8,
    "receiver_city": 9, "receiver_district": 10, "receiver_address": 11, "plan_id": 12, "creative_id": 13, "channel_id": 16,
    "combo_type": 17, "order_mobile_phone": 18, "source_type": 19, "flow_type": 20, "pid": 22, "eid": 23, "ip": 24,
    "carrier": 33, "click_id": 37, "platform_order_id": 43, "aid": 47,
}
DETAIL_FIELDS = {
    "time": 1, "order_id": 2, "order_status": 3, "other_status": 4, "send_no": 5, "logistics_name": 6, "logistics_status": 7,
    "order_status_desc": 9, "is_last_invest": 10, "is_invest": 11, "etype": 12, "status_update_time": 16, "carrier": 18,
}
CLICK_FIELDS = {"time": 1, "click_id": 9, "plan_id": 11, "creative_id": 13}
MIN_FIELDS = {"314": 34, "316": 48, "317": 19, "319": 23}
ACTIVATED = "AC002"
SIGNED = "10"
CARRIER_WITH_TIME, CARRIER_TIME_FIELD = "1", 17


def _fields(df: DataFrame, code: str, value: str) -> DataFrame:
    arr = df.select(F.split(value, "\t", -1).alias("f"))
    type_ok = F.get("f", F.lit(0)).startswith(code) if code == "319" else F.get("f", F.lit(0)) == code
    return arr.where(type_ok & (F.size("f") >= MIN_FIELDS[code]))


def _pick(layout: dict[str, int]) -> list[Column]:
    return [null_if_blank(F.get("f", F.lit(i))).alias(n) for n, i in layout.items() if n != "time"]


def _seconds() -> Column:
    return F.get("f", F.lit(1)).try_cast("bigint")


def parse_visits(df: DataFrame, value: str = "value") -> DataFrame:
    """Visit lines with event time ``ts``."""
    return _fields(df, "314", value).select(F.timestamp_seconds(_seconds()).alias("ts"), *_pick(VISIT_FIELDS)).where(F.col("ts").isNotNull())


def parse_orders(df: DataFrame, value: str = "value") -> DataFrame:
    """Order lines; blanks become null, lines without an order id are dropped."""
    return (
        _fields(df, "316", value)
        .select(_seconds().alias("time"), F.timestamp_seconds(_seconds()).alias("ts"), *_pick(ORDER_FIELDS))
        .where(F.col("order_id").isNotNull())
    )


def parse_details(df: DataFrame, value: str = "value") -> DataFrame:
    """Order details with the times their statuses imply.

    Activation: status AC002 gives the line's time, carrier 1 the time in its own
    field.  Recharge flags equal to 1 and the signed status give the line's time.
    """
    rows = _fields(df, "317", value).select("f", F.timestamp_seconds(_seconds()).alias("_ts"), *_pick(DETAIL_FIELDS))
    time = F.date_format("_ts", "yyyy-MM-dd HH:mm:ss")
    own_time = null_if_blank(F.get("f", F.lit(CARRIER_TIME_FIELD)))
    active = F.when(F.col("carrier") == CARRIER_WITH_TIME, own_time).when(F.col("other_status") == ACTIVATED, time)
    return rows.where(F.col("order_id").isNotNull()).select(
        *[n for n in DETAIL_FIELDS if n != "time"], active.alias("active_time"),
        F.when(F.col("is_last_invest") == "1", time).alias("last_invest_time"),
        F.when(F.col("is_invest") == "1", time).alias("invest_time"),
        F.when(F.col("logistics_status") == SIGNED, time).alias("sign_time"),
    )


def parse_clicks(df: DataFrame, value: str = "value") -> DataFrame:
    """Click lines that carry a click id and a plan or a creative."""
    rows = _fields(df, "319", value).select(F.timestamp_seconds(_seconds()).alias("ts"), *_pick(CLICK_FIELDS))
    return rows.where(F.col("click_id").isNotNull() & (F.col("plan_id").isNotNull() | F.col("creative_id").isNotNull()))


def blank_preserving_updates(df: DataFrame, key: str, order: str) -> DataFrame:
    """One update per key from a batch: the last non-blank value of each column by ``order``.

    Feed the result to a ``keep_blank`` merge to update only what an update carries.
    """
    cols = [c for c in df.columns if c not in (key, order)]
    return df.groupBy(key).agg(*[
        F.max(F.when(null_if_blank(c).isNotNull(), F.struct(F.col(order).alias("o"), F.col(c).alias("v")))).getField("v").alias(c)
        for c in cols
    ], F.max(order).alias(order))
