"""Input and output schemas."""

from pyspark.sql import types as T

_MAP = T.MapType(T.StringType(), T.StringType())


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# Change record of the operational database; ts is in epoch seconds.
ENVELOPE = T.StructType([
    *_strings("database", "table", "type"),
    T.StructField("ts", T.LongType()),
    T.StructField("data", _MAP),
    T.StructField("old", _MAP),
])

# The fields of a page log that the summary jobs read; ts is in epoch milliseconds.
PAGE_LOG = T.StructType([
    T.StructField("common", T.StructType(_strings("mid", "uid", "sid", "vc", "ch", "ar", "is_new"))),
    T.StructField("page", T.StructType([
        *_strings("page_id", "last_page_id", "item", "item_type"),
        T.StructField("during_time", T.LongType()),
    ])),
    T.StructField("ts", T.LongType()),
])

DIM_CONFIG = T.StructType(_strings("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key"))
FACT_CONFIG = T.StructType(_strings("source_table", "source_type", "sink_table", "sink_columns"))


def config_change(config: T.StructType) -> T.StructType:
    """Change feed of a configuration table: op is c, r, u or d."""
    return T.StructType([
        T.StructField("op", T.StringType()),
        T.StructField("before", config),
        T.StructField("after", config),
    ])


# Column order of the detail tables. They must equal the published table layouts.
COMMENT = ["id", "user_id", "nick_name", "sku_id", "spu_id", "order_id", "appraise", "dic_name", "comment_txt",
           "create_time"]
CART_ADD = ["id", "user_id", "sku_id", "cart_price", "sku_num", "sku_name", "is_checked", "create_time",
            "operate_time", "is_ordered", "order_time", "ts"]
ORDER_DETAIL = ["id", "order_id", "sku_id", "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
                "sku_name", "order_price", "sku_num", "create_time", "split_total_amount", "split_activity_amount",
                "split_coupon_amount", "ts"]
ORDER_CANCEL = ["id", "order_id", "sku_id", "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
                "sku_name", "order_price", "sku_num", "create_time", "operate_time", "split_total_amount",
                "split_activity_amount", "split_coupon_amount", "ts"]
PAYMENT = ["id", "order_id", "sku_id", "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
           "sku_name", "order_price", "sku_num", "split_total_amount", "split_activity_amount", "split_coupon_amount",
           "payment_type_code", "payment_type_name", "payment_time", "ts"]
REFUND_ORDER = ["id", "user_id", "order_id", "sku_id", "province_id", "date_id", "create_time", "refund_type_code",
                "refund_type_name", "refund_reason_type_code", "refund_reason_type_name", "refund_reason_txt",
                "refund_num", "refund_amount", "ts"]
REFUND_PAYMENT = ["id", "user_id", "order_id", "sku_id", "province_id", "payment_type_code", "payment_type_name",
                  "date_id", "callback_time", "refund_num", "refund_amount", "ts"]

# The order-detail topic read back as a table: every column but ts is a string.
ORDER_DETAIL_TOPIC = T.StructType([*_strings(*ORDER_DETAIL[:-1]), T.StructField("ts", T.LongType())])

# Status codes. They must equal the codes found in the operational database.
ORDER_UNPAID = "1001"
ORDER_CANCELLED = "1003"
ORDER_REFUNDING = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_DONE = "1602"
REFUND_DONE = "0705"

MONEY = T.DecimalType(20, 2)
