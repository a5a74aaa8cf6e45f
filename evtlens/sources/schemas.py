"""Record schemas (fixed, no inference). Seconds-based inputs keep the raw epoch
seconds in ``ts_sec``/``ts_ms`` and get an event-time ``ts`` TIMESTAMP column on read."""

from pyspark.sql.types import (
    BooleanType, IntegerType, LongType, StringType, StructField, StructType, TimestampType,
)


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# raw text layouts (column order = file order)
USER_BEHAVIOR_CSV = _s(("user_id", LongType()), ("item_id", LongType()), ("category_id", IntegerType()),
                       ("behavior", StringType()), ("ts_sec", LongType()))
AD_CLICK_CSV = _s(("user_id", LongType()), ("ad_id", LongType()), ("province", StringType()),
                  ("city", StringType()), ("ts_sec", LongType()))
LOGIN_CSV = _s(("user_id", LongType()), ("ip", StringType()), ("login_state", StringType()),
               ("ts_sec", LongType()))
ORDER_EVENT_CSV = _s(("order_id", LongType()), ("event_type", StringType()), ("tx_id", StringType()),
                     ("ts_sec", LongType()))
RECEIPT_CSV = _s(("tx_id", StringType()), ("pay_channel", StringType()), ("ts_sec", LongType()))
MARKETING = _s(("user_id", LongType()), ("behavior", StringType()), ("channel", StringType()),
               ("ts_ms", LongType()))

# parsed records (event time as TIMESTAMP)
USER_BEHAVIOR = _s(("user_id", LongType()), ("item_id", LongType()), ("category_id", IntegerType()),
                   ("behavior", StringType()), ("ts", TimestampType()))
APACHE_LOG = _s(("ip", StringType()), ("user_id", StringType()), ("ts", TimestampType()),
                ("method", StringType()), ("url", StringType()))

# outputs
ITEM_VIEW_COUNT = _s(("item_id", LongType()), ("window_end", LongType()), ("cnt", LongType()))
PAGE_VIEW_COUNT = _s(("url", StringType()), ("window_end", LongType()), ("cnt", LongType()))
LOGIN_FAIL_WARNING = _s(("user_id", LongType()), ("first_fail_time", LongType()),
                        ("last_fail_time", LongType()), ("warning_msg", StringType()))
ORDER_RESULT = _s(("order_id", LongType()), ("result_state", StringType()))
BLACKLIST_WARNING = _s(("user_id", LongType()), ("ad_id", LongType()), ("warning_msg", StringType()))
FLAG = BooleanType()
