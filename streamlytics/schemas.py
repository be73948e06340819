"""Record schemas of the reference (§1 of the survey) as Spark DDL, in file column
order. Times in the files are epoch seconds (marketing: milliseconds)."""

# The positional layouts of the reference's input records.
USER_BEHAVIOR = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, event_time BIGINT"
LOGIN_EVENT = "user_id BIGINT, ip STRING, event_type STRING, event_time BIGINT"
ORDER_EVENT = "order_id BIGINT, event_type STRING, tx_id STRING, event_time BIGINT"
RECEIPT_EVENT = "tx_id STRING, pay_channel STRING, event_time BIGINT"
AD_CLICK = "user_id BIGINT, ad_id BIGINT, province STRING, city STRING, event_time BIGINT"
MARKETING_EVENT = "user_id BIGINT, behavior STRING, channel STRING, event_time BIGINT"

# unit of event_time per record kind (seconds unless noted)
TIME_UNIT = {"marketing": "ms"}

SCHEMAS = {
    "user_behavior": USER_BEHAVIOR,
    "login": LOGIN_EVENT,
    "order": ORDER_EVENT,
    "receipt": RECEIPT_EVENT,
    "ad_click": AD_CLICK,
    "marketing": MARKETING_EVENT,
}
