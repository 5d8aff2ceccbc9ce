"""Fixed values that must equal the reference's for equal results."""

# Topic names.
STARTUP_TOPIC = "startup_topic"
EVENT_TOPIC = "event_topic"
DEAD_TOPIC = "dead_letter_topic"
ORDER_INFO_TOPIC = "order_info_topic"
ORDER_DETAIL_TOPIC = "order_detail_topic"

# Event ids the alert rule looks at.
COUPON = "coupon"
CLICK_ITEM = "clickItem"

# Alert rule parameters (window 5 min, slide 5 s, >= 3 uids,
# documents deduplicated per minute).
ALERT_WINDOW = "5 minutes"
ALERT_SLIDE = "5 seconds"
ALERT_MIN_UIDS = 3
ALERT_DOC_BUCKET_MS = 60_000

# Join buffer lifetime (both sides), 30 * 60 seconds.
JOIN_TTL = "30 minutes"

# Age uses 365-day years of milliseconds.
MS_PER_YEAR = 1000 * 60 * 60 * 24 * 365

# Change feed subscription (a parameter) and, as fixed values, tables and row event type.
CDC_SUBSCRIPTION = r"shop\..*"
CDC_TABLE_TOPICS = {"order_info": ORDER_INFO_TOPIC, "order_detail": ORDER_DETAIL_TOPIC}
CDC_INSERT = "INSERT"
CDC_ROWDATA = "ROWDATA"

# KPI list rows (id, display name); new_mid is a constant 233.
KPI_DAU = ("dau", "新增日活")
KPI_NEW_MID = ("new_mid", "新增设备")
KPI_NEW_MID_VALUE = "233"
KPI_ORDER_AMOUNT = ("order_amount", "新增交易额")

APP_ID = "shop"
