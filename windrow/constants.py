"""Names, defaults, patterns, lengths and texts that results depend on.

They are the defaults of the operators' parameters; callers may pass others.
"""

# --- behaviour log -----------------------------------------------------------------------------
BEHAVIOR_FIELDS = ("userId", "itemId", "categoryId", "behavior", "timestamp")
PAGE_VIEW = "pv"

# --- topic messages ----------------------------------------------------------------------------
# output field -> (JSON key, default when the key is absent or null)
STATE_EVENT_KEYS = {
    "time": ("pos", "0"),
    "id": ("RAWID", "Null"),
    "old_state": ("OLD_STATE", "Null"),
    "new_state": ("NEW_STATE", "Null"),
    "eqp_id": ("RSD_02", "Null"),
}
PASSING_RECORD_KEYS = {
    "passingTime": ("pos", "0L"),
    "plateNo": ("RAWID", "Null"),
}
# textual rewrite of a null that is followed directly by a comma
NULL_BEFORE_COMMA = ":null,"
QUOTED_NULL_BEFORE_COMMA = ':"null",'

# --- tokenizers --------------------------------------------------------------------------------
WHITESPACE = r"\s"
LINE_SEPARATOR = r"\\N+"
NON_WORD = r"\W+"

# --- windows -----------------------------------------------------------------------------------
HOT_ITEMS_WINDOW = "60 minutes"
HOT_ITEMS_SLIDE = "5 minutes"
HOT_ITEMS_TOP = 3
STATE_EVENT_WINDOW = "10 seconds"
PASSING_RECORD_WINDOW = "60 seconds"
WORD_COUNT_WINDOW = "5 seconds"

# --- sinks -------------------------------------------------------------------------------------
MINUTE_BUCKET = "yyyy-MM-dd--HHmm"
DAY_BUCKET = "yyyy-MM-dd"
BUCKET_ZONE = "Asia/Shanghai"
ROLL_BYTES = 400 * 1024 * 1024
STATE_TEXT_ROLL_INTERVAL = "1 minute"
MESSAGE_LOG_ROLL_INTERVAL = "10 minutes"

# --- recovery: how often progress is made durable ----------------------------------------------
MESSAGE_CHECKPOINT_INTERVAL = "1 second"
PASSING_RECORD_CHECKPOINT_INTERVAL = "5 seconds"
STATE_EVENT_CHECKPOINT_INTERVAL = "10 seconds"

# --- top-N text report -------------------------------------------------------------------------
REPORT_RULE = "====================================="
REPORT_TIME_LABEL = "时间： "
REPORT_RANK_LABEL = "No"
REPORT_ITEM_LABEL = ":  商品ID="
REPORT_COUNT_LABEL = "  浏览量="
