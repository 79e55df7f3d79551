"""Row types, vocabularies and default thresholds."""

from pyspark.sql import types as T

FLOW_SCHEMA = T.StructType(
    [
        T.StructField("timestamp", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("src_port", T.IntegerType()),
        T.StructField("dst_port", T.IntegerType()),
        T.StructField("protocol", T.StringType()),
        T.StructField("packet_count", T.IntegerType()),
        T.StructField("byte_count", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("flag", T.StringType()),
        T.StructField("label", T.StringType()),
    ]
)

# The union of everything any writer of alerts may set; absent fields are NULL.
ALERT_SCHEMA = T.StructType(
    [
        T.StructField("alert_id", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("src_ip", T.StringType()),
        T.StructField("dst_ip", T.StringType()),
        T.StructField("attack_type", T.StringType()),
        T.StructField("metric_count", T.LongType()),
        T.StructField("threshold", T.IntegerType()),
        T.StructField("window_type", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("details", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("mitigation_action", T.StringType()),
        T.StructField("resolved_at", T.StringType()),
        T.StructField("resolution_notes", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
    ]
)

# Known attack intervals over a numbered event sequence. `attack_no` is the
# list order: where intervals overlap, the lowest number owns the event.
ATTACK_SCHEMA = T.StructType(
    [
        T.StructField("attack_no", T.LongType()),
        T.StructField("type", T.StringType()),
        T.StructField("ip", T.StringType()),
        T.StructField("start_idx", T.LongType()),
        T.StructField("duration", T.LongType()),
    ]
)

# Fixed values.
TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
# Read forms: optional fraction of a second, optional offset (`Z` or hours and minutes).
TIMESTAMP_FORMS = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]"
UNKNOWN_SOURCE = "UNKNOWN"
BENIGN = "BENIGN"
PROBE_LABELS = ("DDoS_FLOOD", "PORT_SCAN", "BRUTE_FORCE")
AUTH_PORTS = (21, 22, 3306)
FLOOD_THRESHOLD = 60
SCAN_THRESHOLD = 12
BRUTE_FORCE_THRESHOLD = 25
FLOOD_SECONDS = 10
SLIDING_SECONDS = 30
SLIDE_SECONDS = 5
ALERTS_KEPT = 500
