"""Declared schemas of the message dump, the envelope and the offsets table."""

from pyspark.sql import types as T

# One landed message (a JSON line of the dump, or a row of an uploaded
# table).  ``value_json`` is read as text: a string schema keeps the raw
# JSON of the parsed envelope object.
DUMP_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.StringType()),
    T.StructField("offset", T.StringType()),
    T.StructField("timestamp", T.ArrayType(T.LongType())),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("value_json", T.StringType()),
    T.StructField("dumped_at", T.StringType()),
])

# Typed form of the same record once read from a typed source.
DUMP_TYPED_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.ArrayType(T.LongType())),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("value_json", T.StringType()),
    T.StructField("dumped_at", T.StringType()),
])


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


# Envelope as read from JSON text.  Leaves are strings on purpose: a string
# leaf keeps the JSON token text (numbers, booleans, nested objects as
# compact JSON), so a later ``try_cast`` behaves like ``CAST(get_json_object
# (...))`` -- e.g. the text ``"false"`` still casts to boolean false.
LATEST_STATS_FIELDS = (
    "interval_start", "travel_time", "delay", "speed",
    "density", "average_density", "congestion", "estimated_percent",
    "enough_data", "ignored", "closed", "expected_missing",
)

PAYLOAD_SCHEMA = T.StructType(
    _strings("id", "href", "name", "public_name", "direction", "enabled",
             "draft", "length", "minimum_tt", "min_number_of_lanes",
             "is_freeway")
    + [
        T.StructField("origin", T.StructType(_strings("id"))),
        T.StructField("destination", T.StructType(_strings("id"))),
        T.StructField("coordinates", T.StringType()),
        T.StructField("latest_stats", T.StructType(_strings(*LATEST_STATS_FIELDS))),
    ]
)

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("ingested_at", T.StringType()),
    T.StructField("source", T.StructType(_strings("type", "url"))),
    T.StructField("payload", PAYLOAD_SCHEMA),
])

# The leaves that the published bronze table and the monitor read.
TIMES_SCHEMA = T.StructType([
    T.StructField("ingested_at", T.StringType()),
    T.StructField("payload", T.StructType([T.StructField("latest_stats", T.StructType(_strings("interval_start")))])),
])

# Broker offsets per partition (for consumer lag).
OFFSETS_SCHEMA = T.StructType([
    T.StructField("partition", T.IntegerType()),
    T.StructField("begin_offset", T.LongType()),
    T.StructField("end_offset", T.LongType()),
    T.StructField("committed_offset", T.LongType()),
])

# Columns of the flat local observation row (19 columns).
OBSERVATION_COLUMNS = (
    "topic", "partition", "offset", "key", "dumped_at", "ingested_at",
    "interval_start", "link_id", "road_name", "travel_time_seconds",
    "delay_seconds", "speed_kmh", "length_m", "minimum_tt_seconds",
    "enough_data", "ignored", "closed", "expected_missing", "payload_json",
)
