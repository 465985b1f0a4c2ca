"""Bronze layer: typed transport metadata + raw envelope text, row guards.

The envelope is parsed once per row with ``from_json`` into a struct whose
leaves are strings (see ``schemas.ENVELOPE_SCHEMA``); downstream layers
``try_cast`` the leaves they need.  The observed row guards fence the parse, so
Catalyst does not prune its schema; what needs the two instants alone (the
published table, the monitor) parses with ``schemas.TIMES_SCHEMA``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.functions.columns import tcast, to_ts
from linkflow.operators.quality import expectation_report, guard
from linkflow.schemas import ENVELOPE_SCHEMA, TIMES_SCHEMA

ENV = "env"

BRONZE_COLUMNS = (
    "topic", "partition", "offset", "kafka_timestamp_raw", "kafka_key",
    "value_str", "dumped_at", "ingested_at", "interval_start",
)


def value_text(dump: DataFrame) -> Column:
    """Envelope text of a landed message: the parsed ``value_json`` object
    when present, else the raw ``value`` (both shapes of a dump line)."""
    if "value_json" in dump.columns:
        return F.coalesce(F.col("value_json").cast("string"), F.col("value").cast("string"))
    return F.col("value").cast("string")


def bronze_columns(dump: DataFrame, schema=ENVELOPE_SCHEMA) -> DataFrame:
    """Bronze projection plus the parsed envelope struct ``env``."""
    vs = value_text(dump)
    env = F.from_json(vs, schema)
    return dump.select(
        F.col("topic").cast("string").alias("topic"),
        tcast("partition", "int").alias("partition"),
        tcast("offset", "bigint").alias("offset"),
        F.col("timestamp").cast("string").alias("kafka_timestamp_raw"),
        F.col("key").cast("string").alias("kafka_key"),
        vs.alias("value_str"),
        to_ts(F.col("dumped_at").cast("string")).alias("dumped_at"),
        env.alias(ENV),
    ).select(
        *[c for c in ("topic", "partition", "offset", "kafka_timestamp_raw", "kafka_key",
                      "value_str", "dumped_at")],
        to_ts(F.col(f"{ENV}.ingested_at")).alias("ingested_at"),
        to_ts(F.col(f"{ENV}.payload.latest_stats.interval_start")).alias("interval_start"),
        ENV,
    )


def bronze_rules() -> dict[str, Column]:
    return {
        "valid_partition": F.col("partition") >= 0,
        "valid_offset": F.col("offset") >= 0,
        "non_null_topic": F.col("topic").isNotNull(),
        "non_null_value_str": F.col("value_str").isNotNull(),
    }


def bronze_parsed(dump: DataFrame, null_passes: bool = False, schema=ENVELOPE_SCHEMA) -> DataFrame:
    """Guarded bronze rows with the parsed envelope kept for later layers."""
    return guard(bronze_columns(dump, schema), bronze_rules(), "bronze_expectations", null_passes)


def bronze(dump: DataFrame, null_passes: bool = False) -> DataFrame:
    """The published bronze table (9 columns)."""
    return bronze_parsed(dump, null_passes, TIMES_SCHEMA).select(*BRONZE_COLUMNS)


P = f"{ENV}.payload"
LS = f"{ENV}.payload.latest_stats"

# Internal flat form of bronze: every field a later layer reads, typed
# once.  silver, the dimension, the fact and the monitor select from it, so
# the envelope is parsed once per row however many layers use it.
TYPED_COLUMNS = (
    "topic", "partition", "offset", "kafka_key", "dumped_at", "ingested_at", "interval_start",
    "has_link_id", "link_id", "href", "road_name", "public_name", "direction", "enabled", "draft",
    "length_m", "min_number_of_lanes", "minimum_tt_seconds", "is_freeway", "origin_site_id",
    "destination_site_id", "coordinates_json",
    "travel_time_seconds", "delay_seconds", "speed_kmh",
    "enough_data", "ignored", "closed", "expected_missing",
    "density", "average_density", "congestion_score", "estimated_percent",
)


def typed(bronze_env: DataFrame) -> DataFrame:
    """Flat typed columns from guarded bronze rows with a parsed envelope
    (``try_cast`` of each JSON leaf, i.e. ``CAST(get_json_object(...))``)."""
    return bronze_env.select(
        "topic", "partition", "offset", "kafka_key", "dumped_at", "ingested_at", "interval_start",
        F.col(f"{P}.id").isNotNull().alias("has_link_id"),
        tcast(f"{P}.id", "int").alias("link_id"),
        F.col(f"{P}.href").alias("href"),
        F.col(f"{P}.name").alias("road_name"),
        F.col(f"{P}.public_name").alias("public_name"),
        F.col(f"{P}.direction").alias("direction"),
        tcast(f"{P}.enabled", "boolean").alias("enabled"),
        tcast(f"{P}.draft", "boolean").alias("draft"),
        tcast(f"{P}.length", "double").alias("length_m"),
        tcast(f"{P}.min_number_of_lanes", "int").alias("min_number_of_lanes"),
        tcast(f"{P}.minimum_tt", "double").alias("minimum_tt_seconds"),
        tcast(f"{P}.is_freeway", "boolean").alias("is_freeway"),
        tcast(f"{P}.origin.id", "bigint").alias("origin_site_id"),
        tcast(f"{P}.destination.id", "bigint").alias("destination_site_id"),
        F.col(f"{P}.coordinates").alias("coordinates_json"),
        tcast(f"{LS}.travel_time", "double").alias("travel_time_seconds"),
        tcast(f"{LS}.delay", "double").alias("delay_seconds"),
        tcast(f"{LS}.speed", "double").alias("speed_kmh"),
        tcast(f"{LS}.enough_data", "boolean").alias("enough_data"),
        tcast(f"{LS}.ignored", "boolean").alias("ignored"),
        tcast(f"{LS}.closed", "boolean").alias("closed"),
        tcast(f"{LS}.expected_missing", "boolean").alias("expected_missing"),
        tcast(f"{LS}.density", "double").alias("density"),
        tcast(f"{LS}.average_density", "double").alias("average_density"),
        tcast(f"{LS}.congestion", "double").alias("congestion_score"),
        tcast(f"{LS}.estimated_percent", "double").alias("estimated_percent"),
    )


def bronze_typed(dump: DataFrame, null_passes: bool = False) -> DataFrame:
    """Guarded bronze of a dump, in the flat typed form."""
    return typed(bronze_parsed(dump, null_passes))


def typed_from_table(bronze_table: DataFrame) -> DataFrame:
    """Flat typed form of a published bronze table (parses ``value_str``)."""
    return typed(bronze_table.withColumn(ENV, F.from_json("value_str", ENVELOPE_SCHEMA)))


def bronze_expectations(dump: DataFrame, null_passes: bool = False) -> DataFrame:
    """``rule, violations, kept`` for the bronze row guards."""
    return expectation_report(bronze_columns(dump, TIMES_SCHEMA).drop(ENV), bronze_rules(), null_passes)
