"""Silver layers: typed measurements, live-record filter, derived measures.

Input is ``bronze.typed`` (guarded bronze rows, fields typed once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkflow.functions.columns import null_safe_div
from linkflow.operators.latest import first_by, latest_by
from linkflow.operators.quality import expect, expectation_report

# Unit factor and thresholds of the derived measures.
MS_TO_KMH = 3.6
INCIDENT_RATIO = 0.7
CONGESTION_RATIO = 0.3
STRICT_MIN_DELAY_SECONDS = 60.0

EXTRACT_COLUMNS = (
    "link_id", "road_name", "enabled", "draft", "interval_start",
    "travel_time_seconds", "delay_seconds", "speed_kmh", "enough_data",
    "ignored", "closed", "expected_missing", "length_m", "minimum_tt_seconds",
)

# Flags that take a record out of the live set when TRUE.
HIDING_FLAGS = ("draft", "ignored", "closed", "expected_missing")

SILVER_COLUMNS = EXTRACT_COLUMNS + (
    "dumped_at", "travel_time_minutes", "free_flow_speed_kmh", "potential_incident",
)

DEDUP_COLUMNS = tuple(c for c in SILVER_COLUMNS if c != "dumped_at")

# Carried along (not published by silver) so later layers need no re-parse.
PROVIDER_METRICS = ("density", "average_density", "congestion_score", "estimated_percent")
TRANSPORT_ID = ("topic", "partition", "offset")


def extract(typed: DataFrame) -> DataFrame:
    """The 14 typed silver fields, plus transport id, dumped_at, ingested_at,
    public_name and the four provider metrics (from ``bronze.typed``)."""
    return typed.select(*EXTRACT_COLUMNS, "dumped_at", "ingested_at", *TRANSPORT_ID, "public_name",
                        *PROVIDER_METRICS)


def live_filter(df: DataFrame) -> DataFrame:
    """enabled is TRUE and none of draft/ignored/closed/expected_missing is
    TRUE (NULL counts as FALSE there; a NULL ``enabled`` is dropped)."""
    live = F.col("enabled")
    for flag in HIDING_FLAGS:
        live = live & ~F.col(flag).eqNullSafe(True)
    return df.filter(live)


def free_flow_speed_kmh() -> Column:
    return null_safe_div(F.col("length_m"), F.col("minimum_tt_seconds")) * F.lit(MS_TO_KMH)


def potential_incident(unit_fix: bool = False) -> Column:
    """TRUE when speed is below 70 % of free flow and (by default, as
    published) also below length/minimum_tt, which is in m/s; never NULL."""
    speed, tt, length = F.col("speed_kmh"), F.col("minimum_tt_seconds"), F.col("length_m")
    cond = (speed.isNotNull() & (tt > 0) & length.isNotNull()
            & (speed < F.lit(INCIDENT_RATIO) * F.col("free_flow_speed_kmh")))
    if not unit_fix:
        cond = cond & (speed < null_safe_div(length, tt))
    return F.when(cond, F.lit(True)).otherwise(F.lit(False))


def derive(df: DataFrame, unit_fix: bool = False) -> DataFrame:
    return (
        df.withColumn("travel_time_minutes", F.col("travel_time_seconds") / F.lit(60.0))
          .withColumn("free_flow_speed_kmh", free_flow_speed_kmh())
          .withColumn("potential_incident", potential_incident(unit_fix))
    )


def silver_rules() -> dict[str, Column]:
    return {
        "non_null_interval_start": F.col("interval_start").isNotNull(),
        "valid_travel_time": F.col("travel_time_seconds") >= 0,
        "valid_speed": F.col("speed_kmh") >= 0,
        "valid_length": F.col("length_m") > 0,
    }


def silver_wide(typed: DataFrame, unit_fix: bool = False, null_passes: bool = False) -> DataFrame:
    """Silver rows with the carried columns (transport id, metrics)."""
    return expect(derive(live_filter(extract(typed)), unit_fix), silver_rules(), null_passes)


def silver(typed: DataFrame, unit_fix: bool = False, null_passes: bool = False) -> DataFrame:
    """Published silver: 18 columns (+ offset, the transport id)."""
    return silver_wide(typed, unit_fix, null_passes).select(*SILVER_COLUMNS, "offset")


def silver_expectations(typed: DataFrame, null_passes: bool = False) -> DataFrame:
    """``rule, violations`` of the silver row guards over live records."""
    return expectation_report(derive(live_filter(extract(typed))), silver_rules(),
                              null_passes, with_kept=False)


def silver_dedup_wide(silver_w: DataFrame) -> DataFrame:
    """Latest record per (link_id, interval_start) by dumped_at, ties broken
    by transport id; arrival order does not matter (SCD type 1)."""
    return latest_by(silver_w, ["link_id", "interval_start"], ["dumped_at", *TRANSPORT_ID])


def silver_dedup(silver_w: DataFrame) -> DataFrame:
    """Published de-duplicated silver: 17 columns (dumped_at excluded)."""
    return silver_dedup_wide(silver_w).select(*DEDUP_COLUMNS)


def congestion_flag() -> Column:
    """The share of free flow that is driven is below 30 %; an unknown share is not."""
    slow = F.col("speed_kmh") < F.col("free_flow_speed_kmh") * CONGESTION_RATIO
    return F.coalesce(slow, F.lit(False))


def silver_strict(typed: DataFrame) -> DataFrame:
    """Strict live records: live filter, enough_data TRUE, delay > 60 s;
    road_name falls back to public_name, event_time to ingested_at."""
    df = extract(typed)
    df = df.withColumn("road_name", F.coalesce("road_name", "public_name"))
    df = live_filter(df).filter(
        (F.col("enough_data") == F.lit(True))
        & (F.col("delay_seconds") > F.lit(STRICT_MIN_DELAY_SECONDS))
    )
    df = derive(df).withColumn("congestion_flag", congestion_flag())
    return df.withColumn("event_time", F.coalesce("interval_start", "ingested_at"))


STRICT_COLUMNS = ("link_id", "road_name", "event_time", "delay_seconds", "offset")


def silver_strict_dedup(strict: DataFrame) -> DataFrame:
    """First arrival per (link_id, interval_start): batch form of
    ``dropDuplicates``, made deterministic by (dumped_at, transport id)."""
    cols = [c for c in strict.columns if c not in ("link_id", "interval_start")]
    return first_by(strict, ["link_id", "interval_start"], ["dumped_at", *TRANSPORT_ID], cols)
