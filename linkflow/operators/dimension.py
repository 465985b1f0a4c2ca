"""Link dimension: latest observed metadata per link (SCD type 1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.operators.latest import latest_by

DIM_COLUMNS = (
    "link_id", "href", "name", "public_name", "direction", "enabled", "draft",
    "length_m", "min_number_of_lanes", "minimum_tt_seconds", "is_freeway",
    "origin_site_id", "destination_site_id", "coordinates_json", "last_seen_at",
)


def dim_link(typed: DataFrame) -> DataFrame:
    """One row per link id: metadata of its most recently landed record
    (ties broken by transport id).  Records without a payload id are
    skipped; coordinates stay JSON text."""
    rows = typed.filter(F.col("has_link_id")).select(
        *[F.col("road_name").alias("name") if c == "name" else F.col("dumped_at").alias("last_seen_at")
          if c == "last_seen_at" else F.col(c) for c in DIM_COLUMNS],
        "topic", "partition", "offset",
    )
    latest = latest_by(rows, ["link_id"], ["last_seen_at", "topic", "partition", "offset"])
    return latest.select(*DIM_COLUMNS)
