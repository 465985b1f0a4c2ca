"""Interval fact table: de-duplicated silver + link dimension + bronze.

Two join modes:

* ``bronze_match="all"`` (published semantics): every bronze row sharing the
  natural key (link_id, interval_start) is joined, so re-polled intervals
  fan out.  Planned as an inner join plus an anti-join for keys without any
  bronze row, which equals the left join but lets AQE split a hot key on the
  bronze side (a left outer join can only split its preserved side).  The
  anti-join only reads bronze's distinct keys (partial aggregation first).
* ``bronze_match="latest"``: only the winning record of the key, carried
  through silver, so no bronze join and no fan-out.

The dimension is one row per link; the plan does not force a broadcast --
AQE measures the dimension's shuffle output and switches to a broadcast
join only below ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.functions.columns import epoch_seconds
from linkflow.operators.silver import PROVIDER_METRICS

FACT_COLUMNS = (
    "link_id", "interval_start",
    "travel_time_seconds", "delay_seconds", "speed_kmh",
    "density", "average_density", "congestion_score", "estimated_percent",
    "enough_data", "ignored", "closed", "expected_missing",
    "travel_time_minutes", "free_flow_speed_kmh", "potential_incident",
    "road_name", "direction", "is_freeway", "length_m", "minimum_tt_seconds",
    "origin_site_id", "destination_site_id",
    "dumped_at", "event_to_dumped_latency_seconds",
)

_S_COLS = (
    "link_id", "interval_start", "travel_time_seconds", "delay_seconds", "speed_kmh",
    "enough_data", "ignored", "closed", "expected_missing",
    "travel_time_minutes", "free_flow_speed_kmh", "potential_incident",
)


def bronze_metrics(typed: DataFrame) -> DataFrame:
    """Join keys and the provider metrics of every bronze row."""
    return typed.select("link_id", "interval_start", *PROVIDER_METRICS, "dumped_at")


#: Columns of the fact that come from the dimension, and their names on its side.
DIM_SIDE = {"length_m": "d_length_m", "minimum_tt_seconds": "d_minimum_tt_seconds"}
DIM_IN_FACT = ("road_name", "direction", "is_freeway", "length_m", "minimum_tt_seconds",
               "origin_site_id", "destination_site_id")


def dim_side(dim: DataFrame) -> DataFrame:
    return dim.select(
        F.col("link_id").alias("d_link_id"),
        F.col("name").alias("road_name"),
        "direction", "is_freeway",
        F.col("length_m").alias("d_length_m"),
        F.col("minimum_tt_seconds").alias("d_minimum_tt_seconds"),
        "origin_site_id", "destination_site_id",
    )


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        *[F.col(c) for c in _S_COLS[:5]],
        *[F.col(c) for c in PROVIDER_METRICS],
        *[F.col(c) for c in _S_COLS[5:]],
        "road_name", "direction", "is_freeway",
        F.col("d_length_m").alias("length_m"),
        F.col("d_minimum_tt_seconds").alias("minimum_tt_seconds"),
        "origin_site_id", "destination_site_id",
        "dumped_at",
        (epoch_seconds("dumped_at") - epoch_seconds("interval_start")).alias("event_to_dumped_latency_seconds"),
    ).select(*FACT_COLUMNS)


def _with_dim(df: DataFrame, dim: DataFrame) -> DataFrame:
    d = dim_side(dim)
    return df.join(d, F.col("link_id") == F.col("d_link_id"), "left").drop("d_link_id")


def fact_link_interval(dedup_w: DataFrame, dim: DataFrame, typed: DataFrame | None = None,
                       bronze_match: str = "all") -> DataFrame:
    """25-column fact.  ``dedup_w`` is ``silver_dedup_wide`` (carries the
    winner's metrics and dumped_at, used by ``latest`` mode).  The left join
    with bronze is an inner join, whose hot keys AQE can split on either side,
    and the keys without a match."""
    s = dedup_w.select(*_S_COLS, *PROVIDER_METRICS, "dumped_at")
    if bronze_match == "latest":
        return _finish(_with_dim(s, dim))
    if bronze_match != "all":
        raise ValueError(f"bronze_match must be 'all' or 'latest', not {bronze_match!r}")
    if typed is None:
        raise ValueError("bronze_match='all' needs the bronze frame")
    b = bronze_metrics(typed)
    s = s.drop(*PROVIDER_METRICS, "dumped_at")
    keys = ["link_id", "interval_start"]
    matched = s.join(b, keys, "inner")
    bkeys = b.select(*keys).dropDuplicates()
    unmatched = (
        s.join(bkeys, keys, "left_anti")
         .select("*", *[F.lit(None).cast("double").alias(c) for c in PROVIDER_METRICS],
                 F.lit(None).cast("timestamp").alias("dumped_at"))
    )
    return _finish(_with_dim(matched.unionByName(unmatched), dim))
