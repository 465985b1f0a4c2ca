"""Dashboard frames over the flat observation table.

The dashboard loads the newest ``row_limit`` observations by interval
(``row_limit=None`` loads all), coerces the instants, keeps the rows within
``window_minutes`` of the latest interval, and summarises them.  Instants
are ordered as instants (not as their text), and every ordering ends in a
unique transport-id tiebreak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.functions.columns import epoch_bucket, round6, seconds_between, to_ts
from linkflow.operators.latest import latest_by

# Dashboard defaults.
DEFAULT_ROW_LIMIT = 1000
DEFAULT_WINDOW_MINUTES = 60
RECENT_ROWS = 50
WORST_ROWS = 30

FRAME_COLUMNS = ("topic", "partition", "offset", "interval_start", "road_name", "delay_seconds",
                 "speed_kmh", "travel_time_seconds", "link_id", "dumped_at")
TIEBREAK = ("topic", "partition", "offset")


def newest(obs: DataFrame, n: int | None = DEFAULT_ROW_LIMIT) -> DataFrame:
    """The ``n`` observations with the latest interval (NULL intervals last)
    as the 10 dashboard columns, instants parsed; a top-k, not a full sort."""
    df = obs.select(*FRAME_COLUMNS).withColumn("interval_start", to_ts("interval_start")) \
            .withColumn("dumped_at", to_ts("dumped_at"))
    if n is None:
        return df
    return df.orderBy(F.desc_nulls_last("interval_start"), *[F.asc(c) for c in TIEBREAK]).limit(n)


def anchored(frame: DataFrame, window_minutes: int = DEFAULT_WINDOW_MINUTES) -> DataFrame:
    """Rows with an interval, within ``window_minutes`` of the latest one.
    The latest interval is a scalar subquery (one-row aggregate)."""
    df = frame.filter(F.col("interval_start").isNotNull())
    latest = df.select(F.max("interval_start")).scalar()
    return df.filter(F.col("interval_start") >= latest - F.make_interval(mins=F.lit(window_minutes)))


def window_frame(obs: DataFrame, row_limit: int | None = None,
                 window_minutes: int = DEFAULT_WINDOW_MINUTES) -> DataFrame:
    if row_limit is None and "interval_day" in obs.columns:
        obs = _recent_days(obs, window_minutes)
    return anchored(newest(obs, row_limit), window_minutes)


def _recent_days(obs: DataFrame, window_minutes: int) -> DataFrame:
    """The day partitions that a window before the latest interval touches.

    The latest interval is found in the newest day, so neither step reads the
    history."""
    last_day = obs.select(F.max("interval_day")).scalar()
    latest = obs.filter(F.col("interval_day") == last_day).select(F.max("interval_start")).scalar()
    return obs.filter(F.col("interval_day") >= F.to_date(latest - F.make_interval(mins=F.lit(window_minutes))))


def kpi_traffic(window: DataFrame) -> DataFrame:
    """latest interval, rows, distinct links, mean delay of the window (the
    window always contains the latest interval of the loaded frame)."""
    return window.agg(
        F.max("interval_start").alias("latest"),
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("link_id").alias("links"),
        round6(F.avg("delay_seconds")).alias("avg_delay"),
    )


def delay_over_time(window: DataFrame) -> DataFrame:
    """The series in time order."""
    return window.groupBy("interval_start").agg(round6(F.avg("delay_seconds")).alias("avg_delay")) \
                 .orderBy("interval_start")


def latest_by_road(window: DataFrame) -> DataFrame:
    """Latest row per road (NULL roads dropped)."""
    rows = window.filter(F.col("road_name").isNotNull())
    latest = latest_by(rows, ["road_name"], ["interval_start", *TIEBREAK],
                       ["interval_start", "delay_seconds", "speed_kmh"])
    return latest.select("road_name", "interval_start", "delay_seconds", "speed_kmh")


def worst_delays(latest_rows: DataFrame, n: int = WORST_ROWS) -> DataFrame:
    return latest_rows.orderBy(F.desc_nulls_last("delay_seconds"), F.asc("road_name")).limit(n)


def recent_rows(window: DataFrame, n: int = RECENT_ROWS) -> DataFrame:
    return window.orderBy(F.desc_nulls_last("interval_start"), *[F.asc(c) for c in TIEBREAK]).limit(n)


def monitor_window(window: DataFrame) -> DataFrame:
    """Monitor page rows: landing time known, event->dump latency in
    fractional seconds."""
    return (window.filter(F.col("dumped_at").isNotNull())
                  .withColumn("event_to_dump_latency_seconds",
                              seconds_between("dumped_at", "interval_start")))


def kpi_monitor(window: DataFrame) -> DataFrame:
    """latest interval (before the landing-time drop), records with a landing
    time, mean and max event->dump latency -- one aggregate pass."""
    lat = seconds_between("dumped_at", "interval_start")
    return window.agg(
        F.max("interval_start").alias("latest"),
        F.count_if(F.col("dumped_at").isNotNull()).alias("n"),
        round6(F.avg(lat)).alias("avg_lat"),
        F.max(lat).alias("max_lat"),
    )


def records_per_5m(mon: DataFrame) -> DataFrame:
    """The series in time order."""
    return mon.groupBy(epoch_bucket("dumped_at", 5).alias("bucket")).agg(F.count(F.lit(1)).alias("n")) \
              .orderBy("bucket")


def partition_distribution(mon: DataFrame) -> DataFrame:
    return mon.groupBy("partition").agg(F.count(F.lit(1)).alias("n")).orderBy("partition")


def max_offset_by_partition(mon: DataFrame) -> DataFrame:
    return mon.groupBy("partition").agg(F.max("offset").alias("max_offset")).orderBy("partition")
