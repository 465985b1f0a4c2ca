"""Gold aggregates: sliding delay windows and the pipeline monitor.

Both are hash aggregations with map-side partial aggregation, so a road or
a 5-minute bucket holding a large share of all rows is pre-aggregated in
every map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkflow.functions.columns import epoch_seconds, round6, to_ntz

# Window sizes and topic partitions used by the published tables.
DELAY_WINDOW = "10 minutes"
DELAY_SLIDE = "5 minutes"
MONITOR_WINDOW = "5 minutes"
MONITOR_PARTITIONS = (0, 1, 2)


def delay_sliding(fact: DataFrame, size: str = DELAY_WINDOW, slide: str = DELAY_SLIDE,
                  time_col: str = "interval_start", publish: bool = True) -> DataFrame:
    """Mean delay per road over sliding event-time windows.

    Returns ``window_start, window_end, road_name, avg_delay_seconds``; with
    ``publish`` the times are TIMESTAMP_NTZ (UTC wall clock) and the mean is
    rounded to 6 decimals.
    """
    g = fact.groupBy(F.window(time_col, size, slide).alias("w"), "road_name").agg(
        F.avg("delay_seconds").alias("avg_delay_seconds"))
    ws, we, avg = F.col("w.start"), F.col("w.end"), F.col("avg_delay_seconds")
    if publish:
        ws, we, avg = to_ntz(ws), to_ntz(we), round6(avg)
    return g.select(ws.alias("window_start"), we.alias("window_end"), "road_name",
                    avg.alias("avg_delay_seconds"))


def monitor_base(bronze: DataFrame) -> DataFrame:
    """The monitor's columns, of the published or the typed bronze."""
    return bronze.select("dumped_at", "ingested_at", "interval_start", "partition", "offset")


def monitor(base: DataFrame, width: str = MONITOR_WINDOW,
            partitions: Sequence[int] = MONITOR_PARTITIONS,
            keep_struct: bool = False, publish: bool = True, watermark: str | None = None) -> DataFrame:
    """Tumbling landing-time windows: records, per-partition counts and max
    offsets, producer->dump and event->dump latency (whole seconds).

    ``watermark`` bounds a stream's state: a window closes when no later
    landing can reach it.  Without it every window stays in state.  The
    partition columns are those of ``partitions``; ``monitor_partitions`` has a
    row for every partition that occurs."""
    if watermark is not None:
        base = base.withWatermark("dumped_at", watermark)
    lat_ing = epoch_seconds("dumped_at") - epoch_seconds("ingested_at")
    lat_evt = epoch_seconds("dumped_at") - epoch_seconds("interval_start")
    aggs = [F.count(F.lit(1)).alias("records_processed")]
    for p in partitions:
        aggs.append(F.sum(F.when(F.col("partition") == p, 1).otherwise(0)).cast("bigint")
                    .alias(f"partition_{p}_count"))
    for p in partitions:
        aggs.append(F.max(F.when(F.col("partition") == p, F.col("offset"))).alias(f"max_offset_p{p}"))
    aggs += [
        F.avg(lat_ing).alias("avg_ingest_to_dump_latency_seconds"),
        F.max(lat_ing).alias("max_ingest_to_dump_latency_seconds"),
        F.avg(lat_evt).alias("avg_event_to_dump_latency_seconds"),
        F.max(lat_evt).alias("max_event_to_dump_latency_seconds"),
    ]
    g = base.groupBy(F.window("dumped_at", width).alias("w")).agg(*aggs)
    ws, we = F.col("w.start"), F.col("w.end")
    a1, a2 = F.col("avg_ingest_to_dump_latency_seconds"), F.col("avg_event_to_dump_latency_seconds")
    if publish:
        ws, we, a1, a2 = to_ntz(ws), to_ntz(we), round6(a1), round6(a2)
    cols = [ws.alias("window_start"), we.alias("window_end")]
    if keep_struct:
        cols.append("w")
    cols += ["records_processed"]
    cols += [f"partition_{p}_count" for p in partitions]
    cols += [f"max_offset_p{p}" for p in partitions]
    cols += [a1.alias("avg_ingest_to_dump_latency_seconds"), "max_ingest_to_dump_latency_seconds",
             a2.alias("avg_event_to_dump_latency_seconds"), "max_event_to_dump_latency_seconds"]
    return g.select(*cols)


def monitor_partitions(base: DataFrame, width: str = MONITOR_WINDOW) -> DataFrame:
    """Records and max offset per landing-time window and topic partition,
    whatever partitions the topic has."""
    g = base.groupBy(F.window("dumped_at", width).alias("w"), "partition").agg(
        F.count(F.lit(1)).alias("n"), F.max("offset").alias("max_offset"))
    return g.select(to_ntz("w.start").alias("window_start"), "partition", "n", "max_offset")
