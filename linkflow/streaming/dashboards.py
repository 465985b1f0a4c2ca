"""What the dashboards show, kept up to date by the load.

A micro-batch inserts its observations by transport id; from the rows that are new
it adds to partial results by interval: sums and counts, the links, the latest row
of each road, counts and highest offsets of each topic partition.  All partials merge,
and a dashboard's window is a set of intervals, so every figure comes from the
partials of the window's days.  Only the lists of rows read rows, those of the
newest days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.functions.columns import epoch_bucket, round6
from linkflow.operators import dashboard as db
from linkflow.operators.load import PK, load_observations
from linkflow.streaming.table import OffsetTable, VersionedTable

ROAD_ROW = ["interval_start", *PK, "delay_seconds", "speed_kmh"]


class DashboardTables:
    def __init__(self, spark: SparkSession, root: str):
        day = F.to_date("interval_start")
        self.spark = spark
        self.observations = OffsetTable(spark, f"{root}/observations", PK)
        self.rows, self.intervals, self.links, self.roads, self.landings = (
            VersionedTable(spark, f"{root}/{name}", day)
            for name in ("rows", "intervals", "links", "roads", "landings"))

    # ------------------------------------------------------------ the load
    def __call__(self, dump: DataFrame, batch_id: int) -> None:
        self.observations.insert(load_observations(dump, columns=db.FRAME_COLUMNS), batch_id)
        new = db.newest(self.observations.added(batch_id), None)
        self.rows.append(new, batch_id)
        new = self.rows.added(batch_id).filter("interval_start IS NOT NULL")  # written: read once for each partial
        self.intervals.merge(self._intervals(new), batch_id, lambda held, mine: self._summed(held.unionByName(mine)))
        self.links.insert_first(new.select("interval_start", "link_id").distinct(), batch_id,
                                ["interval_start", "link_id"], ["link_id"])
        self.roads.upsert(new.filter("road_name IS NOT NULL").select("road_name", *ROAD_ROW), batch_id,
                          ["road_name", "interval_start"], PK)
        self.landings.merge(self._landings(new), batch_id, lambda held, mine: self._landed(held.unionByName(mine)))

    @staticmethod
    def _intervals(new: DataFrame) -> DataFrame:
        late = F.unix_micros("dumped_at") - F.unix_micros("interval_start")
        return DashboardTables._summed(new.select(
            "interval_start", F.lit(1).cast("bigint").alias("n"), F.col("delay_seconds").alias("delay_sum"),
            F.col("delay_seconds").isNotNull().cast("bigint").alias("delay_n"),
            F.col("dumped_at").isNotNull().cast("bigint").alias("landed_n"),
            late.alias("late_sum"), late.alias("late_max")))

    @staticmethod
    def _summed(rows: DataFrame) -> DataFrame:
        total = lambda c: F.sum(c).alias(c)
        return rows.groupBy("interval_start").agg(
            *[total(c) for c in ("n", "delay_sum", "delay_n", "landed_n", "late_sum")], F.max("late_max").alias("late_max"))

    @staticmethod
    def _landings(new: DataFrame) -> DataFrame:
        return DashboardTables._landed(new.filter("dumped_at IS NOT NULL").select(
            "interval_start", epoch_bucket("dumped_at", 5).alias("slot"), "partition",
            F.lit(1).cast("bigint").alias("n"), F.col("offset").alias("max_offset")))

    @staticmethod
    def _landed(rows: DataFrame) -> DataFrame:
        return rows.groupBy("interval_start", "slot", "partition").agg(
            F.sum("n").alias("n"), F.max("max_offset").alias("max_offset"))

    # ------------------------------------------------------------ windows
    @staticmethod
    def _days(table: VersionedTable) -> list[str]:
        """The table's days, the newest first."""
        return sorted((b for b in table.pointer().folders if b[len("bucket="):][:1].isdigit()), reverse=True)

    def latest(self) -> dt.datetime | None:
        days = self._days(self.intervals)
        return self.intervals.rows(buckets=days[:1]).agg(F.max("interval_start")).first()[0] if days else None

    def window(self, table: VersionedTable, minutes: int = db.DEFAULT_WINDOW_MINUTES) -> DataFrame:
        """A table's rows of the intervals within ``minutes`` of the latest one."""
        latest = self.latest()
        if latest is None:
            return table.rows().limit(0)
        start = latest - dt.timedelta(minutes=minutes)
        days = [b for b in self._days(table) if b >= f"bucket={start.date()}"]
        return table.rows(buckets=days).filter(F.col("interval_start") >= F.lit(start))

    def newest(self, n: int = db.DEFAULT_ROW_LIMIT) -> DataFrame:
        """The ``n`` newest rows, from as many of the newest days as hold them."""
        days, held = [], 0
        for day in self._days(self.rows):
            if held >= n:
                break
            days.append(day)
            held += self.intervals.rows(buckets=[day]).agg(F.sum("n")).first()[0] or 0
        return db.newest(self.rows.rows(buckets=days) if held >= n else self.rows.rows(), n)

    # ------------------------------------------------------------ figures
    def kpi_traffic(self, minutes: int) -> DataFrame:
        links = self.window(self.links, minutes).agg(F.count_distinct("link_id")).first()[0]
        w = self.window(self.intervals, minutes)
        return w.agg(F.max("interval_start").alias("latest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
                     F.lit(links).cast("bigint").alias("links"),
                     round6(self._mean("delay_sum", "delay_n")).alias("avg_delay"))

    @staticmethod
    def _mean(total: str, n: str) -> Column:
        return F.try_divide(F.sum(total), F.sum(n))

    def kpi_monitor(self, minutes: int) -> DataFrame:
        w = self.window(self.intervals, minutes)
        return w.agg(F.max("interval_start").alias("latest"), F.coalesce(F.sum("landed_n"), F.lit(0)).alias("n"),
                     round6(self._mean("late_sum", "landed_n") / 1e6).alias("avg_lat"),
                     (F.max("late_max") / 1e6).alias("max_lat"))

    def delay_over_time(self, minutes: int) -> DataFrame:
        w = self.window(self.intervals, minutes)
        return w.groupBy("interval_start").agg(round6(self._mean("delay_sum", "delay_n")).alias("avg_delay")) \
            .orderBy("interval_start")

    def latest_by_road(self, minutes: int) -> DataFrame:
        return db.latest_by_road(self.window(self.roads, minutes))

    def records_per_5m(self, minutes: int) -> DataFrame:
        w = self.window(self.landings, minutes)
        return w.groupBy(F.col("slot").alias("bucket")).agg(F.sum("n").alias("n")).orderBy("bucket")

    def partition_distribution(self, minutes: int) -> DataFrame:
        return self.window(self.landings, minutes).groupBy("partition").agg(F.sum("n").alias("n")).orderBy("partition")

    def max_offset_by_partition(self, minutes: int) -> DataFrame:
        w = self.window(self.landings, minutes)
        return w.groupBy("partition").agg(F.max("max_offset").alias("max_offset")).orderBy("partition")
