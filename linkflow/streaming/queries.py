"""Streaming forms of the layers, as registered queries.

Each query lands the fixture dump (derived from ``events``) in a source
folder -- parquet for the uploaded-table source, JSON lines for the local
landing folder -- in one or more landing steps, runs the streaming query
with ``availableNow`` after each step (so each later step resumes from the
checkpoint), and returns the target table read back as a batch DataFrame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.functions.columns import round6, to_ntz
from linkflow.operators import bronze as br
from linkflow.operators import dimension as dm
from linkflow.operators import fact as ft
from linkflow.operators import gold as gd
from linkflow.operators import ingest as ig
from linkflow.operators import silver as sv
from linkflow.operators.load import PK, load_observations
from linkflow.operators.quality import metrics_name
from linkflow.plans.layers import publish
from linkflow.sources import fixture as fx
from linkflow.sources import growing, jsonl, outbox
from linkflow.streaming import metrics
from linkflow.streaming import runner as rn
from linkflow.streaming.dashboards import DashboardTables
from linkflow.streaming.lag import landing_lag
from linkflow.streaming.table import BUCKET, OffsetTable, Pointer, VersionedTable

STREAM_QUERIES: dict = {}

# Lateness allowed by the strict aggregate.
WATERMARK = "30 minutes"

# Trigger interval of the layers that run side by side here (production: minutes).
EVERY = "0 seconds"

DEDUP_KEYS = ["link_id", "interval_start"]
DEDUP_ORDER = ["dumped_at", "topic", "partition", "offset"]


def day(column: str = "interval_start") -> Column:
    """Bucket of tables whose rows belong to a day."""
    return F.to_date(column)


def stream_query(name: str):
    def deco(fn):
        STREAM_QUERIES[name] = fn
        return fn
    return deco


def land_parquet(batch: DataFrame, folder: str) -> None:
    """One landing step into a parquet source folder (new files only)."""
    batch.write.mode("append").parquet(folder)


#: Files of a micro-batch: a backlog is worked off in bounded batches.
MAX_FILES = 1000


def source_stream(spark: SparkSession, folder: str, schema, max_files: int | None = MAX_FILES) -> DataFrame:
    """``max_files=None``: all that has landed is one micro-batch."""
    r = spark.readStream.schema(schema)
    return (r if max_files is None else r.option("maxFilesPerTrigger", max_files)).parquet(folder)


# ------------------------------------------------------------------ bronze
@stream_query("stream_bronze")
def q_stream_bronze(spark, sf_dir):
    """Uploaded dump -> bronze, append with checkpoint, landed in 4 steps."""
    ws = rn.Workspace(spark, "bronze")
    ev = fx.events(spark, sf_dir)
    dump = fx.dump_clean(ev)
    src, target = ws.path("source"), ws.path("bronze")
    for i in range(4):
        land_parquet(dump.filter(F.col("offset") % 4 == i), src)
        if i % 2 == 1:  # two landing steps per run
            rn.append_parquet(br.bronze(source_stream(spark, src, dump.schema)), target,
                              ws.checkpoint("bronze"), "traffic-bronze-append")
    return publish(spark.read.parquet(target).drop("value_str"))


@stream_query("stream_bronze_upsert")
def q_stream_bronze_upsert(spark, sf_dir):
    """foreachBatch insert-only MERGE on (topic, partition, offset): batch 1
    the originals, batch 2 the replays."""
    ws = rn.Workspace(spark, "bronze-upsert")
    ev = fx.events(spark, sf_dir)
    batches = fx.landing_batches(ev, "replays")
    original = fx.dump_clean(ev)
    src, target = ws.path("source"), ws.path("bronze")
    fn = rn.insert_batches(target, PK, transform=br.bronze)
    for step in (original, batches[-1][1]):
        land_parquet(step, src)
        rn.foreach_batch(source_stream(spark, src, original.schema), fn,
                         ws.checkpoint("bronze"), "traffic-bronze")
    return publish(rn.table(spark, target).select("topic", "partition", "offset", "dumped_at"))


# ------------------------------------------------------------------ local incremental load
class LandingLoad:
    """The landing folder's lines, files that grow included, loaded into an
    observation table by transport id (insert-or-ignore, first row wins)."""

    def __init__(self, ws: rn.Workspace, topic: str = fx.TOPIC, split_bytes: int = growing.SPLIT_BYTES):
        self.ws, self.pattern, self.split_bytes = ws, f"{topic}_*.jsonl", split_bytes
        self.folder, self.ledger = ws.path("landing"), ws.path("ledger")
        self.target, self.checkpoint = ws.path("observations"), ws.checkpoint("load")

    def insert(self, batch: DataFrame, batch_id: int) -> None:
        rows = load_observations(jsonl.parse_dump_lines(batch.drop("start")))
        OffsetTable(batch.sparkSession, self.target, PK).insert(rows, batch_id)

    def run(self, every: str | None = None):
        lines = growing.growing_stream(self.ws.spark, self.folder, self.ledger, self.pattern, self.split_bytes)
        return rn.foreach_batch(lines, self.insert, self.checkpoint, "observations-load", every=every)

    def lag(self) -> DataFrame:
        """What has landed and is not loaded, per topic partition."""
        return landing_lag(self.ws.spark, self.folder, self.ledger, self.checkpoint, self.target, self.pattern)


def append_landing(dump: DataFrame, folder: str, name: str) -> None:
    """Appends a dump to the files of a landing batch."""
    growing.append_lines(dump.select(jsonl.dump_line(dump).alias("value")), folder, name)


@stream_query("stream_incremental_load")
def q_stream_incremental_load(spark, sf_dir):
    """Landing files that grow between the runs, then replays in a file of their
    own; equals one load of all files."""
    load = LandingLoad(rn.Workspace(spark, "load"))
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    for last in (False, True):
        append_landing(dump.filter((F.col("offset") % 3 == 2) == last), load.folder, f"{fx.TOPIC}_0001.jsonl")
        load.run()
    name, again = fx.landing_batches(fx.events(spark, sf_dir), "replays")[-1]
    append_landing(again, load.folder, name)
    load.run()
    out = rn.table(spark, load.target)
    return publish(out.select("topic", "partition", "offset",
                              F.col("dumped_at").try_cast("timestamp").alias("dumped_at")))


@stream_query("stream_consumer_lag")
def q_stream_consumer_lag(spark, sf_dir):
    """Lag of a load that stopped: half has landed and is loaded, the rest has
    landed since.  From the query's own commit log, ledger and table."""
    load = LandingLoad(rn.Workspace(spark, "lag"))
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    half = dump.select(F.floor((F.min("offset") + F.max("offset")) / 2)).scalar()
    append_landing(dump.filter(F.col("offset") < half), load.folder, f"{fx.TOPIC}_0001.jsonl")
    load.run()
    append_landing(dump.filter(F.col("offset") >= half), load.folder, f"{fx.TOPIC}_0001.jsonl")
    return load.lag()


# ------------------------------------------------------------------ silver dedup (CDC)
def _silver_wide_stream(stream: DataFrame) -> DataFrame:
    return sv.silver_wide(br.bronze_typed(stream))


@stream_query("stream_silver_dedup")
def q_stream_silver_dedup(spark, sf_dir):
    """Latest record per (link_id, interval_start) by dumped_at, with the
    dump landed in an order unrelated to dumped_at."""
    ws = rn.Workspace(spark, "silver-dedup")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    src, target = ws.path("source"), ws.path("silver_dedup")
    fn = rn.latest_batches(target, DEDUP_KEYS, DEDUP_ORDER, day())
    for r in (2, 0, 1):
        land_parquet(dump.filter(F.col("offset") % 3 == r), src)
        rn.foreach_batch(_silver_wide_stream(source_stream(spark, src, dump.schema)), fn,
                         ws.checkpoint("dedup"), "silver-dedup")
    return publish(rn.table(spark, target).select(*sv.DEDUP_COLUMNS))


@stream_query("stream_layered")
def q_stream_layered(spark, sf_dir):
    """One checkpointed query per layer, each reading the previous layer's
    table, running side by side: dump -> bronze -> silver -> silver_dedup, in
    two landing steps.  A layer starts once the table that it reads is there."""
    ws = rn.Workspace(spark, "layered")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    src = ws.path("source")
    b_t, s_t, d_t = ws.path("bronze"), ws.path("silver"), ws.path("silver_dedup")
    fn = rn.latest_batches(d_t, DEDUP_KEYS, DEDUP_ORDER, day())
    bronze_schema = spark.createDataFrame([], br.bronze(dump).schema).schema
    running = []
    try:
        land_parquet(dump.filter(F.col("offset") % 2 == 0), src)
        running.append(rn.append_parquet(br.bronze(source_stream(spark, src, dump.schema)), b_t,
                                         ws.checkpoint("bronze"), "layer-bronze", every=EVERY))
        rn.drain(*running)
        b_stream = source_stream(spark, b_t, bronze_schema)
        running.append(rn.append_parquet(sv.silver_wide(br.typed_from_table(b_stream)), s_t,
                                         ws.checkpoint("silver"), "layer-silver", every=EVERY))
        rn.drain(*running)
        s_stream = source_stream(spark, s_t, spark.read.parquet(s_t).schema)
        running.append(rn.foreach_batch(s_stream, fn, ws.checkpoint("dedup"), "layer-dedup", every=EVERY))
        land_parquet(dump.filter(F.col("offset") % 2 == 1), src)
        rn.drain(*running)
    finally:
        for q in running:
            q.stop()
    return publish(rn.table(spark, d_t).select(*sv.DEDUP_COLUMNS))


# ------------------------------------------------------------------ strict dedup / windows
@stream_query("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """Strict rows, ``dropDuplicates`` on (link_id, interval_start) with no
    watermark (every key stays in state); winners depend on arrival, so the
    published check is on the key set."""
    ws = rn.Workspace(spark, "dedup")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    src, target = ws.path("source"), ws.path("strict")
    for r in (0, 1):
        land_parquet(dump.filter(F.col("offset") % 2 == r), src)
        strict = sv.silver_strict(br.bronze_typed(source_stream(spark, src, dump.schema)))
        out = dedup_stream(strict).select(*DEDUP_KEYS, "road_name", "event_time",
                                          "delay_seconds", "offset")
        rn.append_parquet(out, target, ws.checkpoint("strict"), "strict-dedup")
    return publish(spark.read.parquet(target).select(*DEDUP_KEYS))


@stream_query("stream_dedup_bounded")
def q_stream_dedup_bounded(spark, sf_dir):
    """The same with a watermark ahead of the de-duplication: a key leaves the
    state once the watermark has passed it.  Landed in time order."""
    ws = rn.Workspace(spark, "dedup-bounded")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    t = F.unix_micros(F.col("dumped_at").try_cast("timestamp"))
    middle = dump.select(F.floor((F.min(t) + F.max(t)) / 2)).scalar()
    src, target = ws.path("source"), ws.path("strict")
    for step in (dump.filter(t < middle), dump.filter(t >= middle)):
        land_parquet(step, src)
        strict = sv.silver_strict(br.bronze_typed(source_stream(spark, src, dump.schema, max_files=None)))
        out = dedup_stream(strict, watermark="2 hours").select(*DEDUP_KEYS, "event_time", "offset")
        rn.append_parquet(out, target, ws.checkpoint("strict"), "strict-dedup-bounded")
    return publish(spark.read.parquet(target).select(*DEDUP_KEYS))


def dedup_stream(stream: DataFrame, keys=DEDUP_KEYS, watermark: str | None = None,
                 time_col: str = "event_time") -> DataFrame:
    """Streaming de-duplication on ``keys``, first arrival wins.

    ``watermark=None`` is the published behaviour: every key stays in the
    state store for ever (state grows with the number of distinct keys).
    With a watermark the state is bounded: ``dropDuplicatesWithinWatermark``
    forgets a key once the watermark passes its event time.
    """
    if watermark is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(time_col, watermark).dropDuplicatesWithinWatermark(list(keys))


def in_arrival_order(dump: DataFrame) -> DataFrame:
    """The dump with all records of a (link, hour) in one file, first landed first.

    A stateful operator sees the records of a key in the order of their file.
    """
    link, hour = F.col("key").cast("bigint") % 10, F.floor(F.col("timestamp")[1] / 3_600_000)
    return dump.repartition(link, hour).sortWithinPartitions("dumped_at", "topic", "partition", "offset")


def delay_watermarked(strict_stream: DataFrame, watermark: str = WATERMARK) -> DataFrame:
    """Dedup, then watermark on event time, then sliding-window mean delay
    (append mode emits a window once the watermark passes its end)."""
    marked = dedup_stream(strict_stream).withWatermark("event_time", watermark)
    return gd.delay_sliding(marked, time_col="event_time", publish=False)


@stream_query("stream_delay_sliding")
def q_stream_delay_sliding(spark, sf_dir):
    """All strict records, those of a key in the order of their landing, some of
    them twice; the de-duplication keeps the first of each key."""
    ws = rn.Workspace(spark, "delay")
    rows = in_arrival_order(fx.dump_strict_input(fx.events(spark, sf_dir)))
    src, target = ws.path("source"), ws.path("agg")
    land_parquet(rows, src)
    strict = sv.silver_strict(br.bronze_typed(source_stream(spark, src, rows.schema, max_files=None)))
    rn.append_parquet(delay_watermarked(strict), target, ws.checkpoint("agg"), "delay-agg")
    return _published_delay(spark.read.parquet(target))


def _published_delay(t: DataFrame) -> DataFrame:
    return t.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"),
                    "road_name", round6("avg_delay_seconds").alias("avg_delay_seconds"))


WINDOW_KEYS = ["window_start", "road_name"]


def delay_of_fact(spark, sf_dir, name: str, output_mode: str, sink) -> DataFrame:
    """Fact table as a stream, landed in two steps -> sliding mean delay."""
    from linkflow.plans.layers import Layers
    ws = rn.Workspace(spark, name)
    fact = Layers.from_events(spark, sf_dir, materialize=True).fact("all")
    src, target = ws.path("fact"), ws.path("agg")
    for r in (0, 1):
        land_parquet(fact.filter(F.col("link_id") % 2 == r), src)
        agg = gd.delay_sliding(source_stream(spark, src, fact.schema), publish=False)
        rn.foreach_batch(agg, sink(target), ws.checkpoint("agg"), name, output_mode=output_mode)
    return _published_delay(rn.table(spark, target))


@stream_query("stream_delay_sliding_complete")
def q_stream_delay_sliding_complete(spark, sf_dir):
    """Complete mode: no watermark, every window is kept and given out again."""
    return delay_of_fact(spark, sf_dir, "delay-complete", "complete", rn.complete_batches)


@stream_query("stream_delay_sliding_update")
def q_stream_delay_sliding_update(spark, sf_dir):
    """Update mode: the windows that a micro-batch changed replace their own."""
    return delay_of_fact(spark, sf_dir, "delay-update", "update",
                         lambda target: rn.update_batches(target, WINDOW_KEYS, day("window_start")))


def monitor_stream(spark, sf_dir, name: str, output_mode: str, sink) -> DataFrame:
    """Bronze as a stream, landed in two steps -> 5-minute landing-time monitor."""
    ws = rn.Workspace(spark, name)
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    src, target = ws.path("source"), ws.path("monitor")
    for r in (0, 1):
        land_parquet(dump.filter(F.col("offset") % 2 == r), src)
        m = gd.monitor(gd.monitor_base(br.bronze(source_stream(spark, src, dump.schema))), publish=False)
        rn.foreach_batch(m, sink(target), ws.checkpoint("monitor"), name, output_mode=output_mode)
    return _published_monitor(rn.table(spark, target))


@stream_query("stream_monitor_5m")
def q_stream_monitor_5m(spark, sf_dir):
    """The monitor in complete mode."""
    return monitor_stream(spark, sf_dir, "monitor-5m", "complete", rn.complete_batches)


@stream_query("stream_monitor_update")
def q_stream_monitor_update(spark, sf_dir):
    """The monitor in update mode."""
    return monitor_stream(spark, sf_dir, "monitor-update", "update",
                          lambda target: rn.update_batches(target, ["window_start"], day("window_start")))


def _published_monitor(t: DataFrame) -> DataFrame:
    return t.select(to_ntz("window_start").alias("window_start"), to_ntz("window_end").alias("window_end"),
                    *[c for c in t.columns if c not in ("window_start", "window_end")
                      and not c.startswith("avg_")],
                    round6("avg_ingest_to_dump_latency_seconds").alias("avg_ingest_to_dump_latency_seconds"),
                    round6("avg_event_to_dump_latency_seconds").alias("avg_event_to_dump_latency_seconds"))


@stream_query("stream_monitor_watermarked")
def q_stream_monitor_watermarked(spark, sf_dir):
    """The monitor with a watermark, in append mode: closed windows only, state
    bounded by the watermark."""
    ws = rn.Workspace(spark, "monitor-watermarked")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    src, target = ws.path("source"), ws.path("monitor")
    land_parquet(dump, src)
    b = br.bronze(source_stream(spark, src, dump.schema, max_files=None))
    m = gd.monitor(gd.monitor_base(b), publish=False, watermark=WATERMARK)
    rn.append_parquet(m, target, ws.checkpoint("monitor"), "monitor-watermarked")
    return _published_monitor(spark.read.parquet(target))


# ------------------------------------------------------------------ three targets from one read
class StrictSinks:
    """Bronze, the strict de-duplicated records and their sliding mean delay, from one
    read of the source.  The means are kept as sums and counts, to which a micro-batch
    adds those of the records that it brought in."""

    def __init__(self, spark: SparkSession, root: str):
        self.bronze = OffsetTable(spark, f"{root}/bronze")
        self.silver = VersionedTable(spark, f"{root}/silver", day())
        self.delay = VersionedTable(spark, f"{root}/delay", day("window_start"))
        self.write = rn.fan_out(self.to_bronze, self.to_silver, self.to_delay)

    def to_bronze(self, batch: DataFrame, batch_id: int) -> None:
        self.bronze.insert(br.bronze(batch), batch_id)

    def to_silver(self, batch: DataFrame, batch_id: int) -> None:
        strict = sv.silver_strict(br.bronze_typed(batch))
        self.silver.insert_first(strict.select(*STRICT_SINK), batch_id, DEDUP_KEYS, DEDUP_ORDER)

    def to_delay(self, batch: DataFrame, batch_id: int) -> None:
        w = F.window("event_time", gd.DELAY_WINDOW, gd.DELAY_SLIDE)
        new = self.silver.added(batch_id).groupBy(w.alias("w"), "road_name").agg(
            F.sum("delay_seconds").alias("delay_sum"), F.count("delay_seconds").alias("delay_count"))
        new = new.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "road_name",
                         "delay_sum", "delay_count")
        keys = ["window_start", "window_end", "road_name"]
        self.delay.merge(new, batch_id, lambda held, mine: held.unionByName(mine).groupBy(*keys).agg(
            F.sum("delay_sum").alias("delay_sum"), F.sum("delay_count").alias("delay_count")))

    def means(self) -> DataFrame:
        return self.delay.rows().withColumn("avg_delay_seconds", F.col("delay_sum") / F.col("delay_count"))


STRICT_SINK = ("link_id", "interval_start", "road_name", "event_time", "delay_seconds", *DEDUP_ORDER)


@stream_query("stream_three_sinks")
def q_stream_three_sinks(spark, sf_dir):
    """One query, three targets; records land in two steps by time.  Result: the mean
    delays of all windows."""
    ws = rn.Workspace(spark, "three")
    dump = fx.dump_strict_input(fx.events(spark, sf_dir))
    t = F.unix_micros(F.col("dumped_at").try_cast("timestamp"))
    middle = dump.select(F.floor((F.min(t) + F.max(t)) / 2)).scalar()
    src, sinks = ws.path("source"), StrictSinks(spark, ws.path("tables"))
    for step in (dump.filter(t < middle), dump.filter(t >= middle)):
        land_parquet(step, src)
        rn.foreach_batch(source_stream(spark, src, dump.schema, max_files=None), sinks.write,
                         ws.checkpoint("three"), "three-sinks")
    return _published_delay(sinks.means())


# ------------------------------------------------------------------ quality counters
@stream_query("stream_expectations")
def q_stream_expectations(spark, sf_dir):
    """Violations of the bronze rules as a running query's listener logged them, over
    two landing steps of a dump with broken records."""
    ws = rn.Workspace(spark, "expectations")
    dump = fx.dump_dirty(fx.events(spark, sf_dir))
    src, target, root = ws.path("source"), ws.path("bronze"), ws.path("metrics")
    watch = metrics.ExpectationLog(spark, root)
    spark.streams.addListener(watch)
    try:
        for r in (0, 1):
            land_parquet(dump.filter(F.pmod(F.xxhash64("offset", "dumped_at"), F.lit(2)) == r), src)
            q = rn.append_parquet(br.bronze(source_stream(spark, src, dump.schema)), target,
                                  ws.checkpoint("bronze"), "guarded-bronze")
            watch.wait(q)
    finally:
        spark.streams.removeListener(watch)
    return metrics.totals(metrics.expectation_log(spark, root))


# ------------------------------------------------------------------ dashboards
def dashboards(spark, sf_dir) -> DashboardTables:
    """The dashboards' tables after a load in two micro-batches, the second with replays."""
    ws = rn.Workspace(spark, "dashboards")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    src, tables = ws.path("source"), DashboardTables(spark, ws.path("tables"))
    even = F.col("offset") % 2 == 0
    for step in (dump.filter(even), dump.filter(~even | (F.col("offset") % 20 == 0))):
        land_parquet(step, src)
        rn.foreach_batch(source_stream(spark, src, dump.schema), tables, ws.checkpoint("load"), "dashboards")
    return tables


@stream_query("stream_kpi_traffic")
def q_stream_kpi_traffic(spark, sf_dir):
    """The figures of the traffic page, from the partials of the window's days."""
    return publish(dashboards(spark, sf_dir).kpi_traffic(240))


# ------------------------------------------------------------------ publishing
def landing_steps(records: DataFrame) -> list[DataFrame]:
    """Provider records in two steps, by record.

    The observation keeps the filter, which needs the record's text, from being pushed
    below the dealing of the raw rows into the few tasks that scan them."""
    seen = records.observe(metrics_name("landing"), F.count(F.lit(1)).alias("rows"))
    return [seen.filter(F.pmod(F.xxhash64("record"), F.lit(2)) == r) for r in (0, 1)]


@stream_query("stream_publish")
def q_stream_publish(spark, sf_dir):
    """Provider records published as keyed envelopes by a stream, two steps; what the
    delivery reports name is read back."""
    ws = rn.Workspace(spark, "publish")
    src, topic = ws.path("source"), ws.path("topic")
    records = fx.provider_records(fx.events(spark, sf_dir))
    for step in landing_steps(records):
        land_parquet(step, src)
        rows = ig.envelope_rows(source_stream(spark, src, records.schema), fx.SOURCE_TYPE)
        rn.run(outbox.publish_stream(rows, topic), ws.checkpoint("publish"), "publish", spark=spark)
    return ig.published_values(outbox.delivered(spark, topic))


# ------------------------------------------------------------------ landing
@stream_query("stream_land_dump")
def q_stream_land_dump(spark, sf_dir):
    """A stream of Kafka-shaped rows landed as JSON lines, two steps, read back."""
    from linkflow.plans.catalog import landed_values
    ws = rn.Workspace(spark, "land")
    rows = fx.kafka_rows(fx.events(spark, sf_dir))
    src, folder = ws.path("source"), ws.path("landing")
    for r in (0, 1):
        land_parquet(rows.filter(F.col("offset") % 2 == r), src)
        rn.foreach_batch(source_stream(spark, src, rows.schema), jsonl.land_batches(folder, fx.TOPIC),
                         ws.checkpoint("land"), "land-dump")
    return landed_values(jsonl.read_jsonl_dump(spark, folder, topic=fx.TOPIC)).drop("dumped_at")


# ------------------------------------------------------------------ incremental fact
class FactTables:
    """Typed bronze, the dimension's winners and the fact, kept up to date by micro-batches.

    * A batch's typed rows are added by day.  The days that it touches are rebuilt
      from typed bronze of those days, and before them their keys' winners: a
      re-published record rebuilds its key.
    * The dimension's winners before and after the batch are compared.  Where a
      column that the fact shows differs, an index of the days of each link says
      which other days hold the link, and there the columns are put right.

    Each table records the batch with its own commit, so a retried batch goes on
    where it stopped.
    """

    DIM_KEYS, DIM_ORDER = ["link_id"], ["dumped_at", "topic", "partition", "offset"]
    DIM_BUCKETS = 16

    def __init__(self, spark: SparkSession, root: str):
        link = F.pmod(F.xxhash64("link_id"), F.lit(self.DIM_BUCKETS))
        self.spark = spark
        self.typed = VersionedTable(spark, f"{root}/typed", day())
        self.dim = VersionedTable(spark, f"{root}/dim", link)
        self.days = VersionedTable(spark, f"{root}/days", link)
        self.winners = VersionedTable(spark, f"{root}/winners", day())
        self.fact = VersionedTable(spark, f"{root}/fact", day())

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        self.typed.append(br.bronze_typed(batch), batch_id)
        touched, _, now = self.typed.changed(batch_id)
        landed = self.typed.added(batch_id)
        self.dim.upsert(landed.filter("has_link_id"), batch_id, self.DIM_KEYS, self.DIM_ORDER)
        self.days.insert_first(landed.filter("link_id IS NOT NULL AND interval_start IS NOT NULL")
                               .select("link_id", day().alias("day")).distinct(),
                               batch_id, ["link_id", "day"], ["day"])
        renamed = self.renamed(batch_id)
        other = self.other_days(renamed, touched)
        rows = self.typed.rows(buckets=touched, pointer=now)
        self.winners.replace(sv.silver_dedup_wide(sv.silver_wide(rows)), batch_id, touched)
        fact = self.rebuilt(touched, now)
        if other:
            fact = fact.unionByName(self.corrected(other, renamed))
        self.fact.replace(fact, batch_id, [*touched, *other])

    def dimension(self, rows: DataFrame) -> DataFrame:
        return ft.dim_side(dm.dim_link(rows))

    def renamed(self, batch_id: int) -> DataFrame:
        """The dimension rows whose columns in the fact a batch has changed, in the changed buckets."""
        buckets, before, after = self.dim.changed(batch_id)
        new = self.dimension(self.dim.rows(buckets=buckets, pointer=after))
        if before.schema is None:
            return new.limit(0)
        old = self.dimension(self.dim.rows(buckets=buckets, pointer=before))
        known = old.select(F.col("d_link_id").alias("known"))
        return new.join(known, F.col("d_link_id") == F.col("known"), "left_semi").exceptAll(old)

    def other_days(self, renamed: DataFrame, touched: list[str]) -> list[str]:
        """The buckets of the fact, other than the touched ones, that hold a renamed link."""
        at = self.days.rows().join(renamed, F.col("link_id") == F.col("d_link_id"), "left_semi")
        found = [f"{BUCKET}={r[0]}" for r in at.select(F.col("day").cast("string")).distinct().collect()]
        return sorted(set(found) & set(self.fact.pointer().folders) - set(touched))

    def corrected(self, buckets: list[str], renamed: DataFrame) -> DataFrame:
        """The fact of some buckets with the renamed links' columns as they are now."""
        held = self.fact.rows(buckets=buckets)
        new = renamed.withColumnRenamed("d_link_id", "of_link")
        met = held.join(new.select("of_link", *[F.col(c).alias(f"new_{c}") for c in new.columns if c != "of_link"]),
                        F.col("link_id") == F.col("of_link"), "left")
        hit = F.col("of_link").isNotNull()
        put = {c: F.when(hit, F.col(f"new_{ft.DIM_SIDE.get(c, c)}")).otherwise(F.col(c)) for c in ft.DIM_IN_FACT}
        return met.withColumns(put).select(*held.columns)

    def rebuilt(self, buckets: list[str], typed: Pointer) -> DataFrame:
        """The fact of some buckets from a version of typed bronze and its keys' winners.

        The winners are a table: they are found once for the fact's two joins, and the
        joins know by its size which side is small."""
        rows = self.typed.rows(buckets=buckets, pointer=typed)
        dim = dm.dim_link(self.dim.rows())
        return ft.fact_link_interval(self.winners.rows(buckets=buckets), dim, rows, "all")


@stream_query("stream_fact_upsert")
def q_stream_fact_upsert(spark, sf_dir):
    """The fact kept up to date by micro-batches.  The second step has other records
    of the first step's keys, so winners change; the third step, of later days,
    renames all roads, on the days before too."""
    ws = rn.Workspace(spark, "fact-upsert")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    t = F.unix_micros(F.col("dumped_at").try_cast("timestamp"))
    middle = dump.select(F.floor((F.min(t) + F.max(t)) / 2)).scalar()
    before = dump.filter(t < middle).withColumn(
        "value", F.replace("value", F.lit('"name":"road-'), F.lit('"name":"old-road-')))
    src, tables = ws.path("source"), FactTables(spark, ws.path("tables"))
    for step in (before.filter(F.col("offset") % 2 == 1), before.filter(F.col("offset") % 2 == 0),
                 dump.filter(t >= middle)):
        land_parquet(step, src)
        rn.foreach_batch(source_stream(spark, src, dump.schema), tables, ws.checkpoint("fact"), "fact-upsert")
    return publish(tables.fact.rows())


# ------------------------------------------------------------------ stream-static fact
@stream_query("stream_fact")
def q_stream_fact(spark, sf_dir):
    """De-duplicated silver as a stream, joined to the static dimension and the
    static typed bronze, of which a micro-batch reads its own days."""
    ws = rn.Workspace(spark, "fact")
    dump = fx.dump_clean(fx.events(spark, sf_dir))
    typed_t, d_t, dim_t, target = ws.path("typed"), ws.path("silver_dedup"), ws.path("dim_link"), ws.path("fact")
    br.bronze_typed(dump).withColumn("day", day()).hint("rebalance", "day").write.partitionBy("day").parquet(typed_t)
    typed = spark.read.parquet(typed_t)
    dm.dim_link(typed).write.parquet(dim_t)
    sv.silver_dedup_wide(sv.silver_wide(typed)).write.parquet(d_t)

    def join(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        days = [r[0] for r in batch.select(day()).distinct().collect()]  # bounded by the time span
        bronze = s.read.parquet(typed_t).filter(F.col("day").isin(days)).drop("day")
        fact = ft.fact_link_interval(batch, s.read.parquet(dim_t), bronze, "all")
        VersionedTable(s, target, day()).append(fact, batch_id)

    stream = source_stream(spark, d_t, spark.read.parquet(d_t).schema)
    rn.foreach_batch(stream, join, ws.checkpoint("fact"), "fact-link-interval")
    return publish(rn.table(spark, target))


# ------------------------------------------------------------------ late data
@stream_query("stream_late_drop")
def q_stream_late_drop(spark, sf_dir):
    """Events landed out of order (the first 60 % of the landing-time span,
    then the last 20 %, then what lies between, each in one micro-batch): with
    a 30-minute watermark the late rows are dropped; counts per 5-minute
    landing window of what was kept."""
    out, _, _ = late_drop_run(spark, sf_dir)
    return out


def late_drop_run(spark: SparkSession, sf_dir: str, count_late: bool = False) -> tuple[DataFrame, int, int]:
    """Returns (kept counts, rows the stateful operator dropped as late --
    counted after map-side partial aggregation, so aggregated rows --,
    rows landed in the late step if ``count_late``)."""
    ws = rn.Workspace(spark, "late")
    ev = fx.events(spark, sf_dir)
    dump = fx.dump_clean(ev)
    t = F.unix_micros(F.col("dumped_at").try_cast("timestamp"))
    span = dump.agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    cut60, cut80 = (span.select(F.col("lo") + F.floor((F.col("hi") - F.col("lo")) * n / 10)).scalar() for n in (6, 8))
    src, target = ws.path("source"), ws.path("counts")
    dropped = 0
    steps = [dump.filter(t < cut60), dump.filter(t >= cut80), dump.filter((t >= cut60) & (t < cut80))]
    schema = dump.schema
    for step in steps:
        land_parquet(step, src)
        b = br.bronze(source_stream(spark, src, schema, max_files=None)).withWatermark("dumped_at", WATERMARK)
        agg = b.groupBy(F.window("dumped_at", "5 minutes").alias("w")).agg(F.count(F.lit(1)).alias("n"))
        agg = agg.select(F.col("w.start").alias("window_start"), "n")
        qh = rn.append_parquet(agg, target, ws.checkpoint("counts"), "late-drop")
        for p in qh.recentProgress:
            for op in p.get("stateOperators", []) if isinstance(p, dict) else (p.stateOperators or []):
                n = op.get("numRowsDroppedByWatermark", 0) if isinstance(op, dict) else op.numRowsDroppedByWatermark
                dropped += int(n or 0)
    res = spark.read.parquet(target)
    late = steps[-1].count() if count_late else -1
    return publish(res.select("window_start", "n")), dropped, late
