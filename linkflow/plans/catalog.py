"""Registered queries: ``fn(spark, sf_dir) -> DataFrame``.

Every query derives its input from the ``events`` table of ``sf_dir``
(see ``sources.fixture``), so its work grows with the table.  Output column
names match the SQL twins in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.operators import bronze as br
from linkflow.operators import dashboard as db
from linkflow.operators import gold as gd
from linkflow.operators import health as hl
from linkflow.operators import ingest as ig
from linkflow.operators import load as ld
from linkflow.operators import silver as sv
from linkflow.plans.layers import Layers, publish
from linkflow.session import scratch_path
from linkflow.sources import fixture as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _layers(spark, sf_dir, variant="clean", **kw) -> Layers:
    return Layers.from_events(spark, sf_dir, variant, **kw)


# --------------------------------------------------------------- bronze
@query("bronze")
def q_bronze(spark, sf_dir):
    return publish(_layers(spark, sf_dir).bronze.drop("value_str"))


@query("bronze_expectations")
def q_bronze_expectations(spark, sf_dir):
    from linkflow.operators.bronze import bronze_expectations
    return bronze_expectations(_layers(spark, sf_dir, "dirty").dump)


# --------------------------------------------------------------- silver
@query("silver_extract")
def q_silver_extract(spark, sf_dir):
    L = _layers(spark, sf_dir)
    return publish(sv.extract(L.typed).select(*sv.EXTRACT_COLUMNS, "offset"))


@query("silver")
def q_silver(spark, sf_dir):
    return publish(_layers(spark, sf_dir).silver)


@query("silver_expectations")
def q_silver_expectations(spark, sf_dir):
    return sv.silver_expectations(_layers(spark, sf_dir).typed)


@query("silver_incidents")
def q_silver_incidents(spark, sf_dir):
    s = _layers(spark, sf_dir).silver
    return s.groupBy("link_id", "potential_incident").agg(F.count(F.lit(1)).alias("n"))


@query("congestion_flag")
def q_congestion_flag(spark, sf_dir):
    L = _layers(spark, sf_dir)
    df = sv.derive(sv.extract(L.typed)).withColumn("congestion_flag", sv.congestion_flag())
    return df.groupBy("link_id", "congestion_flag").agg(F.count(F.lit(1)).alias("n"))


@query("silver_strict")
def q_silver_strict(spark, sf_dir):
    return publish(_layers(spark, sf_dir).strict.select(*sv.STRICT_COLUMNS))


@query("silver_strict_dedup")
def q_silver_strict_dedup(spark, sf_dir):
    strict = _layers(spark, sf_dir).strict
    return publish(sv.silver_strict_dedup(strict).select(*sv.STRICT_COLUMNS))


@query("silver_dedup")
def q_silver_dedup(spark, sf_dir):
    return publish(_layers(spark, sf_dir).silver_dedup)


# --------------------------------------------------------------- dimension / fact / gold
@query("dim_link")
def q_dim_link(spark, sf_dir):
    return publish(_layers(spark, sf_dir).dim)


# The fact reads typed bronze three times (silver, dimension, bronze join):
# it is written once to the shared scratch folder and read back (pruned).
@query("fact_link_interval")
def q_fact_link_interval(spark, sf_dir):
    return publish(_layers(spark, sf_dir, materialize=True).fact("all"))


@query("fact_link_interval_latest")
def q_fact_link_interval_latest(spark, sf_dir):
    return publish(_layers(spark, sf_dir, materialize=True).fact("latest"))


@query("delay_sliding")
def q_delay_sliding(spark, sf_dir):
    return _layers(spark, sf_dir, materialize=True).delay_sliding("all")


@query("monitor_5m")
def q_monitor_5m(spark, sf_dir):
    return _layers(spark, sf_dir).monitor()


@query("monitor_partitions")
def q_monitor_partitions(spark, sf_dir):
    return gd.monitor_partitions(gd.monitor_base(_layers(spark, sf_dir).bronze))


# --------------------------------------------------------------- ingest shapes
def _land(spark, sf_dir, variant, with_bad=False, extra_topic=False) -> str:
    """Land the fixture dump as JSON-lines batches in a fresh scratch folder."""
    from linkflow.sources import jsonl
    ev = fx.events(spark, sf_dir)
    folder = scratch_path(spark, "landing")
    for name, batch in fx.landing_batches(ev, variant):
        lines = batch.select(jsonl.dump_line(batch).alias("value"))
        if with_bad and name.endswith("0001.jsonl"):
            lines = lines.unionByName(fx.bad_lines(ev))
        jsonl.write_jsonl(lines, folder, name)
    if extra_topic:  # a dump of another topic in the same folder
        other = fx.dump_clean(ev.filter(F.col("event_id") % 10 == 0))
        jsonl.land_dump(other.withColumn("topic", F.lit("other")), folder, "other_0001.jsonl")
    return folder


@query("scan_jsonl_dump")
def q_scan_jsonl_dump(spark, sf_dir):
    from linkflow.sources import jsonl
    folder = _land(spark, sf_dir, "clean", with_bad=True, extra_topic=True)
    d = jsonl.read_jsonl_dump(spark, folder, topic=fx.TOPIC)
    return publish(d.select("topic", F.col("partition").try_cast("int").alias("partition"),
                            F.col("offset").try_cast("bigint").alias("offset"), "key",
                            F.col("dumped_at").try_cast("timestamp").alias("dumped_at")))


@query("normalize_payload")
def q_normalize_payload(spark, sf_dir):
    d = ig.normalize_payload(_layers(spark, sf_dir, "shapes").dump)
    return d.select("offset", F.col("payload.id").try_cast("int").alias("link_id"), "wrapped")


@query("kafka_shape")
def q_kafka_shape(spark, sf_dir):
    from linkflow.sources.kafka import shape_kafka
    k = shape_kafka(fx.kafka_rows(fx.events(spark, sf_dir)))
    return k.select("partition", "offset", "key",
                    F.get_json_object("value", "$.payload.id").try_cast("int").alias("link_id"),
                    F.get_json_object("value", "$.payload.name").alias("road_name"))


@query("kafka_out_frame")
def q_kafka_out_frame(spark, sf_dir):
    out = ig.envelope_rows(fx.provider_records(fx.events(spark, sf_dir)), fx.SOURCE_TYPE)
    return ig.published_values(out.select(F.col("key").cast("string"), F.col("value").cast("string")))


@query("land_dump")
def q_land_dump(spark, sf_dir):
    """Kafka rows landed as JSON lines (dumped_at = broker time + offset % 97 s
    here, for a deterministic result; live landing uses the current time)
    and read back."""
    from linkflow.sources import jsonl
    rows = fx.kafka_rows(fx.events(spark, sf_dir))
    landed = jsonl.landing_frame(rows, F.col("timestamp") + F.make_interval(
        secs=(F.col("offset") % 97).cast("decimal(18,6)")))
    folder = scratch_path(spark, "landing")
    jsonl.land_dump(landed, folder, f"{fx.TOPIC}_0001.jsonl")
    return publish(landed_values(jsonl.read_jsonl_dump(spark, folder, topic=fx.TOPIC))
                   .withColumn("dumped_at", F.col("dumped_at").try_cast("timestamp")))


def landed_values(dump: DataFrame) -> DataFrame:
    """What came back from a landing folder, with a field of the value."""
    return dump.select(F.col("partition").try_cast("int").alias("partition"),
                       F.col("offset").try_cast("bigint").alias("offset"), "key",
                       F.get_json_object("value", "$.payload.id").try_cast("int").alias("link_id"), "dumped_at")


@query("extract_records")
def q_extract_records(spark, sf_dir):
    recs = ig.extract_records(fx.raw_responses(fx.events(spark, sf_dir)))
    return recs.select("response_id", "pos", F.get_json_object("record", "$.name").alias("road_name"))


@query("guess_key")
def q_guess_key(spark, sf_dir):
    recs = ig.extract_records(fx.raw_responses(fx.events(spark, sf_dir)))
    return recs.select("response_id", "pos", ig.guess_key(F.col("record")).alias("key"))


@query("build_envelope")
def q_build_envelope(spark, sf_dir):
    ev = fx.base(fx.events(spark, sf_dir))
    env = ev.select(ig.build_envelope(F.to_json(fx.payload_struct()), F.lit(fx.SOURCE_TYPE),
                                      F.concat(F.lit("/links/"), fx._link().cast("string")),
                                      fx._ts()).alias("envelope"))
    return publish(env.select(
        F.get_json_object("envelope", "$.source.type").alias("source_type"),
        F.get_json_object("envelope", "$.payload.id").try_cast("int").alias("link_id"),
        F.get_json_object("envelope", "$.ingested_at").try_cast("timestamp").alias("ingested_at")))


@query("observations_flat")
def q_observations_flat(spark, sf_dir):
    obs = ig.flatten_observations(ig.normalize_payload(_layers(spark, sf_dir).dump))
    return obs.drop("payload_json")


@query("schema_hints")
def q_schema_hints(spark, sf_dir):
    return ig.schema_hints(_layers(spark, sf_dir).dump)


@query("schema_hints_props")
def q_schema_hints_props(spark, sf_dir):
    return ig.json_key_counts(fx.events(spark, sf_dir), "props", "props")


# --------------------------------------------------------------- local load
def _loaded(spark, folder, existing=None):
    from linkflow.sources import jsonl
    d = jsonl.read_jsonl_dump(spark, folder, with_file=True)
    return ld.load_observations(d, existing)


@query("load_insert_or_ignore")
def q_load_insert_or_ignore(spark, sf_dir):
    folder = _land(spark, sf_dir, "replays")
    obs = _loaded(spark, folder)
    return publish(obs.select("topic", "partition", "offset",
                              F.col("dumped_at").try_cast("timestamp").alias("dumped_at")))


@query("load_summary")
def q_load_summary(spark, sf_dir):
    from linkflow.sources import jsonl
    folder = _land(spark, sf_dir, "replays")
    jsonl.write_jsonl(fx.bad_lines(fx.events(spark, sf_dir)), folder, f"{fx.TOPIC}_0005.jsonl")
    d = jsonl.read_jsonl_dump(spark, folder, with_file=True)
    return ld.load_summary(d, jsonl.landed_files(spark, folder))


@query("bronze_upsert")
def q_bronze_upsert(spark, sf_dir):
    from linkflow.operators.latest import insert_only
    ev = fx.events(spark, sf_dir)
    first = br.bronze(fx.dump_clean(ev))
    batches = fx.landing_batches(ev, "replays")
    second = br.bronze(batches[-1][1])
    target = first.unionByName(insert_only(second, first, ["topic", "partition", "offset"]))
    return publish(target.select("topic", "partition", "offset", "dumped_at"))


# --------------------------------------------------------------- health report
@query("dump_recent")
def q_dump_recent(spark, sf_dir):
    d = _layers(spark, sf_dir).dump
    r = hl.recent(d, hl.DEFAULT_SINCE_MINUTES, as_of=hl.latest_landing(d))
    return publish(r.select("partition", "offset", F.col("dumped_at_ts").alias("dumped_at")))


@query("dump_summary")
def q_dump_summary(spark, sf_dir):
    d = _layers(spark, sf_dir).dump
    return hl.summary(hl.recent(d, hl.DEFAULT_SINCE_MINUTES, as_of=hl.latest_landing(d)))


@query("dump_buckets_5m")
def q_dump_buckets_5m(spark, sf_dir):
    return publish(hl.buckets(hl.landed(_layers(spark, sf_dir).dump), 5))


@query("dump_buckets_7m")
def q_dump_buckets_7m(spark, sf_dir):
    return publish(hl.buckets(hl.landed(_layers(spark, sf_dir).dump), 7))


@query("top_keys")
def q_top_keys(spark, sf_dir):
    return hl.top_keys(hl.landed(_layers(spark, sf_dir).dump))


@query("max_offset_by_partition")
def q_max_offset_by_partition(spark, sf_dir):
    d = fx.dump_dirty(fx.events(spark, sf_dir), text_ids=True)
    return hl.max_offsets(hl.landed(d))


@query("consumer_lag")
def q_consumer_lag(spark, sf_dir):
    return hl.consumer_lag(fx.offsets_table(_layers(spark, sf_dir).dump))


@query("consumer_lag_totals")
def q_consumer_lag_totals(spark, sf_dir):
    return hl.lag_totals(hl.consumer_lag(fx.offsets_table(_layers(spark, sf_dir).dump)))


# --------------------------------------------------------------- dashboards
def _obs(spark, sf_dir):
    """The loaded observation table the dashboards read (written once)."""
    obs = ld.load_observations(_layers(spark, sf_dir).dump, columns=db.FRAME_COLUMNS)
    return ld.observation_table(spark, obs)


def _window(spark, sf_dir, minutes=240, row_limit=None):
    return db.window_frame(_obs(spark, sf_dir), row_limit, minutes)


@query("dash_recent")
def q_dash_recent(spark, sf_dir):
    return publish(db.newest(_obs(spark, sf_dir), db.DEFAULT_ROW_LIMIT))


@query("dash_window")
def q_dash_window(spark, sf_dir):
    return publish(db.window_frame(_obs(spark, sf_dir), window_minutes=db.DEFAULT_WINDOW_MINUTES))


@query("recent_50")
def q_recent_50(spark, sf_dir):
    return publish(db.recent_rows(_window(spark, sf_dir)))


@query("kpi_traffic")
def q_kpi_traffic(spark, sf_dir):
    return publish(db.kpi_traffic(_window(spark, sf_dir)))


@query("kpi_monitor")
def q_kpi_monitor(spark, sf_dir):
    return publish(db.kpi_monitor(_window(spark, sf_dir)))


@query("delay_over_time")
def q_delay_over_time(spark, sf_dir):
    return publish(db.delay_over_time(_window(spark, sf_dir)))


@query("latest_by_road")
def q_latest_by_road(spark, sf_dir):
    return publish(db.latest_by_road(_window(spark, sf_dir)))


@query("worst_delays")
def q_worst_delays(spark, sf_dir):
    return publish(db.worst_delays(db.latest_by_road(_window(spark, sf_dir))))


@query("records_per_5m")
def q_records_per_5m(spark, sf_dir):
    return publish(db.records_per_5m(db.monitor_window(_window(spark, sf_dir))))


@query("partition_distribution")
def q_partition_distribution(spark, sf_dir):
    return db.partition_distribution(db.monitor_window(_window(spark, sf_dir)))


@query("dash_max_offsets")
def q_dash_max_offsets(spark, sf_dir):
    return db.max_offset_by_partition(db.monitor_window(_window(spark, sf_dir)))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bronze -> silver -> dedup -> dim + fact -> sliding delay windows."""
    return q_delay_sliding(spark, sf_dir)


__all__ = ["QUERIES", "flagship"]
