"""Message dumps derived from the driver's ``events`` table.

The engine consumes landed messages: (topic, partition, offset, timestamp,
key, value, value_json, dumped_at) where ``value`` is the JSON envelope
``{ingested_at, source, payload}``.  These functions derive such a dump from
``events`` with a fixed, deterministic mapping, so every query's work grows
with the table and an SQL engine can recompute the expected values from the
same table without any JSON.

Mapping (``link = user_id % 10``, ``k = props.k``):
topic 'events'; partition user_id % 3; offset event_id; key user_id text;
dumped_at ts + (event_id % 97) s; ingested_at ts + (event_id % 31) s;
payload.id link; name NULL when event_id % 40 = 1 else 'road-<link>';
enabled event_type <> 'error'; draft NULL for 'view' else false;
length 1000 + 100 link; minimum_tt 0 for link 9 else 60 + link;
latest_stats absent when event_id % 50 = 0; interval_start = hour of ts
(written with a +11:00 offset); travel_time value-5; delay value-20;
speed value; density value/10; average_density value/20;
congestion k % 5; estimated_percent k; enough_data k % 3 <> 0;
ignored k % 7 = 0; closed k % 11 = 0; expected_missing NULL for even k,
else k % 13 = 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkflow.functions.columns import iso_text
from linkflow.session import prepare_session

# Fixed values of the mapping.
TOPIC = "events"
SOURCE_TYPE = "travel_time_api"
EVENT_TIME_OFFSET = "+11:00"  # provider reports local time with an offset
EVENT_TIME_OFFSET_HOURS = 11


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of the events table that a task derives messages from.
PART_BYTES = 2 << 20


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table.

    Every dump derivation is per-row JSON work, so the narrow raw rows are dealt
    anew over a number of tasks that grows with the table.  The splits of a scan are
    no such number: a split without the middle of a row group has no rows.  Rows are
    dealt in turn, whatever their ids; Spark sorts them first, so that a retried task's
    output is identical."""
    ev = read_table(spark, sf_dir, "events")
    size = int(ev._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return ev.repartition(max(spark.sparkContext.defaultParallelism, -(-size // PART_BYTES)))


def base(ev: DataFrame) -> DataFrame:
    """Events plus the mapping's shared inputs, computed once per row:
    ``link`` = user_id % 10, ``k`` = props.k, ``t`` = ts as an instant."""
    if "link" in ev.columns:
        return ev
    return ev.select(
        "event_id", "user_id", "event_type", "value", "ts",
        (F.col("user_id") % 10).cast("int").alias("link"),
        F.get_json_object("props", "$.k").try_cast("int").alias("k"),
        F.col("ts").cast("timestamp").alias("t"),
    )


def _link() -> Column:
    return F.col("link")


def _k() -> Column:
    return F.col("k")


def _ts() -> Column:
    return F.col("t")


def _plus_seconds(ts: Column, n: Column) -> Column:
    return ts + F.make_interval(secs=n.cast("decimal(18,6)"))


def _local_iso(ts: Column) -> Column:
    """Instant as provider-local ISO text, e.g. 2024-01-01T11:00:00+11:00."""
    shifted = ts + F.expr(f"INTERVAL {EVENT_TIME_OFFSET_HOURS} HOURS")
    return F.concat(F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(EVENT_TIME_OFFSET))


def payload_struct() -> Column:
    """The record a provider API returns for one link (envelope payload)."""
    link, k, v, eid = _link(), _k(), F.col("value"), F.col("event_id")
    latest = F.struct(
        _local_iso(F.date_trunc("hour", _ts())).alias("interval_start"),
        (v - 5).alias("travel_time"),
        (v - 20).alias("delay"),
        v.alias("speed"),
        (v / 10).alias("density"),
        (v / 20).alias("average_density"),
        (k % 5).alias("congestion"),
        k.alias("estimated_percent"),
        ((k % 3) != 0).alias("enough_data"),
        ((k % 7) == 0).alias("ignored"),
        ((k % 11) == 0).alias("closed"),
        F.when((k % 2) == 0, F.lit(None).cast("boolean")).otherwise((k % 13) == 0).alias("expected_missing"),
    )
    return F.struct(
        F.concat(F.lit("/links/"), link.cast("string")).alias("href"),
        link.alias("id"),
        F.when(eid % 40 == 1, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("road-"), link.cast("string"))).alias("name"),
        F.concat(F.lit("public-"), link.cast("string")).alias("public_name"),
        F.when(link % 2 == 0, F.lit("NB")).otherwise(F.lit("SB")).alias("direction"),
        (F.col("event_type") != "error").alias("enabled"),
        F.when(F.col("event_type") == "view", F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)).alias("draft"),
        (F.lit(1000) + F.lit(100) * link).alias("length"),
        F.when(link == 9, F.lit(0)).otherwise(F.lit(60) + link).alias("minimum_tt"),
        (F.lit(1) + link % 4).alias("min_number_of_lanes"),
        (link % 3 == 0).alias("is_freeway"),
        F.struct((F.lit(1000) + link).cast("bigint").alias("id")).alias("origin"),
        F.struct((F.lit(2000) + link).cast("bigint").alias("id")).alias("destination"),
        F.array(F.array(link, link + 1)).alias("coordinates"),
        F.when(eid % 50 == 0, F.lit(None)).otherwise(latest).alias("latest_stats"),
    )


def envelope_struct(payload: Column | None = None) -> Column:
    link = _link()
    return F.struct(
        iso_text(_plus_seconds(_ts(), F.col("event_id") % 31)).alias("ingested_at"),
        F.struct(F.lit(SOURCE_TYPE).alias("type"),
                 F.concat(F.lit("/links/"), link.cast("string")).alias("url")).alias("source"),
        (payload if payload is not None else payload_struct()).alias("payload"),
    )


def dump_columns(value: Column, value_json: Column | None = None) -> list[Column]:
    """Transport columns of one landed message around the given value."""
    ts = _ts()
    return [
        F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").cast("bigint").alias("offset"),
        F.array(F.lit(1).cast("bigint"), F.unix_millis(ts)).alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        (value_json if value_json is not None else F.lit(None).cast("string")).alias("value_json"),
        iso_text(_plus_seconds(ts, F.col("event_id") % 97)).alias("dumped_at"),
    ]


def dump_clean(ev: DataFrame) -> DataFrame:
    """One landed message per event; the envelope is in ``value``."""
    return base(ev).select(*dump_columns(F.to_json(envelope_struct())))


def dump_replays(ev: DataFrame) -> DataFrame:
    """Clean dump plus a replay of every 20th message (same transport id,
    landed one hour later)."""
    clean = dump_clean(ev)
    again = (
        dump_clean(ev.filter(F.col("event_id") % 20 == 0))
        .withColumn("dumped_at", iso_text(F.col("dumped_at").try_cast("timestamp")
                                          + F.expr("INTERVAL 3600 SECONDS")))
    )
    return clean.unionByName(again)


def dump_dirty(ev: DataFrame, text_ids: bool = False) -> DataFrame:
    """Clean dump with broken transport fields, chosen by event_id % 30:
    2 offset -1, 3 topic NULL, 4 value NULL, 5 partition -1, and with
    ``text_ids`` also 6 partition 'x' (partition/offset held as text)."""
    d = dump_clean(ev).withColumn("_m", F.col("offset") % 30)
    m = F.col("_m")
    part = F.when(m == 5, F.lit(-1)).otherwise(F.col("partition"))
    off = F.when(m == 2, F.lit(-1).cast("bigint")).otherwise(F.col("offset"))
    if text_ids:
        part = F.when(m == 6, F.lit("x")).otherwise(part.cast("string"))
        off = off.cast("string")
    return d.select(
        F.when(m == 3, F.lit(None).cast("string")).otherwise(F.col("topic")).alias("topic"),
        part.alias("partition"),
        off.alias("offset"),
        "timestamp", "key",
        F.when(m == 4, F.lit(None).cast("string")).otherwise(F.col("value")).alias("value"),
        "value_json", "dumped_at",
    )


def dump_shapes(ev: DataFrame) -> DataFrame:
    """Value shapes chosen by event_id % 4: 0 envelope in ``value``;
    1 envelope only in ``value_json``; 2 bare payload (no envelope) in
    ``value``; 3 ``value`` = '[1]' (not an object)."""
    m = F.col("event_id") % 4
    env = F.to_json(envelope_struct())
    bare = F.to_json(payload_struct())
    value = (F.when(m == 0, env).when(m == 2, bare).when(m == 3, F.lit("[1]"))
             .otherwise(F.lit(None).cast("string")))
    value_json = F.when(m == 1, env).otherwise(F.lit(None).cast("string"))
    return base(ev).select(*dump_columns(value, value_json))


def dump_strict_input(ev: DataFrame) -> DataFrame:
    """Clean dump with every 10th message written twice unchanged."""
    clean = dump_clean(ev)
    return clean.unionByName(clean.filter(F.col("offset") % 10 == 0))


#: An integer beyond 64 bits.
BIG_ID = "12345678901234567890"


def raw_responses(ev: DataFrame) -> DataFrame:
    """Raw API response bodies (one per event), chosen by event_id % 8:
    0 bare list of one record and one number; 1 {"data":[rec]};
    2 {"items":[rec, rec]}; 3 the record itself; 4 {"results":[]};
    5 a record whose ``data`` is the string "[1]"; 6 a list of a string that
    holds JSON and a record; 7 a record with a link_id beyond 64 bits.
    The record's key field is chosen by event_id % 4: link_id (int),
    linkId (text), id (float), ID (int)."""
    link = _link()
    km = F.col("event_id") % 4
    rec = F.to_json(F.struct(
        F.when(km == 0, link).alias("link_id"),
        F.when(km == 1, link.cast("string")).alias("linkId"),
        F.when(km == 2, link.cast("double") + F.lit(0.5)).alias("id"),
        F.when(km == 3, link).alias("ID"),
        F.concat(F.lit("road-"), link.cast("string")).alias("name"),
        F.col("value").alias("speed"),
    ))
    m = F.col("event_id") % 8
    body = (
        F.when(m == 0, F.concat(F.lit("["), rec, F.lit(",7]")))
        .when(m == 1, F.concat(F.lit('{"data":['), rec, F.lit("]}")))
        .when(m == 2, F.concat(F.lit('{"items":['), rec, F.lit(","), rec, F.lit("]}")))
        .when(m == 3, rec)
        .when(m == 5, F.concat(F.lit('{"data":"[1]",'), F.substr(rec, F.lit(2))))
        .when(m == 6, F.concat(F.lit('["{\\"id\\":1}",'), rec, F.lit("]")))
        .when(m == 7, F.concat(F.lit('{"link_id":' + BIG_ID + ',"name":"road-'), link.cast("string"), F.lit('"}')))
        .otherwise(F.lit('{"results":[]}'))
    )
    return base(ev).select(F.col("event_id").alias("response_id"), body.alias("body"),
                           F.concat(F.lit("/links/"), link.cast("string")).alias("url"))


def provider_records(ev: DataFrame) -> DataFrame:
    """One provider record per event with its request's url and time."""
    return base(ev).select(F.to_json(payload_struct()).alias("record"), _ts().alias("ts"),
                           F.concat(F.lit("/links/"), _link().cast("string")).alias("url"))


def offsets_table(dump: DataFrame) -> DataFrame:
    """Broker offsets per partition derived from a dump: begin = min offset,
    end = max offset + 1; committed = end for partition 0, the midpoint for
    partition 1 and -1001 (never committed) otherwise."""
    g = dump.groupBy(F.col("partition").cast("int").alias("partition")).agg(
        F.min(F.col("offset").cast("bigint")).alias("begin_offset"),
        (F.max(F.col("offset").cast("bigint")) + 1).alias("end_offset"),
    )
    committed = (
        F.when(F.col("partition") == 0, F.col("end_offset"))
        .when(F.col("partition") == 1,
              F.col("begin_offset") + F.floor((F.col("end_offset") - F.col("begin_offset")) / 2))
        .otherwise(F.lit(-1001))
    ).cast("bigint")
    return g.withColumn("committed_offset", committed)


def bad_lines(ev: DataFrame) -> DataFrame:
    """Lines a dump scanner must skip (blank, not JSON, JSON non-object),
    three per event with event_id % 100 = 7."""
    bad = F.array(F.lit(""), F.lit("not json"), F.lit("[1]"))
    return ev.filter(F.col("event_id") % 100 == 7).select(F.explode(bad).alias("value"))


def landing_batches(ev: DataFrame, variant: str = "replays") -> list[tuple[str, DataFrame]]:
    """The dump split into landing batches, in landing order, as
    ``(file name, dump frame)``.  ``replays``: originals in three batches by
    event_id % 3, then all replays in a fourth.  ``clean``: two batches by
    event_id % 2."""
    clean = dump_clean(ev)
    if variant == "clean":
        return [(f"{TOPIC}_{i + 1:04d}.jsonl", clean.filter(F.col("offset") % 2 == i)) for i in range(2)]
    if variant != "replays":
        raise ValueError(variant)
    again = (dump_clean(ev.filter(F.col("event_id") % 20 == 0))
             .withColumn("dumped_at", iso_text(F.col("dumped_at").try_cast("timestamp")
                                               + F.expr("INTERVAL 3600 SECONDS"))))
    out = [(f"{TOPIC}_{i + 1:04d}.jsonl", clean.filter(F.col("offset") % 3 == i)) for i in range(3)]
    out.append((f"{TOPIC}_0004.jsonl", again))
    return out


def kafka_rows(ev: DataFrame) -> DataFrame:
    """Rows with the Kafka source schema carrying the clean envelopes.  Keys
    are empty for event_id % 25 = 0; for event_id % 33 = 0 the road name in
    the value holds an invalid UTF-8 byte (0xFF) after 'road-<link>'."""
    eid = F.col("event_id")
    env_text = F.to_json(envelope_struct())
    name = F.concat(F.lit("road-"), _link().cast("string"))
    marker = F.concat(F.lit('"name":"'), name, F.lit('"'))
    head = F.split_part(env_text, marker, F.lit(1))
    tail = F.split_part(env_text, marker, F.lit(2))
    broken = F.concat(F.encode(head, "UTF-8"), F.encode(F.concat(F.lit('"name":"'), name), "UTF-8"),
                      F.unhex(F.lit("FF")), F.encode(F.concat(F.lit('"'), tail), "UTF-8"))
    has_name = F.contains(env_text, marker)
    value = F.when((eid % 33 == 0) & has_name, broken).otherwise(F.encode(env_text, "UTF-8"))
    key = F.when(eid % 25 == 0, F.encode(F.lit(""), "UTF-8")).otherwise(
        F.encode(F.col("user_id").cast("string"), "UTF-8"))
    return base(ev).select(
        key.alias("key"), value.alias("value"), F.lit(TOPIC).alias("topic"),
        (F.col("user_id") % 3).cast("int").alias("partition"), eid.cast("bigint").alias("offset"),
        _ts().alias("timestamp"), F.lit(0).alias("timestampType"),
    )
