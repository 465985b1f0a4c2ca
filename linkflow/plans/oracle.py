"""DuckDB twins of the registered queries.

Each SQL recomputes, straight from the ``events`` table, what the Spark
query derives through the JSON dump: the mapping of ``sources.fixture`` is
restated here as plain column expressions (no JSON), then each layer's
semantics as SQL.  Instants are DuckDB ``TIMESTAMP`` (UTC wall clock),
averages rounded to 6 decimals, counts cast to BIGINT.
"""

from __future__ import annotations

# The dump mapping as columns (one row per event).
EV = """
ev AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CAST(user_id % 10 AS INTEGER) AS link
  FROM events
)"""

DUMP = """
dump AS (
  SELECT
    'events' AS topic,
    CAST(user_id % 3 AS INTEGER) AS "partition",
    CAST(event_id AS BIGINT) AS "offset",
    '[1, ' || CAST(epoch_us(ts) // 1000 AS VARCHAR) || ']' AS kafka_timestamp_raw,
    CAST(user_id AS VARCHAR) AS kafka_key,
    ts + to_seconds(event_id % 97) AS dumped_at,
    ts + to_seconds(event_id % 31) AS ingested_at,
    link AS link_id,
    '/links/' || link AS href,
    CASE WHEN event_id % 40 = 1 THEN NULL ELSE 'road-' || link END AS name,
    'public-' || link AS public_name,
    CASE WHEN link % 2 = 0 THEN 'NB' ELSE 'SB' END AS direction,
    event_type <> 'error' AS enabled,
    CASE WHEN event_type = 'view' THEN NULL ELSE false END AS draft,
    CAST(1000 + 100 * link AS DOUBLE) AS length_m,
    CAST(CASE WHEN link = 9 THEN 0 ELSE 60 + link END AS DOUBLE) AS minimum_tt_seconds,
    CAST(1 + link % 4 AS INTEGER) AS min_number_of_lanes,
    link % 3 = 0 AS is_freeway,
    CAST(1000 + link AS BIGINT) AS origin_site_id,
    CAST(2000 + link AS BIGINT) AS destination_site_id,
    '[[' || link || ',' || (link + 1) || ']]' AS coordinates_json,
    event_id % 50 <> 0 AS has_stats,
    CASE WHEN event_id % 50 <> 0 THEN date_trunc('hour', ts) END AS interval_start,
    CASE WHEN event_id % 50 <> 0 THEN value - 5 END AS travel_time_seconds,
    CASE WHEN event_id % 50 <> 0 THEN value - 20 END AS delay_seconds,
    CASE WHEN event_id % 50 <> 0 THEN value END AS speed_kmh,
    CASE WHEN event_id % 50 <> 0 THEN value / 10 END AS density,
    CASE WHEN event_id % 50 <> 0 THEN value / 20 END AS average_density,
    CASE WHEN event_id % 50 <> 0 THEN CAST(k % 5 AS DOUBLE) END AS congestion_score,
    CASE WHEN event_id % 50 <> 0 THEN CAST(k AS DOUBLE) END AS estimated_percent,
    CASE WHEN event_id % 50 <> 0 THEN k % 3 <> 0 END AS enough_data,
    CASE WHEN event_id % 50 <> 0 THEN k % 7 = 0 END AS ignored,
    CASE WHEN event_id % 50 <> 0 THEN k % 11 = 0 END AS closed,
    CASE WHEN event_id % 50 <> 0 AND k % 2 <> 0 THEN k % 13 = 0 END AS expected_missing,
    event_id, ts, user_id, event_type, value, k
  FROM ev
)"""

# The live set: enabled, and no flag says otherwise.
LIVE = """enabled AND draft IS NOT TRUE AND ignored IS NOT TRUE
    AND closed IS NOT TRUE AND expected_missing IS NOT TRUE"""

# Silver semantics over the dump (live filter, derived measures, guards).
SILVER = """
derived AS (
  SELECT *,
    travel_time_seconds / 60.0 AS travel_time_minutes,
    (length_m / NULLIF(minimum_tt_seconds, 0)) * 3.6 AS free_flow_speed_kmh
  FROM dump
),
flagged AS (
  SELECT *,
    CASE WHEN speed_kmh IS NOT NULL AND minimum_tt_seconds > 0 AND length_m IS NOT NULL
              AND speed_kmh < 0.7 * free_flow_speed_kmh
              AND speed_kmh < length_m / NULLIF(minimum_tt_seconds, 0)
         THEN true ELSE false END AS potential_incident
  FROM derived
),
live AS (
  SELECT * FROM flagged
  WHERE """ + LIVE + """
),
silver AS (
  SELECT * FROM live
  WHERE interval_start IS NOT NULL AND COALESCE(travel_time_seconds >= 0, false)
    AND COALESCE(speed_kmh >= 0, false) AND COALESCE(length_m > 0, false)
),
dedup AS (
  SELECT * FROM silver
  QUALIFY row_number() OVER (PARTITION BY link_id, interval_start
                             ORDER BY dumped_at DESC, topic DESC, "partition" DESC, "offset" DESC) = 1
),
dim AS (
  SELECT link_id, href, name, public_name, direction, enabled, draft, length_m,
         min_number_of_lanes, minimum_tt_seconds, is_freeway, origin_site_id,
         destination_site_id, coordinates_json, dumped_at AS last_seen_at
  FROM dump WHERE link_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY link_id
                             ORDER BY dumped_at DESC, topic DESC, "partition" DESC, "offset" DESC) = 1
),
strict AS (
  SELECT *, COALESCE(name, public_name) AS road_name_fb,
         COALESCE(interval_start, ingested_at) AS event_time
  FROM flagged
  WHERE """ + LIVE + """
    AND enough_data = true AND delay_seconds > 60.0
)"""

FACT_SELECT = """
  SELECT s.link_id, s.interval_start, s.travel_time_seconds, s.delay_seconds, s.speed_kmh,
         {m}.density, {m}.average_density, {m}.congestion_score, {m}.estimated_percent,
         s.enough_data, s.ignored, s.closed, s.expected_missing,
         s.travel_time_minutes, s.free_flow_speed_kmh, s.potential_incident,
         d.name AS road_name, d.direction, d.is_freeway, d.length_m, d.minimum_tt_seconds,
         d.origin_site_id, d.destination_site_id, {m}.dumped_at,
         (epoch_us({m}.dumped_at) // 1000000) - (epoch_us(s.interval_start) // 1000000)
           AS event_to_dumped_latency_seconds
"""

FACT_ALL = """
fact AS (""" + FACT_SELECT.format(m="b") + """
  FROM dedup s
  LEFT JOIN dim d ON d.link_id = s.link_id
  LEFT JOIN dump b ON b.link_id = s.link_id AND b.interval_start = s.interval_start
)"""

FACT_LATEST = """
fact_latest AS (""" + FACT_SELECT.format(m="s") + """
  FROM dedup s
  LEFT JOIN dim d ON d.link_id = s.link_id
)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


BASE = with_ctes(EV, DUMP, SILVER)
BASE_FACT = with_ctes(EV, DUMP, SILVER, FACT_ALL, FACT_LATEST)

EXTRACT_COLS = ("link_id, name AS road_name, enabled, draft, interval_start, travel_time_seconds, "
                "delay_seconds, speed_kmh, enough_data, ignored, closed, expected_missing, "
                "length_m, minimum_tt_seconds")

SILVER_COLS = (EXTRACT_COLS + ", dumped_at, travel_time_minutes, free_flow_speed_kmh, potential_incident")

DEDUP_COLS = (EXTRACT_COLS + ", travel_time_minutes, free_flow_speed_kmh, potential_incident")

SQL: dict[str, str] = {}

SQL["bronze"] = BASE + """
SELECT topic, "partition", "offset", kafka_timestamp_raw, kafka_key, dumped_at, ingested_at,
       interval_start
FROM dump"""

# dirty variant: by event_id % 30: 2 offset -1, 3 topic NULL, 4 value NULL, 5 partition -1
SQL["bronze_expectations"] = """
WITH d AS (SELECT event_id % 30 AS m FROM events),
c AS (
  SELECT CAST(sum(CASE WHEN m = 5 THEN 1 ELSE 0 END) AS BIGINT) AS v_partition,
         CAST(sum(CASE WHEN m = 2 THEN 1 ELSE 0 END) AS BIGINT) AS v_offset,
         CAST(sum(CASE WHEN m = 3 THEN 1 ELSE 0 END) AS BIGINT) AS v_topic,
         CAST(sum(CASE WHEN m = 4 THEN 1 ELSE 0 END) AS BIGINT) AS v_value,
         CAST(sum(CASE WHEN m NOT IN (2, 3, 4, 5) THEN 1 ELSE 0 END) AS BIGINT) AS kept
  FROM d
)
SELECT 'valid_partition' AS rule, v_partition AS violations, kept FROM c
UNION ALL SELECT 'valid_offset', v_offset, kept FROM c
UNION ALL SELECT 'non_null_topic', v_topic, kept FROM c
UNION ALL SELECT 'non_null_value_str', v_value, kept FROM c"""

SQL["silver_extract"] = BASE + f"""
SELECT {EXTRACT_COLS}, "offset" FROM dump"""

SQL["silver"] = BASE + f"""
SELECT {SILVER_COLS}, "offset" FROM silver"""

SQL["silver_expectations"] = BASE + """
SELECT 'non_null_interval_start' AS rule,
       CAST(count(*) FILTER (WHERE interval_start IS NULL) AS BIGINT) AS violations FROM live
UNION ALL SELECT 'valid_travel_time',
       CAST(count(*) FILTER (WHERE NOT COALESCE(travel_time_seconds >= 0, false)) AS BIGINT) FROM live
UNION ALL SELECT 'valid_speed',
       CAST(count(*) FILTER (WHERE NOT COALESCE(speed_kmh >= 0, false)) AS BIGINT) FROM live
UNION ALL SELECT 'valid_length',
       CAST(count(*) FILTER (WHERE NOT COALESCE(length_m > 0, false)) AS BIGINT) FROM live"""

SQL["silver_incidents"] = BASE + """
SELECT link_id, potential_incident, count(*) AS n FROM silver GROUP BY ALL"""

SQL["congestion_flag"] = BASE + """
SELECT link_id,
       (speed_kmh IS NOT NULL AND free_flow_speed_kmh IS NOT NULL
        AND speed_kmh < 0.3 * free_flow_speed_kmh) AS congestion_flag,
       count(*) AS n
FROM derived GROUP BY ALL"""

SQL["silver_strict"] = BASE + """
SELECT link_id, road_name_fb AS road_name, event_time, delay_seconds, "offset" FROM strict"""

SQL["silver_strict_dedup"] = BASE + """
SELECT link_id, road_name_fb AS road_name, event_time, delay_seconds, "offset" FROM strict
QUALIFY row_number() OVER (PARTITION BY link_id, interval_start
                           ORDER BY dumped_at, topic, "partition", "offset") = 1"""

SQL["silver_dedup"] = BASE + f"""
SELECT {DEDUP_COLS} FROM dedup"""

SQL["dim_link"] = BASE + """
SELECT * FROM dim"""

SQL["fact_link_interval"] = BASE_FACT + """
SELECT * FROM fact"""

SQL["fact_link_interval_latest"] = BASE_FACT + """
SELECT * FROM fact_latest"""

SQL["delay_sliding"] = BASE_FACT + """
, w AS (
  SELECT road_name, delay_seconds,
         unnest([time_bucket(INTERVAL 5 MINUTE, interval_start),
                 time_bucket(INTERVAL 5 MINUTE, interval_start) - INTERVAL 5 MINUTE]) AS window_start
  FROM fact WHERE interval_start IS NOT NULL
)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, road_name,
       round(avg(delay_seconds), 6) AS avg_delay_seconds
FROM w GROUP BY window_start, road_name"""

SQL["monitor_5m"] = BASE + """
SELECT time_bucket(INTERVAL 5 MINUTE, dumped_at) AS window_start,
       time_bucket(INTERVAL 5 MINUTE, dumped_at) + INTERVAL 5 MINUTE AS window_end,
       count(*) AS records_processed,
       CAST(sum(CASE WHEN "partition" = 0 THEN 1 ELSE 0 END) AS BIGINT) AS partition_0_count,
       CAST(sum(CASE WHEN "partition" = 1 THEN 1 ELSE 0 END) AS BIGINT) AS partition_1_count,
       CAST(sum(CASE WHEN "partition" = 2 THEN 1 ELSE 0 END) AS BIGINT) AS partition_2_count,
       max(CASE WHEN "partition" = 0 THEN "offset" END) AS max_offset_p0,
       max(CASE WHEN "partition" = 1 THEN "offset" END) AS max_offset_p1,
       max(CASE WHEN "partition" = 2 THEN "offset" END) AS max_offset_p2,
       round(avg((epoch_us(dumped_at) // 1000000) - (epoch_us(ingested_at) // 1000000)), 6)
         AS avg_ingest_to_dump_latency_seconds,
       max((epoch_us(dumped_at) // 1000000) - (epoch_us(ingested_at) // 1000000))
         AS max_ingest_to_dump_latency_seconds,
       round(avg((epoch_us(dumped_at) // 1000000) - (epoch_us(interval_start) // 1000000)), 6)
         AS avg_event_to_dump_latency_seconds,
       max((epoch_us(dumped_at) // 1000000) - (epoch_us(interval_start) // 1000000))
         AS max_event_to_dump_latency_seconds
FROM dump
GROUP BY 1, 2"""

SQL["monitor_partitions"] = BASE + """
SELECT time_bucket(INTERVAL 5 MINUTE, dumped_at) AS window_start, "partition", count(*) AS n,
       max("offset") AS max_offset
FROM dump GROUP BY 1, 2"""

# ------------------------------------------------------------------ ingest shapes
SQL["scan_jsonl_dump"] = BASE + """
SELECT topic, "partition", "offset", kafka_key AS key, dumped_at FROM dump"""

# shapes: by event_id % 4: 0 wrapped in value, 1 wrapped in value_json, 2 bare, 3 '[1]'
SQL["normalize_payload"] = """
SELECT CAST(event_id AS BIGINT) AS "offset", CAST(user_id % 10 AS INTEGER) AS link_id,
       event_id % 4 IN (0, 1) AS wrapped
FROM events WHERE event_id % 4 <> 3"""

SQL["kafka_shape"] = BASE + """
SELECT "partition", "offset", CASE WHEN event_id % 25 = 0 THEN NULL ELSE kafka_key END AS key,
       link_id,
       CASE WHEN event_id % 33 = 0 AND name IS NOT NULL THEN name || chr(65533) ELSE name END AS road_name
FROM dump"""

SQL["kafka_out_frame"] = BASE + """
SELECT CAST(link AS VARCHAR) AS key, link AS link_id, 'travel_time_api' AS source_type FROM ev"""

# raw responses by event_id % 8: 0 [rec, 7]; 1 data:[rec]; 2 items:[rec, rec]; 3 rec; 4 results:[];
# 5 rec with data: "[1]"; 6 ["{...}", rec]; 7 rec with a link_id beyond 64 bits
RESPONSES = """
WITH r AS (
  SELECT event_id, user_id,
         CASE event_id % 8 WHEN 2 THEN 2 WHEN 4 THEN 0 ELSE 1 END AS cnt
  FROM events
), recs AS (
  SELECT event_id, user_id, unnest(range(cnt)) + CASE event_id % 8 WHEN 6 THEN 1 ELSE 0 END AS pos FROM r
)"""

SQL["extract_records"] = RESPONSES + """
SELECT event_id AS response_id, CAST(pos AS INTEGER) AS pos,
       'road-' || CAST(user_id % 10 AS INTEGER) AS road_name
FROM recs"""

# key field by event_id % 4: link_id int, linkId text, id float (skipped), ID int
SQL["guess_key"] = RESPONSES + """
SELECT event_id AS response_id, CAST(pos AS INTEGER) AS pos,
       CASE WHEN event_id % 8 = 7 THEN '12345678901234567890'
            WHEN event_id % 4 = 2 THEN NULL ELSE CAST(user_id % 10 AS VARCHAR) END AS key
FROM recs"""

SQL["build_envelope"] = """
SELECT 'travel_time_api' AS source_type, CAST(user_id % 10 AS INTEGER) AS link_id, ts AS ingested_at
FROM events"""

SQL["observations_flat"] = BASE + """
SELECT topic, "partition", "offset", kafka_key AS key,
       strftime(dumped_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS dumped_at,
       strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS ingested_at,
       strftime(interval_start + INTERVAL 11 HOUR, '%Y-%m-%dT%H:%M:%S') || '+11:00' AS interval_start,
       link_id, name AS road_name, travel_time_seconds, delay_seconds, speed_kmh, length_m,
       minimum_tt_seconds,
       CAST(enough_data AS INTEGER) AS enough_data, CAST(ignored AS INTEGER) AS ignored,
       CAST(closed AS INTEGER) AS closed, CAST(expected_missing AS INTEGER) AS expected_missing
FROM dump"""

SQL["schema_hints"] = BASE + """
, c AS (
  SELECT count(*) AS n_all,
         count(*) FILTER (WHERE name IS NOT NULL) AS n_name,
         count(*) FILTER (WHERE draft IS NOT NULL) AS n_draft,
         count(*) FILTER (WHERE has_stats) AS n_stats,
         count(*) FILTER (WHERE expected_missing IS NOT NULL) AS n_em
  FROM dump
), k AS (
  SELECT 'messages' AS level, 'seen' AS key, n_all AS n FROM c
  UNION ALL SELECT 'top', unnest(['ingested_at', 'source', 'payload']), n_all FROM c
  UNION ALL SELECT 'payload', unnest(['href', 'id', 'public_name', 'direction', 'enabled', 'length',
                                      'minimum_tt', 'min_number_of_lanes', 'is_freeway', 'origin',
                                      'destination', 'coordinates']), n_all FROM c
  UNION ALL SELECT 'payload', 'name', n_name FROM c
  UNION ALL SELECT 'payload', 'draft', n_draft FROM c
  UNION ALL SELECT 'payload', 'latest_stats', n_stats FROM c
  UNION ALL SELECT 'latest_stats', unnest(['interval_start', 'travel_time', 'delay', 'speed', 'density',
                                           'average_density', 'congestion', 'estimated_percent',
                                           'enough_data', 'ignored', 'closed']), n_stats FROM c
  UNION ALL SELECT 'latest_stats', 'expected_missing', n_em FROM c
)
SELECT level, key, CAST(n AS BIGINT) AS n FROM k WHERE n > 0"""

SQL["schema_hints_props"] = """
SELECT 'props' AS level, 'k' AS key, count(*) AS n FROM events"""

# ------------------------------------------------------------------ local load (replays)
SQL["load_insert_or_ignore"] = BASE + """
SELECT topic, "partition", "offset", dumped_at FROM dump"""

SQL["load_summary"] = """
SELECT CAST(5 AS BIGINT) AS files, count(*) AS inserted FROM events"""

SQL["bronze_upsert"] = BASE + """
SELECT topic, "partition", "offset", dumped_at FROM dump"""

# ------------------------------------------------------------------ health report
RECENT = BASE + """
, recent AS (
  SELECT * FROM dump WHERE dumped_at >= (SELECT max(dumped_at) FROM dump) - INTERVAL 120 MINUTE
)"""

SQL["dump_recent"] = RECENT + """
SELECT "partition", "offset", dumped_at FROM recent"""

SQL["dump_summary"] = RECENT + """
SELECT count(*) AS messages_seen FROM recent"""

for _m in (5, 7):
    SQL[f"dump_buckets_{_m}m"] = BASE + f"""
SELECT date_trunc('hour', dumped_at)
         + to_minutes(CAST(floor(minute(dumped_at) / {_m}) * {_m} AS BIGINT)) AS bucket,
       count(*) AS n
FROM dump GROUP BY 1"""

SQL["top_keys"] = BASE + """
SELECT kafka_key AS key, count(*) AS n FROM dump WHERE kafka_key IS NOT NULL
GROUP BY 1 ORDER BY n DESC, key LIMIT 10"""

# dirty with text ids, by event_id % 30: 2 offset -1, 5 partition -1, 6 partition 'x' (skipped)
SQL["max_offset_by_partition"] = """
SELECT CAST(CASE WHEN m = 5 THEN -1 ELSE user_id % 3 END AS INTEGER) AS "partition",
       max(CASE WHEN m = 2 THEN -1 ELSE event_id END) AS max_offset
FROM (SELECT *, event_id % 30 AS m FROM events) WHERE m <> 6 GROUP BY 1"""

LAG = """
WITH o AS (
  SELECT CAST(user_id % 3 AS INTEGER) AS "partition", min(event_id) AS begin_offset,
         max(event_id) + 1 AS end_offset
  FROM events GROUP BY 1
), c AS (
  SELECT *, CAST(CASE WHEN "partition" = 0 THEN end_offset
                      WHEN "partition" = 1 THEN begin_offset + (end_offset - begin_offset) // 2
                      ELSE -1001 END AS BIGINT) AS committed_offset
  FROM o
), l AS (
  SELECT "partition", begin_offset, end_offset, committed_offset,
         CAST(CASE WHEN committed_offset IS NULL OR committed_offset < 0 THEN end_offset - begin_offset
                   ELSE greatest(0, end_offset - committed_offset) END AS BIGINT) AS lag
  FROM c
)"""

SQL["consumer_lag"] = LAG + """
SELECT * FROM l"""

SQL["consumer_lag_totals"] = LAG + """
SELECT CAST(greatest(0, sum(end_offset) - sum(begin_offset)) AS BIGINT) AS available,
       CAST(sum(lag) AS BIGINT) AS lag
FROM l"""

# ------------------------------------------------------------------ dashboards
DASH = BASE + """
, frame AS (
  SELECT topic, "partition", "offset", interval_start, name AS road_name, delay_seconds, speed_kmh,
         travel_time_seconds, link_id, dumped_at
  FROM dump
), newest AS (
  SELECT * FROM frame ORDER BY interval_start DESC NULLS LAST, topic, "partition", "offset" LIMIT 1000
), win60 AS (
  SELECT * FROM frame WHERE interval_start IS NOT NULL
    AND interval_start >= (SELECT max(interval_start) FROM frame) - INTERVAL 60 MINUTE
), win AS (
  SELECT * FROM frame WHERE interval_start IS NOT NULL
    AND interval_start >= (SELECT max(interval_start) FROM frame) - INTERVAL 240 MINUTE
), mon AS (
  SELECT * FROM win WHERE dumped_at IS NOT NULL
), latest_road AS (
  SELECT road_name, interval_start, delay_seconds, speed_kmh FROM win WHERE road_name IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY road_name
                             ORDER BY interval_start DESC, topic DESC, "partition" DESC, "offset" DESC) = 1
)"""

SQL["dash_recent"] = DASH + """
SELECT * FROM newest"""

SQL["dash_window"] = DASH + """
SELECT * FROM win60"""

SQL["recent_50"] = DASH + """
SELECT * FROM win ORDER BY interval_start DESC NULLS LAST, topic, "partition", "offset" LIMIT 50"""

SQL["kpi_traffic"] = DASH + """
SELECT max(interval_start) AS latest, count(*) AS n, count(DISTINCT link_id) AS links,
       round(avg(delay_seconds), 6) AS avg_delay
FROM win"""

SQL["kpi_monitor"] = DASH + """
SELECT max(interval_start) AS latest, count(*) FILTER (WHERE dumped_at IS NOT NULL) AS n,
       round(avg((epoch_us(dumped_at) - epoch_us(interval_start)) / 1000000.0), 6) AS avg_lat,
       max((epoch_us(dumped_at) - epoch_us(interval_start)) / 1000000.0) AS max_lat
FROM win"""

SQL["delay_over_time"] = DASH + """
SELECT interval_start, round(avg(delay_seconds), 6) AS avg_delay FROM win GROUP BY 1"""

SQL["latest_by_road"] = DASH + """
SELECT * FROM latest_road"""

SQL["worst_delays"] = DASH + """
SELECT * FROM latest_road ORDER BY delay_seconds DESC NULLS LAST, road_name LIMIT 30"""

SQL["records_per_5m"] = DASH + """
SELECT time_bucket(INTERVAL 5 MINUTE, dumped_at) AS bucket, count(*) AS n FROM mon GROUP BY 1"""

SQL["partition_distribution"] = DASH + """
SELECT "partition", count(*) AS n FROM mon GROUP BY 1"""

SQL["dash_max_offsets"] = DASH + """
SELECT "partition", max("offset") AS max_offset FROM mon GROUP BY 1"""

# ------------------------------------------------------------------ streaming (same results as batch)
SQL["stream_bronze"] = SQL["bronze"]
SQL["stream_bronze_upsert"] = SQL["bronze_upsert"]
SQL["stream_incremental_load"] = SQL["load_insert_or_ignore"]
SQL["stream_silver_dedup"] = SQL["silver_dedup"]
SQL["stream_layered"] = SQL["silver_dedup"]
SQL["stream_fact"] = SQL["fact_link_interval"]
SQL["stream_delay_sliding_complete"] = SQL["delay_sliding"]
SQL["stream_monitor_5m"] = SQL["monitor_5m"]
SQL["stream_delay_sliding_update"] = SQL["delay_sliding"]
SQL["stream_monitor_update"] = SQL["monitor_5m"]

# half of the offsets is loaded, the rest has landed since
SQL["stream_consumer_lag"] = BASE + """
, half AS (
  SELECT CAST(floor((min("offset") + max("offset")) / 2) AS BIGINT) AS half FROM dump
), per AS (
  SELECT topic, "partition", min("offset") AS begin_offset, max("offset") + 1 AS end_offset,
         COALESCE(max("offset") FILTER (WHERE "offset" < half) + 1, -1001) AS committed_offset,
         count(*) FILTER (WHERE "offset" >= half) AS pending
  FROM dump, half GROUP BY 1, 2
)
SELECT *, CASE WHEN committed_offset < 0 THEN end_offset - begin_offset
               ELSE greatest(0, end_offset - committed_offset) END AS lag
FROM per"""

SQL["stream_dedup"] = BASE + """
SELECT DISTINCT link_id, interval_start FROM strict"""

# append mode + 30-minute watermark: exactly the windows whose end is at or
# before max(event_time) - 30 minutes are emitted
SQL["stream_delay_sliding"] = BASE + """
, sd AS (
  SELECT * FROM strict
  QUALIFY row_number() OVER (PARTITION BY link_id, interval_start
                             ORDER BY dumped_at, topic, "partition", "offset") = 1
), w AS (
  SELECT road_name_fb AS road_name, delay_seconds,
         unnest([time_bucket(INTERVAL 5 MINUTE, event_time),
                 time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE]) AS window_start
  FROM sd
)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, road_name,
       round(avg(delay_seconds), 6) AS avg_delay_seconds
FROM w
WHERE window_start + INTERVAL 10 MINUTE <= (SELECT max(event_time) FROM sd) - INTERVAL 30 MINUTE
GROUP BY window_start, road_name"""

SQL["stream_three_sinks"] = BASE + """
, sd AS (
  SELECT * FROM strict
  QUALIFY row_number() OVER (PARTITION BY link_id, interval_start
                             ORDER BY dumped_at, topic, "partition", "offset") = 1
), w AS (
  SELECT road_name_fb AS road_name, delay_seconds,
         unnest([time_bucket(INTERVAL 5 MINUTE, event_time),
                 time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE]) AS window_start
  FROM sd
)
SELECT window_start, window_start + INTERVAL 10 MINUTE AS window_end, road_name,
       round(avg(delay_seconds), 6) AS avg_delay_seconds
FROM w GROUP BY window_start, road_name"""
SQL["stream_expectations"] = SQL["bronze_expectations"]
SQL["stream_kpi_traffic"] = SQL["kpi_traffic"]
SQL["stream_publish"] = SQL["kafka_out_frame"]

SQL["land_dump"] = BASE + """
SELECT "partition", "offset", CASE WHEN event_id % 25 = 0 THEN NULL ELSE kafka_key END AS key, link_id, dumped_at
FROM dump"""
SQL["stream_land_dump"] = BASE + """
SELECT "partition", "offset", CASE WHEN event_id % 25 = 0 THEN NULL ELSE kafka_key END AS key, link_id
FROM dump"""

# the last fifth of the landing-time span comes before the fifth in front of
# it; what ends at or before max(dumped_at) - 30 minutes is emitted
SQL["stream_late_drop"] = BASE + """
, span AS (
  SELECT epoch_us(min(dumped_at)) AS lo, epoch_us(max(dumped_at)) AS hi, max(dumped_at) AS last FROM dump
), kept AS (
  SELECT dumped_at FROM dump, span
  WHERE epoch_us(dumped_at) < lo + CAST(floor((hi - lo) * 6 / 10) AS BIGINT)
     OR epoch_us(dumped_at) >= lo + CAST(floor((hi - lo) * 8 / 10) AS BIGINT)
)
SELECT time_bucket(INTERVAL 5 MINUTE, dumped_at) AS window_start, count(*) AS n
FROM kept GROUP BY 1
HAVING time_bucket(INTERVAL 5 MINUTE, dumped_at) + INTERVAL 5 MINUTE <= (SELECT last FROM span) - INTERVAL 30 MINUTE"""
SQL["stream_fact_upsert"] = SQL["fact_link_interval"]
SQL["stream_dedup_bounded"] = SQL["stream_dedup"]
SQL["stream_monitor_watermarked"] = "SELECT * FROM (" + SQL["monitor_5m"] + """)
WHERE window_end <= (SELECT max(ts + to_seconds(event_id % 97)) FROM events) - INTERVAL 30 MINUTE"""
