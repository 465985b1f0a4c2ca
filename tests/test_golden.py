"""Hand-written golden rows (FIXTURES.md section 4)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from linkflow.operators import bronze as br
from linkflow.operators import health as hl
from linkflow.operators import ingest as ig
from linkflow.operators import silver as sv
from linkflow.operators.latest import latest_by
from linkflow.operators.load import load_observations
from linkflow.schemas import DUMP_TYPED_SCHEMA, OFFSETS_SCHEMA
from linkflow.sources import jsonl
from linkflow.sources.kafka import kafka_options, shape_kafka

# One landed line of our own making, the envelope only in value_json: a link
# of 900 m that takes 50 s at free flow (64.8 km/h), driven in 90 s.
SAMPLE = {
    "topic": "roads", "partition": 2, "offset": 41, "timestamp": [1, 1700000000000], "key": "58",
    "value_json": {
        "ingested_at": "2025-03-04T05:06:07.500000+00:00",
        "payload": {"href": "/links/58", "id": 58, "name": "Quay Street", "enabled": True, "draft": False,
                    "length": 900, "minimum_tt": 50, "direction": "SB",
                    "latest_stats": {"interval_start": "2025-03-04T07:05:00+02:00", "travel_time": 90,
                                     "delay": 40, "speed": 36, "enough_data": True, "ignored": False,
                                     "closed": False, "expected_missing": False}}},
    "dumped_at": "2025-03-04T05:06:09.250000+00:00",
}


def dump_of(spark, records):
    """Dump frame from python dicts (value_json kept as JSON text)."""
    rows = []
    for r in records:
        vj = r.get("value_json")
        rows.append((r.get("topic"), r.get("partition"), r.get("offset"), r.get("timestamp"), r.get("key"),
                     r.get("value"), json.dumps(vj) if vj is not None else None, r.get("dumped_at")))
    return spark.createDataFrame(rows, DUMP_TYPED_SCHEMA)


def envelope(payload, ingested="2025-03-04T05:06:08.500000+00:00"):
    return json.dumps({"ingested_at": ingested, "payload": payload})


def rec(offset, value, dumped_at="2025-03-04T05:07:00+00:00", key="3"):
    return {"topic": "t", "partition": 0, "offset": offset, "timestamp": [1, 0], "key": key,
            "value": value, "dumped_at": dumped_at}


def test_sample_line_through_silver(spark):
    d = dump_of(spark, [SAMPLE])
    b = br.bronze_parsed(d)
    assert b.count() == 1  # value_json-only record survives the bronze guards
    s = sv.silver(br.typed(b)).collect()
    assert len(s) == 1
    r = s[0]
    assert r.link_id == 58
    assert r.interval_start == dt.datetime(2025, 3, 4, 5, 5)  # UTC session, naive UTC
    assert (r.travel_time_seconds, r.delay_seconds, r.speed_kmh) == (90.0, 40.0, 36.0)
    assert r.free_flow_speed_kmh == pytest.approx(64.8)
    assert r.potential_incident is False  # 36 is below 0.7 * 64.8, but not below 900 / 50 (m/s)


# Fixed values: (begin, end, committed) offsets and the lag that they mean.
@pytest.mark.parametrize("begin,end,committed,lag", [(0, 72, 27, 45), (0, 72, -1001, 72), (0, 10, 12, 0),
                                                     (5, 9, None, 4)])
def test_consumer_lag(spark, begin, end, committed, lag):
    off = spark.createDataFrame([(0, begin, end, committed)], OFFSETS_SCHEMA)
    assert hl.consumer_lag(off).first().lag == lag


def test_lag_totals(spark):
    off = spark.createDataFrame([(0, 0, 72, 27), (1, 0, 72, -1001), (2, 10, 10, 10)], OFFSETS_SCHEMA)
    t = hl.lag_totals(hl.consumer_lag(off)).first()
    assert (t.available, t.lag) == (144, 45 + 72)


def test_bad_lines_skipped(spark, tmp_path):
    folder = str(tmp_path)
    good = json.dumps({**SAMPLE, "value_json": SAMPLE["value_json"]})
    lines = spark.createDataFrame([(good,), ("",), ("   ",), ("not json",), ("[1]",), ('[{"topic":"x"}]',)],
                                  "value string")
    jsonl.write_jsonl(lines, folder, "traffic_raw_0001.jsonl")
    jsonl.write_jsonl(lines, folder, "other_0001.jsonl")
    got = jsonl.read_jsonl_dump(spark, folder, topic="traffic_raw").collect()
    assert len(got) == 1 and got[0].offset == "41"
    assert jsonl.read_jsonl_dump(spark, folder).count() == 2  # every topic


def test_unwrapped_record_is_its_own_payload(spark):
    d = dump_of(spark, [rec(1, json.dumps({"id": 3, "name": "x"})), rec(2, envelope({"id": 4})),
                        rec(3, "[1]"), rec(4, None)])
    n = ig.normalize_payload(d).orderBy("offset").collect()
    assert [(r.offset, r.wrapped) for r in n] == [(1, False), (2, True)]
    assert json.loads(n[0].payload_json)["id"] == 3


def test_no_latest_stats_kept_in_bronze_dropped_in_silver(spark):
    d = dump_of(spark, [rec(1, envelope({"id": 3, "enabled": True, "length": 10}))])
    b = br.bronze_parsed(d)
    assert b.count() == 1
    assert sv.silver(br.typed(b)).count() == 0


def test_zero_minimum_tt(spark):
    p = {"id": 3, "enabled": True, "length": 2000, "minimum_tt": 0,
         "latest_stats": {"interval_start": "2026-01-01T10:00:00+00:00", "travel_time": 10, "speed": 1}}
    s = sv.silver(br.bronze_typed(dump_of(spark, [rec(1, envelope(p))]))).first()
    assert s.free_flow_speed_kmh is None and s.potential_incident is False


def test_invalid_utf8_is_replaced(spark):
    rows = spark.createDataFrame([(bytearray(b""), bytearray(b"a\xffb"), "t", 0, 1, dt.datetime(2026, 1, 1), 0),
                                  (None, None, "t", 0, 2, dt.datetime(2026, 1, 1), 0)],
                                 "key binary, value binary, topic string, partition int, offset long, "
                                 "timestamp timestamp, timestampType int")
    got = shape_kafka(rows).orderBy("offset").collect()
    assert got[0].key is None and got[0].value == "a�b"
    assert got[1].key is None and got[1].value == ""


def test_out_of_order_cdc_keeps_latest(spark):
    p = {"id": 3, "enabled": True, "length": 10, "minimum_tt": 5,
         "latest_stats": {"interval_start": "2026-01-01T10:00:00+00:00", "travel_time": 10, "speed": 1,
                          "delay": 1}}
    p2 = json.loads(json.dumps(p))
    p2["latest_stats"]["delay"] = 2
    d = dump_of(spark, [rec(1, envelope(p2), dumped_at="2026-01-01T10:10:00+00:00"),   # t2 arrives first
                        rec(2, envelope(p), dumped_at="2026-01-01T10:05:00+00:00")])   # t1 later
    got = sv.silver_dedup(sv.silver_wide(br.bronze_typed(d))).collect()
    assert len(got) == 1 and got[0].delay_seconds == 2.0


def test_hour_local_bucket_differs_from_epoch_window(spark):
    df = spark.createDataFrame([("2026-01-01T10:05:00+00:00",)], "dumped_at string")
    b = hl.buckets(hl.landed(df), 7).first().bucket
    assert b == dt.datetime(2026, 1, 1, 10, 0)
    w = df.select(F.window(F.col("dumped_at").cast("timestamp"), "7 minutes").start.alias("s")).first().s
    assert w == dt.datetime(2026, 1, 1, 10, 2)


def test_strict_event_time_falls_back_to_ingested_at(spark):
    p = {"id": 3, "enabled": True, "length": 10, "minimum_tt": 5,
         "latest_stats": {"enough_data": True, "delay": 90}}
    d = dump_of(spark, [rec(1, envelope(p, ingested="2026-01-01T09:00:00+00:00"))])
    b = br.bronze_parsed(d)
    st = sv.silver_strict(br.typed(b)).collect()
    assert len(st) == 1 and st[0].event_time == dt.datetime(2026, 1, 1, 9, 0)
    assert sv.silver(br.typed(b)).count() == 0


def test_json_text_boolean(spark):
    p = {"id": 3, "enabled": True, "length": 10, "minimum_tt": 5,
         "latest_stats": {"interval_start": "2026-01-01T10:00:00+00:00", "travel_time": 10, "speed": 1,
                          "ignored": "false", "closed": False}}
    d = dump_of(spark, [rec(1, envelope(p))])
    s = sv.silver(br.bronze_typed(d)).collect()
    assert len(s) == 1 and s[0].ignored is False  # text "false" casts to false: kept
    o = load_observations(d).first()
    assert o.ignored is None and o.closed == 0  # strict flags: only JSON booleans count


def test_guess_key_types(spark):
    recs = ['{"link_id": 7}', '{"linkId": "a7"}', '{"id": 7.5, "ID": 9}', '{"id": true}',
            '{"id": {"x": 1}}', '{"id": null}', '{"name": "x"}', '{"id": 12345678901234567890}',
            '{"id": -%s}' % ("9" * 45), '{"id": 5.0}', '{"id": 1e3, "ID": 4}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(recs)], "i int, r string")
    got = [x.k for x in df.select("i", ig.guess_key(F.col("r")).alias("k")).orderBy("i").collect()]
    assert got == ["7", "a7", "9", "True", None, None, None, "12345678901234567890", "-" + "9" * 45, None, "4"]


def test_extract_records_shapes(spark):
    bodies = ['[{"a":1}, 7, {"a":2}]', '{"data": [{"a":1}]}', '{"results": []}', '{"a": 1}',
              '{"items": "x", "features": [{"a":3}]}', '7',
              '{"data":"[1]","id":5}', '{"data":"[note]","id":6}', '["{\\"id\\":1}", {"b": "[x]"}]', '"[1]"', 'null']
    df = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "response_id int, body string")
    got = sorted((r.response_id, r.pos) for r in ig.extract_records(df).collect())
    # a string is no list and no object, whatever it holds
    assert got == [(0, 0), (0, 2), (1, 0), (3, 0), (4, 0), (6, 0), (7, 0), (8, 1)]
    texts = {r.response_id: r.record for r in ig.extract_records(df).collect()}
    assert texts[6] == bodies[6] and json.loads(texts[8]) == {"b": "[x]"}


def test_schema_hints_need_objects(spark):
    bodies = ['{"payload": "{\\"a\\": 1}"}', '{"payload": {"b": 1, "latest_stats": "{\\"c\\": 2}"}}',
              '{"payload": {"latest_stats": {"d": 1}}}', '"x"']
    hints = ig.schema_hints(dump_of(spark, [rec(i, b) for i, b in enumerate(bodies)]))
    assert {(r.level, r.key, r.n) for r in hints.collect()} == {
        ("messages", "seen", 4), ("top", "payload", 3), ("payload", "b", 1), ("payload", "latest_stats", 2),
        ("latest_stats", "d", 1)}


def test_load_summary_counts_files_without_a_valid_line(spark, tmp_path):
    from linkflow.operators.load import load_summary
    good = dump_of(spark, [SAMPLE])
    jsonl.land_dump(good, str(tmp_path), "roads_0001.jsonl")
    jsonl.write_jsonl(spark.createDataFrame([("not json",)], "value string"), str(tmp_path), "roads_0002.jsonl")
    d = jsonl.read_jsonl_dump(spark, str(tmp_path), with_file=True)
    r = load_summary(d, jsonl.landed_files(spark, str(tmp_path))).first()
    assert (r.files, r.inserted) == (2, 1)


def test_unreadable_landing_time_does_not_win(spark):
    p = {"id": 3}
    d = dump_of(spark, [rec(1, envelope(p | {"name": "late"}), "soon"), rec(1, envelope(p | {"name": "first"}))])
    assert [r.road_name for r in load_observations(d).collect()] == ["first"]


def test_kafka_options_from_env():
    env = {"KAFKA_BOOTSTRAP_SERVERS": "b:9092", "KAFKA_SECURITY_PROTOCOL": "SASL_SSL",
           "KAFKA_SASL_MECHANISM": "PLAIN", "KAFKA_SASL_USERNAME": "u", "KAFKA_SASL_PASSWORD": "p",
           "KAFKA_EXTRA_CONFIG__client__id": "me", "KAFKA_ENABLE_IDEMPOTENCE": "no"}
    o = kafka_options(env)
    assert o["kafka.bootstrap.servers"] == "b:9092"
    assert o["kafka.security.protocol"] == "SASL_SSL"
    assert 'username="u"' in o["kafka.sasl.jaas.config"]
    assert o["kafka.client.id"] == "me"
    assert "kafka.enable.idempotence" not in o


def test_kafka_login_is_escaped_and_complete():
    o = kafka_options({"KAFKA_SASL_USERNAME": 'a"b', "KAFKA_SASL_PASSWORD": "c\\d"})
    assert o["kafka.sasl.jaas.config"].endswith('username="a\\"b" password="c\\\\d";')
    with pytest.raises(ValueError):
        kafka_options({"KAFKA_SASL_USERNAME": "u"})


def test_latest_by_ties_resolved_by_tiebreak(spark):
    df = spark.createDataFrame([(1, 5, 1, "a"), (1, 5, 2, "b"), (2, None, 3, "c"), (2, 1, 1, "d")],
                               "k int, seq int, off int, v string")
    got = {r.k: r.v for r in latest_by(df, ["k"], ["seq", "off"]).collect()}
    assert got == {1: "b", 2: "d"}
