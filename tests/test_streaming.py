"""Stream = batch under split, shuffled and replayed input; late data."""

import pytest
from pyspark.sql import functions as F

from linkflow.operators import bronze as br
from linkflow.operators import silver as sv
from linkflow.plans.layers import Layers, run_batch
from linkflow.sources import fixture as fx
from linkflow.streaming import queries as sq
from linkflow.streaming import runner as rn
from tests.conftest import SF_SMALL
from tools.compare import same


def test_late_rows_are_dropped_by_watermark(spark):
    out, dropped, late = sq.late_drop_run(spark, SF_SMALL, count_late=True)
    assert 0 < dropped <= late
    # every row is emitted in a closed window, or landed late (and dropped),
    # or sits in a window the final watermark has not closed yet
    kept = out.agg(F.sum("n")).first()[0]
    dump = br.bronze(fx.dump_clean(fx.events(spark, SF_SMALL)))
    last = dump.agg(F.max("dumped_at")).first()[0]
    import datetime as dt
    open_from = last - dt.timedelta(minutes=30)
    open_from = open_from.replace(minute=open_from.minute - open_from.minute % 5, second=0, microsecond=0)
    still_open = dump.filter(F.col("dumped_at") >= F.lit(open_from)).count()
    assert kept + late + still_open == dump.count()


def test_insert_sink_is_idempotent_on_replayed_batches(spark):
    ws = rn.Workspace(spark, "idem")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    target = ws.path("t")
    fn = rn.insert_batches(target, transform=br.bronze)
    b = dump.filter(F.col("offset") < 500)
    fn(b, 0)
    fn(b, 0)          # the same batch retried after a failure
    fn(dump, 1)       # overlapping later batch
    fn(dump, 1)
    t = rn.table(spark, target)
    assert t.count() == dump.count()
    assert t.select("topic", "partition", "offset").distinct().count() == dump.count()


def test_latest_sink_is_order_independent(spark):
    ws = rn.Workspace(spark, "order")
    L = Layers.from_events(spark, SF_SMALL)
    sw = L.silver_wide
    keys, order = sq.DEDUP_KEYS, sq.DEDUP_ORDER
    a, b = ws.path("a"), ws.path("b")
    fa, fb = (rn.latest_batches(t, keys, order, sq.day()) for t in (a, b))
    parts = [sw.filter(F.col("offset") % 3 == r) for r in range(3)]
    for i, p in enumerate(parts):
        fa(p, i)
    for i, p in enumerate(reversed(parts)):
        fb(p, i)
    va = rn.table(spark, a).select(*sv.DEDUP_COLUMNS).toPandas()
    vb = rn.table(spark, b).select(*sv.DEDUP_COLUMNS).toPandas()
    vbatch = L.silver_dedup.toPandas()
    assert same(va, vb)[0]
    assert same(va, vbatch)[0]


def test_stream_bronze_equals_batch(spark):
    s = sq.q_stream_bronze(spark, SF_SMALL).toPandas()
    from linkflow.plans.catalog import q_bronze
    assert same(s, q_bronze(spark, SF_SMALL).toPandas())[0]


def test_run_batch_materialises_every_layer(spark):
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    paths = run_batch(spark, dump)
    assert set(paths) == {"traffic_bronze", "traffic_bronze_typed", "traffic_silver", "traffic_silver_dedup", "dim_link",
                          "fact_link_interval", "fact_kafka_monitor_5m", "traffic_delay_agg"}
    L = Layers(spark, dump)
    assert spark.read.parquet(paths["fact_link_interval"]).count() == L.fact("all").count()
    assert spark.read.parquet(paths["traffic_delay_agg"]).count() == L.delay_sliding().count()
    # the fact table is partitioned by day: a one-day read prunes files
    day = spark.read.parquet(paths["fact_link_interval"]).filter(F.col("interval_day") == "2024-01-02")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_bounded_dedup_keeps_one_row_per_key(spark):
    ws = rn.Workspace(spark, "bounded")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    src, target = ws.path("src"), ws.path("t")
    sq.land_parquet(dump.unionByName(dump.filter(F.col("offset") % 10 == 0)), src)
    strict = sv.silver_strict(br.bronze_typed(sq.source_stream(spark, src, dump.schema)))
    out = sq.dedup_stream(strict, watermark="30 minutes").select(*sq.DEDUP_KEYS, "offset")
    rn.append_parquet(out, target, ws.checkpoint("t"))
    got = spark.read.parquet(target)
    assert got.count() == got.select(*sq.DEDUP_KEYS).distinct().count() > 0


def test_layers_run_side_by_side(spark, monkeypatch):
    seen = []
    drain = rn.drain
    monkeypatch.setattr(rn, "drain", lambda *q: (seen.append(len(spark.streams.active)), drain(*q)))
    sq.q_stream_layered(spark, SF_SMALL)
    assert max(seen) == 3 and not spark.streams.active


def test_processing_time_stream_picks_up_new_landings(spark):
    ws = rn.Workspace(spark, "ticks")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    src, target = ws.path("src"), ws.path("t")
    sq.land_parquet(dump.filter(F.col("offset") < 400), src)
    q = rn.append_parquet(br.bronze(sq.source_stream(spark, src, dump.schema)), target, ws.checkpoint("t"),
                          every="1 second")
    try:
        rn.drain(q)
        assert spark.read.parquet(target).count() == dump.filter(F.col("offset") < 400).count()
        sq.land_parquet(dump.filter(F.col("offset") >= 400), src)
        rn.drain(q)
        assert q.isActive and spark.read.parquet(target).count() == dump.count()
    finally:
        q.stop()


def test_source_bounds_micro_batches(spark):
    ws = rn.Workspace(spark, "bounds")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    src, target = ws.path("src"), ws.path("t")
    sq.land_parquet(dump.repartition(4), src)
    q = rn.append_parquet(br.bronze(sq.source_stream(spark, src, dump.schema, max_files=1)), target, ws.checkpoint("t"))
    assert len([p for p in q.recentProgress if p.numInputRows]) == 4
    assert spark.read.parquet(target).count() == dump.count()


def test_fact_rebuild_reads_touched_days_of_typed_bronze(spark):
    ws = rn.Workspace(spark, "fact-plan")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    tables = sq.FactTables(spark, ws.path("tables"))
    tables(dump.filter(F.col("offset") % 2 == 1), 0)
    tables(dump.filter(F.col("offset") % 2 == 0), 1)
    tables(dump.filter(F.col("offset") % 2 == 0), 1)  # a retried batch changes nothing
    want = Layers(spark, dump).fact("all")
    assert same(tables.fact.rows().toPandas(), want.toPandas())[0]
    now = tables.typed.pointer()
    some = sorted(now.folders)[3]
    read = tables.rebuilt([some], now)
    assert "from_json" not in read._jdf.queryExecution().executedPlan().toString()
    files = [f for f in read.inputFiles() if "/typed/" in f]
    assert files and all(f"/{some}/" in f for f in files)


def test_fact_rebuild_reads_written_winners(spark):
    """The winners of a key are found once; a record without a day, or with a key that
    repeats, changes nothing about that."""
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    dump = dump.unionByName(dump.filter(F.col("offset") % 9 == 0)).unionByName(
        dump.limit(1).withColumn("value", F.lit('{"payload":{"id":3,"enabled":true}}')))
    tables = sq.FactTables(spark, rn.Workspace(spark, "fact-winners").path("tables"))
    for r in (1, 0):
        tables(dump.filter(F.col("offset") % 2 == r), 1 - r)
    want = Layers(spark, dump)
    assert same(tables.fact.rows().toPandas(), want.fact("all").toPandas())[0]
    assert same(tables.winners.rows().select("link_id", "interval_start", "offset").toPandas(),
                want.dedup_wide.select("link_id", "interval_start", "offset").toPandas())[0]
    now = tables.typed.pointer()
    plan = tables.rebuilt(sorted(now.folders), now)
    # the dimension's winners are the only ones that the plan still finds
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("max_by(") == 1
    assert any("/winners/" in f for f in plan.inputFiles())


def test_renamed_road_reaches_old_days(spark):
    """A link renamed by a record of a later day: the fact's old days, which no record
    touches, have the new name, and only the link's own days are rewritten."""
    ws = rn.Workspace(spark, "rename")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    tables = sq.FactTables(spark, ws.path("tables"))
    tables(dump, 0)
    before = tables.fact.pointer()
    link = tables.fact.rows().select("link_id").first()[0]
    own = {f"bucket={r[0]}" for r in tables.typed.rows().filter(F.col("link_id") == link)
           .select(F.to_date("interval_start").cast("string")).distinct().collect()}
    late = dump.filter((F.col("key").cast("int") % 10 == link)).limit(1) \
        .withColumn("value", F.regexp_replace("value", '"name":"[^"]*"', '"name":"renamed"')) \
        .withColumn("value", F.regexp_replace("value", '"interval_start":"[^"]*"', '"interval_start":"2031-01-01T00:00:00Z"')) \
        .withColumn("dumped_at", F.lit("2031-01-01T00:00:01.000000+00:00")).withColumn("offset", F.lit(10**9))
    late = spark.createDataFrame(late.collect(), late.schema)
    if "renamed" not in late.first().value:  # the record has no name: give it one
        late = late.withColumn("value", F.regexp_replace("value", '"public_name"', '"name":"renamed","public_name"'))
    tables(late, 1)
    want = Layers(spark, dump.unionByName(late)).fact("all")
    got = tables.fact.rows()
    assert same(got.toPandas(), want.toPandas())[0]
    assert {r[0] for r in got.filter(F.col("link_id") == link).select("road_name").distinct().collect()} == {"renamed"}
    after = tables.fact.pointer()
    rewritten = {b for b in before.folders if before.folders[b] != after.folders.get(b)}
    assert rewritten == own & set(before.folders) and len(rewritten) < len(before.folders)


def test_fact_goes_on_after_a_failure_between_its_tables(spark, monkeypatch):
    ws = rn.Workspace(spark, "fact-retry")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    tables = sq.FactTables(spark, ws.path("tables"))
    tables(dump.filter(F.col("offset") % 2 == 1), 0)
    rest = dump.filter(F.col("offset") % 2 == 0)
    for broken in ("dim", "days", "fact"):
        name = "replace" if broken == "fact" else "upsert" if broken == "dim" else "insert_first"
        with monkeypatch.context() as m:
            m.setattr(getattr(tables, broken), name, lambda *a, **k: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                tables(rest, 1)
    tables(rest, 1)
    assert same(tables.fact.rows().toPandas(), Layers(spark, dump).fact("all").toPandas())[0]


def test_dedup_state_stops_growing(spark):
    """With the watermark, keys leave the state as event time moves on."""
    ws = rn.Workspace(spark, "state")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    t = F.unix_micros(F.col("dumped_at").try_cast("timestamp"))
    lo, hi = dump.agg(F.min(t), F.max(t)).first()
    src, target = ws.path("src"), ws.path("t")
    states, keys = [], 0
    for i in range(4):
        step = dump.filter((t >= lo + (hi - lo) * i // 4) & (t < lo + (hi - lo) * (i + 1) // 4 + (i == 3)))
        sq.land_parquet(step, src)
        strict = sv.silver_strict(br.bronze_typed(sq.source_stream(spark, src, dump.schema)))
        out = sq.dedup_stream(strict, watermark="30 minutes").select(*sq.DEDUP_KEYS, "event_time")
        q = rn.append_parquet(out, target, ws.checkpoint("t"))
        states.append(q.recentProgress[-1].stateOperators[0].numRowsTotal)
        keys = spark.read.parquet(target).count()
    assert max(states) < keys / 2


def test_missing_table_is_none_and_other_errors_are_raised(spark, tmp_path):
    assert rn.read_table(spark, str(tmp_path / "nothing")) is None
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        rn.read_table(spark, str(tmp_path / "bad"))


def test_events_are_dealt_whatever_the_row_groups(spark, tmp_path):
    """Many splits of a file with one row group are one task with rows; so are rows of one id."""
    spark.range(0, 40_000, 1, 1).selectExpr(
        "IF(id < 20000, NULL, id) AS event_id", "CAST(timestamp_seconds(id) AS timestamp_ntz) AS ts", "id AS user_id",
        "'view' AS event_type", "CAST(xxhash64(id) AS double) AS value", "'{\"k\": 1}' AS props") \
        .write.parquet(f"{tmp_path}/events.parquet")
    key = "spark.sql.files.maxPartitionBytes"
    spark.conf.set(key, "65536")
    try:
        ev = fx.events(spark, str(tmp_path))
        n = [r[1] for r in ev.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset(key)
    assert sum(n) == 40_000 and max(n) < 20_000


def test_runs_read_small_tasks_and_the_session_keeps_its_settings(spark, tmp_path):
    src = f"{tmp_path}/src"
    spark.range(0, 1200, 1, 12).write.parquet(src)
    before, parts = {k: spark.conf.get(k, None) for k in rn.TASK_BYTES}, []
    rn.foreach_batch(sq.source_stream(spark, src, "id bigint"), lambda b, _: parts.append(b.rdd.getNumPartitions()),
                     f"{tmp_path}/check")
    assert parts == [6]  # two files each, at 4 MB a file opened
    assert {k: spark.conf.get(k, None) for k in rn.TASK_BYTES} == before


def test_publishing_builds_records_after_the_rows_are_dealt(spark):
    """The steps' filter on a record is not pushed into the tasks that scan."""
    records = fx.provider_records(fx.events(spark, SF_SMALL))
    steps = sq.landing_steps(records)
    for step in steps:
        above, below = step._jdf.queryExecution().optimizedPlan().toString().split("Repartition ")
        assert "structs" in above.lower() and "structs" not in below.lower()
    assert sum(s.count() for s in steps) == records.count()
