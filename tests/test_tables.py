"""Tables under micro-batches, growing landing files, and what a load says of itself."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from linkflow.operators import bronze as br
from linkflow.operators import gold as gd
from linkflow.sources import fixture as fx
from linkflow.sources import growing, jsonl
from linkflow.streaming import queries as sq
from linkflow.streaming import runner as rn
from linkflow.streaming.table import BLOCK, OffsetTable, Pointer, VersionedTable, seq_runs
from tests.conftest import SF_SMALL


def line(offset, partition=0, topic="events", at="2025-03-04T05:06:07+00:00"):
    return f'{{"topic":"{topic}","partition":{partition},"offset":{offset},"value":"{{}}","dumped_at":"{at}"}}\n'


def loaded(spark, load):
    return sorted(r.offset for r in rn.table(spark, load.target).select("offset").collect())


# ------------------------------------------------------------------ growing files
def test_lines_appended_to_a_seen_file_are_loaded(spark):
    load = sq.LandingLoad(rn.Workspace(spark, "grow"), split_bytes=64)
    os.makedirs(folder := growing.open_fs(load.folder)[1])
    with open(f"{folder}/events_1.jsonl", "w") as f:
        f.write(line(1) + line(2))
        f.flush()
        load.run()
        assert loaded(spark, load) == [1, 2]
        f.write(line(3) + line(4) + line(5)[:30])  # the last line is still being written
        f.flush()
        load.run()
        assert loaded(spark, load) == [1, 2, 3, 4]
        load.run()  # nothing new
        f.write(line(5)[30:] + "broken line\n\n" + line(3))
        f.flush()
    os.makedirs(f"{folder}/events_2.jsonl")
    with open(f"{folder}/events_2.jsonl/part-0", "w") as f:
        f.writelines(line(k) for k in range(100, 200))
    with open(f"{folder}/other_1.jsonl", "w") as f:
        f.write(line(999, topic="other"))
    load.run()
    assert loaded(spark, load) == [1, 2, 3, 4, 5, *range(100, 200)]


def test_an_offset_means_the_same_bytes_after_a_restart(spark, tmp_path):
    """A batch that was planned before a crash reads the same lines when it is planned again."""
    folder, ledger = str(tmp_path / "landing"), str(tmp_path / "ledger")
    os.makedirs(folder)
    with open(f"{folder}/events_1.jsonl", "w") as f:
        f.write("a\nb\n")
        f.flush()
        options = {"path": folder, "ledger": ledger}
        planned = growing.GrowingStream(options).latestOffset()
        f.write("c\n")
        f.flush()
        again = growing.GrowingStream(options)
        lines = lambda start, end: [v for p in again.partitions(start, end) for b in again.read(p)
                                    for v in b.column("value").to_pylist()]
        assert lines(again.initialOffset(), planned) == ["a", "b"]
        newest = again.latestOffset()
        assert lines(planned, newest) == ["c"] and again.latestOffset() == newest
        again.commit(newest)
        assert growing.Ledger(ledger).versions() == [newest["ledger"]]
    with open(f"{folder}/events_1.jsonl", "w") as f:
        f.write("new\n")  # the file was replaced by a shorter one
    assert lines(newest, again.latestOffset()) == ["new"]


@pytest.mark.parametrize("step", [1, 2, 3, 7, 50, 10_000])
def test_splits_hold_every_line_once(tmp_path, step):
    texts = ["", "x", "yy\r", "é" * 9, "", "z" * 40, "last"] * 5
    (tmp_path / "a.jsonl").write_text("".join(t + "\n" for t in texts), newline="")
    landing = growing.Landing({"path": str(tmp_path)})
    to = landing.read_to({})
    got = [v for s in landing.splits({}, to, step) for _, v in landing.lines(s)]
    assert [v.decode() for v in got] == texts


@pytest.mark.parametrize("step", [1, 4, 9, 10_000])
def test_splits_give_blocks_of_lines(tmp_path, monkeypatch, step):
    monkeypatch.setattr(growing, "BATCH_BYTES", 7)
    lines = [b"", b"one", b"", b"no \xff UTF-8", "é".encode() * 9, b"z" * 40] * 3
    (tmp_path / "a.jsonl").write_bytes(b"".join(v + b"\n" for v in lines) + b"torn")
    options = {"path": str(tmp_path)}
    landing = growing.Landing(options)
    splits = landing.splits({}, landing.read_to({}), step)
    starts = [sum(len(v) + 1 for v in lines[:i]) for i in range(len(lines))]
    got = [(at, v) for s in splits for a, t in landing.blocks(s) for at, v in zip(a.tolist(), t.to_pylist(), strict=True)]
    assert got == list(zip(starts, lines, strict=True))
    rows = [r for s in splits for b in growing._batches(options, s) for r in b.to_pylist()]
    assert rows == [{"value": v.decode("utf-8", "replace"), "source_file": "a.jsonl", "start": at}
                    for at, v in got]


def test_append_lines_ends_a_torn_line(spark, tmp_path):
    folder = str(tmp_path)
    lines = spark.range(3).repartition(1).select(F.col("id").cast("string"))
    growing.append_lines(lines, folder, "a.jsonl")
    part = next((tmp_path / "a.jsonl").iterdir())
    part.write_text(part.read_text() + "torn")
    growing.append_lines(lines, folder, "a.jsonl")
    assert sorted(part.read_text().split()) == sorted(["0", "1", "2", "torn", "0", "1", "2"])


# ------------------------------------------------------------------ offset runs
def test_runs_have_no_gaps_and_end_with_blocks(spark):
    rows = [("t", 0, o) for o in (1, 2, 3, 3, 7, 8, 20)] + [("t", 1, BLOCK - 1), ("t", 1, BLOCK), ("t", 0, None)]
    runs = seq_runs(spark.createDataFrame(rows, "topic string, partition int, offset bigint"), ["topic", "partition"], "offset")
    assert sorted((r.partition, r.lo, r.hi) for r in runs.collect()) == [
        (0, 1, 3), (0, 7, 8), (0, 20, 20), (1, BLOCK - 1, BLOCK - 1), (1, BLOCK, BLOCK)]


def test_sparse_replay_reads_only_the_versions_that_hold_it(spark):
    """Two batches with interleaved offsets; a replay of every 20th offset is in one of them."""
    ws = rn.Workspace(spark, "sparse")
    table = OffsetTable(spark, ws.path("t"))
    dump = br.bronze(fx.dump_clean(fx.events(spark, SF_SMALL)))
    table.insert(dump.filter("offset % 2 = 0"), 0)
    table.insert(dump.filter("offset % 2 = 1"), 1)
    replay = dump.filter("offset % 20 = 0")
    met = table.colliding(seq_runs(replay, table.range_keys, "offset"), table.pointer())
    assert met and {v for v, _ in met} == {1}  # the first version alone
    read = table.rows(folders=met)
    assert read.count() == dump.filter("offset % 2 = 0").count()
    assert all("version=1/" in f for f in read.inputFiles())
    table.insert(replay, 2)
    assert table.rows().count() == dump.count()
    strange = dump.limit(5).withColumn("topic", F.lit("a=b/c %"))
    table.insert(strange, 3)
    table.insert(strange, 4)
    assert table.rows().count() == dump.count() + 5


def test_batches_without_new_rows_leave_nothing(spark):
    table = OffsetTable(spark, rn.Workspace(spark, "known").path("t"))
    rows = spark.createDataFrame([("t", 0, k) for k in range(9)], "topic string, partition int, offset bigint")
    for batch in range(12):
        table.insert(rows if batch % 2 == 0 else rows.limit(0), batch)
    assert table.rows().count() == 9 and table.files.names("data") == ["version=1"]
    assert len(table.files.names("runs")) <= 6 and len(table.files.names("versions")) <= 4


def test_null_ids_are_never_known(spark):
    table = OffsetTable(spark, rn.Workspace(spark, "nulls").path("t"))
    rows = spark.createDataFrame([("t", 0, None), ("t", None, 1), (None, 0, 1), ("t", 0, 1)],
                                 "topic string, partition int, offset bigint")
    for batch in range(3):
        table.insert(rows, batch)
    assert table.rows().count() == 3 * 3 + 1


# ------------------------------------------------------------------ versions
def folders(root):
    path = growing.open_fs(root)[1]
    return sum(len(d) for _, d, _ in os.walk(path))


def test_many_batches_leave_few_folders_while_a_reader_runs(spark):
    ws = rn.Workspace(spark, "many")
    table = VersionedTable(spark, ws.path("t"), F.col("k") % 3, fanout=4)
    wrong, stop, most = [], threading.Event(), 0

    def reader():
        while not stop.is_set():
            held = VersionedTable(spark, table.root, table.bucket).read()
            if held is not None:  # a version: every key once, all with one batch's values
                rows = [tuple(r) for r in held.select("k", "n").collect()]
                if len({k for k, _ in rows}) != len(rows):
                    wrong.append(rows)

    thread = threading.Thread(target=reader)
    thread.start()
    try:
        for batch in range(60):
            rows = spark.range(3).select(((F.col("id") + batch) % 6).alias("k"), F.lit(batch).alias("n"))
            assert table.upsert(rows, batch, ["k"])
            assert not table.upsert(rows, batch, ["k"])
            most = max(most, folders(table.root))
    finally:
        stop.set()
        thread.join()
    assert not wrong
    assert most <= 30, most
    last = {(batch + i) % 6: batch for batch in range(60) for i in range(3)}
    assert {r.k: r.n for r in table.rows().collect()} == last


def test_appended_batches_are_compacted(spark):
    table = VersionedTable(spark, rn.Workspace(spark, "append").path("t"), F.col("id") % 2, fanout=3)
    for batch in range(20):
        table.append(spark.range(batch * 4, batch * 4 + 4), batch)
        assert table.append(spark.range(1), batch) is False
    assert sorted(r.id for r in table.rows().collect()) == list(range(80))
    assert all(len(v) <= 4 for v in table.pointer().folders.values())
    assert folders(table.root) <= 40


def test_a_half_written_version_is_written_anew(spark, monkeypatch):
    table = VersionedTable(spark, rn.Workspace(spark, "half").path("t"), F.col("id") % 2)
    table.append(spark.range(4), 0)
    with monkeypatch.context() as m:
        m.setattr(table, "_commit", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table.append(spark.range(100, 104), 1)
    assert table.rows().count() == 4  # readers do not see it
    table.append(spark.range(100, 103), 1)
    assert sorted(r.id for r in table.rows().collect()) == [0, 1, 2, 3, 100, 101, 102]


def test_reads_follow_a_kept_pointer(spark):
    table = VersionedTable(spark, rn.Workspace(spark, "kept").path("t"), F.col("id") % 2)
    assert table.read() is None and table.pointer() == Pointer()
    table.append(spark.range(4), 0)
    old = table.pointer()
    table.replace(spark.range(10, 12), 1)
    assert table.rows(pointer=old).count() == 4 and table.rows().count() == 2
    assert table.changed(1)[0] == ["bucket=0", "bucket=1"]
    assert table.rows(buckets=["bucket=0"]).collect()[0].id == 10


# ------------------------------------------------------------------ update mode
@pytest.mark.parametrize("mode", ["update", "complete"])
def test_a_stateful_stream_writes_few_files(spark, mode):
    """One file a bucket here, not one of each state partition in each bucket."""
    ws = rn.Workspace(spark, "few")
    src, target, seen = ws.path("src"), ws.path("t"), []
    spark.range(4000).select(F.timestamp_seconds(F.col("id") * 60).alias("t")).write.parquet(src)
    rows = sq.source_stream(spark, src, "t timestamp").groupBy(F.window("t", "5 minutes").start.alias("at")).count()
    sink = rn.update_batches(target, ["at"], sq.day("at")) if mode == "update" else rn.complete_batches(target)

    def watched(batch, batch_id):
        key = "spark.sql.adaptive.enabled"
        before = batch.sparkSession.conf.get(key)
        sink(batch, batch_id)
        seen.append((batch.rdd.getNumPartitions(), before, batch.sparkSession.conf.get(key)))

    rn.foreach_batch(rows, watched, ws.checkpoint("c"), output_mode=mode)
    files = rn.table(spark, target).inputFiles()
    assert len(files) == len({f.rsplit("/", 1)[0] for f in files}) == (3 if mode == "update" else 1)
    assert [x[0] for x in seen] == [4] and seen[0][1] == seen[0][2]
    assert rn.table(spark, target).agg(F.sum("count")).first()[0] == 4000


def test_update_mode_rewrites_changed_days_only(spark):
    ws = rn.Workspace(spark, "update")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    src, target = ws.path("src"), ws.path("t")
    table = VersionedTable(spark, target, sq.day("window_start"))

    def step(rows):
        sq.land_parquet(rows, src)
        m = gd.monitor(gd.monitor_base(br.bronze(sq.source_stream(spark, src, dump.schema))), publish=False)
        q = rn.foreach_batch(m, rn.update_batches(target, ["window_start"], sq.day("window_start")), ws.checkpoint("m"),
                             output_mode="update")
        return q, table.pointer()

    day = F.to_date(F.col("dumped_at").try_cast("timestamp"))
    first = dump.select(F.min(day)).first()[0]
    _, all_days = step(dump.filter(F.col("offset") % 2 == 0))
    q, one_day = step(dump.filter((F.col("offset") % 2 == 1) & (day == F.lit(first))))
    rewritten = [b for b in one_day.folders if one_day.folders[b] != all_days.folders.get(b)]
    assert rewritten == [f"bucket={first}"]
    _, _ = step(dump.filter((F.col("offset") % 2 == 1) & (day != F.lit(first))))
    want = gd.monitor(gd.monitor_base(br.bronze(dump)), publish=False)
    got = rn.table(spark, target)
    assert got.exceptAll(want.select(*got.columns)).isEmpty() and want.select(*got.columns).exceptAll(got).isEmpty()


# ------------------------------------------------------------------ lag
def test_lag_of_a_stopped_and_resumed_load(spark):
    load = sq.LandingLoad(rn.Workspace(spark, "lag"))
    os.makedirs(folder := growing.open_fs(load.folder)[1])
    lag = lambda: {r.partition: (r.committed_offset, r.end_offset, r.lag, r.pending) for r in load.lag().collect()}
    with open(f"{folder}/events_1.jsonl", "w") as f:
        f.writelines(line(k) for k in range(10))
        f.flush()
        assert lag() == {0: (-1001, 10, 10, 10)}
        load.run()
        assert lag() == {0: (10, 10, 0, 0)}
        f.writelines([line(k) for k in range(10, 14)] + [line(k, partition=1) for k in range(5, 8)] + ["broken\n"])
        f.flush()
        assert lag() == {0: (10, 14, 4, 4), 1: (-1001, 8, 3, 3)}
        load.run()
        assert lag() == {0: (14, 14, 0, 0), 1: (8, 8, 0, 0)}


def test_landing_glob_and_growing_source_agree(spark):
    ws = rn.Workspace(spark, "agree")
    dump = fx.dump_clean(fx.events(spark, SF_SMALL))
    folder = ws.path("landing")
    jsonl.land_dump(dump, folder, "events_0001.jsonl")
    sq.append_landing(dump, folder, "events_0002.jsonl")
    a = spark.read.text(jsonl.dump_glob(folder)).select("value")
    b = growing.growing_range(spark, folder).select("value")
    assert a.count() == 2 * dump.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


# ------------------------------------------------------------------ three targets
def test_targets_go_on_after_a_failure_between_them(spark, monkeypatch):
    ws = rn.Workspace(spark, "three")
    dump = fx.dump_strict_input(fx.events(spark, SF_SMALL))
    at = F.col("dumped_at") < "2024-01-12"
    steady, broken = sq.StrictSinks(spark, ws.path("a")), sq.StrictSinks(spark, ws.path("b"))
    for batch, rows in enumerate((dump.filter(at), dump.filter(~at))):
        steady.write(rows, batch)
        for table, name in ((broken.silver, "insert_first"), (broken.delay, "merge")):
            with monkeypatch.context() as m:  # the first targets are committed, this one fails
                m.setattr(table, name, lambda *a, **k: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    broken.write(rows, batch)
        broken.write(rows, batch)
        broken.write(rows, batch)
    for name in ("bronze", "silver", "delay"):
        a, b = getattr(steady, name).rows(), getattr(broken, name).rows()
        assert a.count() == b.count() > 0
    a, b = steady.delay.rows(), broken.delay.rows()
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert broken.delay.rows().agg(F.sum("delay_count")).first()[0] == 2 * broken.silver.rows().count()


# ------------------------------------------------------------------ quality counters
def test_logged_expectations_equal_the_report(spark):
    from linkflow.operators.quality import observed_guard
    from linkflow.streaming import metrics
    ws = rn.Workspace(spark, "metrics")
    dump = fx.dump_dirty(fx.events(spark, SF_SMALL))
    want = {tuple(r) for r in br.bronze_expectations(dump).collect()}
    assert {tuple(r) for r in sq.q_stream_expectations(spark, SF_SMALL).collect()} == want
    # a batch job: counted by the pass that writes the rows
    root = ws.path("log")
    kept, seen = observed_guard(br.bronze_columns(dump), br.bronze_rules(), "bronze_expectations")
    kept.drop("env").write.parquet(ws.path("bronze"))
    for _ in range(2):  # a repeated batch replaces its counts
        metrics.log(spark, root, "batch-bronze", 0, {"bronze_expectations_1": seen.get})
    entries = metrics.expectation_log(spark, root)
    assert {tuple(r) for r in metrics.totals(entries).collect()} == want
    assert {(r.query, r.batch, r.expectations) for r in entries.collect()} == {("batch-bronze", 0, "bronze_expectations")}


# ------------------------------------------------------------------ publishing
def test_reports_count_delivered_and_rejected_records(spark):
    from linkflow.sources import outbox
    ws = rn.Workspace(spark, "outbox")
    rows = spark.createDataFrame([(b"a", b"1"), (None, b"2"), (b"c", None), (b"d", b"x" * 100)], "key binary, value binary")
    src, topic = ws.path("src"), ws.path("topic")
    sq.land_parquet(rows, src)
    q = rn.run(outbox.publish_stream(sq.source_stream(spark, src, rows.schema), topic, max_bytes=50), ws.checkpoint("p"))
    assert q.exception() is None
    r = outbox.reports(spark, topic).collect()
    assert [(x.batch, x.aborted, x.delivered, x.rejected) for x in r] == [(0, False, 2, 2)]
    assert sorted((x.key or "", x.value) for x in outbox.delivered(spark, topic).collect()) == [("", "2"), ("a", "1")]
    assert sorted((x.key, x.reason) for x in outbox.rejected(spark, topic).collect()) == [("c", "no value"), ("d", "101 bytes")]


def test_a_failed_task_is_reported_and_its_retry_delivers_once(spark):
    from linkflow.sources import outbox
    ws = rn.Workspace(spark, "outbox-fail")
    rows = spark.range(20).select(F.col("id").cast("string").cast("binary").alias("key"),
                                  F.col("id").cast("string").cast("binary").alias("value"))
    src, topic, flag = ws.path("src"), ws.path("topic"), ws.path("flag")
    sq.land_parquet(rows.repartition(4), src)
    path = growing.open_fs(flag)[1]

    def broken(batches):
        for b in batches:
            if not os.path.exists(path) and any(v == b"7" for v in b.column(0).to_pylist()):
                raise RuntimeError("broker away")
            yield b

    def publish():
        frame = sq.source_stream(spark, src, rows.schema, max_files=None).mapInArrow(broken, "key binary, value binary")
        return rn.run(outbox.publish_stream(frame, topic), ws.checkpoint("p"))

    with pytest.raises(Exception, match="broker away"):
        publish()
    assert [(r.aborted, r.delivered > 0 or r.tasks >= 0) for r in outbox.reports(spark, topic).collect()] == [(True, True)]
    assert outbox.delivered(spark, topic).count() == 0
    os.makedirs(path)
    publish()
    assert sorted(int(r.value) for r in outbox.delivered(spark, topic).collect()) == list(range(20))
    assert sorted((r.batch, r.aborted) for r in outbox.reports(spark, topic).collect()) == [(0, False), (0, True)]


# ------------------------------------------------------------------ dashboards
def test_dashboards_from_partials_equal_those_from_rows(spark):
    from linkflow.operators import dashboard as db
    from linkflow.operators.load import load_observations
    from tools.compare import same
    tables = sq.dashboards(spark, SF_SMALL)
    obs = load_observations(fx.dump_clean(fx.events(spark, SF_SMALL)), columns=db.FRAME_COLUMNS)
    for minutes in (60, 240, 60 * 24 * 3):
        w = db.window_frame(obs, window_minutes=minutes)
        m = db.monitor_window(w)
        pairs = [(tables.kpi_traffic(minutes), db.kpi_traffic(w)), (tables.kpi_monitor(minutes), db.kpi_monitor(w)),
                 (tables.delay_over_time(minutes), db.delay_over_time(w)),
                 (tables.latest_by_road(minutes), db.latest_by_road(w)),
                 (tables.records_per_5m(minutes), db.records_per_5m(m)),
                 (tables.partition_distribution(minutes), db.partition_distribution(m)),
                 (tables.max_offset_by_partition(minutes), db.max_offset_by_partition(m)),
                 (tables.window(tables.rows, minutes), w)]
        for got, want in pairs:
            ok, why = same(got.toPandas(), want.toPandas())
            assert ok, why
        assert all("/rows/" not in f and "/observations/" not in f for got, _ in pairs[:-1] for f in got.inputFiles())
    for n in (7, 300, 10_000):
        assert same(tables.newest(n).toPandas(), db.newest(obs, n).toPandas())[0]
