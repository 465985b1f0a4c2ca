
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from linkflow.functions.columns import hour_local_bucket
from linkflow.operators import bronze as br
from linkflow.operators import gold as gd
from linkflow.operators import health as hl
from linkflow.plans.layers import Layers
from linkflow.schemas import OFFSETS_SCHEMA
from linkflow.sources import fixture as fx
from tests.conftest import SF_SMALL


def test_dedup_and_dimension_keys_are_unique(spark):
    L = Layers.from_events(spark, SF_SMALL)
    d = L.silver_dedup
    assert d.count() == d.select("link_id", "interval_start").distinct().count()
    assert L.dim.count() == L.dim.select("link_id").distinct().count()
    f = L.fact("latest")
    assert f.count() == f.select("link_id", "interval_start").distinct().count()


def test_violations_plus_kept_covers_input(spark):
    d = fx.dump_dirty(fx.events(spark, SF_SMALL))
    rep = {r.rule: (r.violations, r.kept) for r in br.bronze_expectations(d).collect()}
    kept = next(iter(rep.values()))[1]
    assert kept == br.bronze(d).count()
    # each dirty row breaks exactly one rule here
    assert kept + sum(v for v, _ in rep.values()) == d.count()


def test_partition_counts_sum_to_records(spark):
    L = Layers.from_events(spark, SF_SMALL)
    m = L.monitor()
    bad = m.filter(F.col("records_processed") != F.col("partition_0_count") + F.col("partition_1_count")
                   + F.col("partition_2_count"))
    assert bad.count() == 0
    assert m.agg(F.sum("records_processed")).first()[0] == L.bronze.count()


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6),
                          st.one_of(st.none(), st.integers(-2000, 2 * 10**6))), min_size=1, max_size=40))
def test_lag_matches_definition_and_is_never_negative(spark, rows):
    data = [(i, min(a, b), max(a, b), c) for i, (a, b, c) in enumerate(rows)]
    got = {r.partition: r.lag for r in hl.consumer_lag(spark.createDataFrame(data, OFFSETS_SCHEMA)).collect()}
    for p, b, e, c in data:
        want = e - b if c is None or c < 0 else max(0, e - c)
        assert got[p] == want and got[p] >= 0


@settings(max_examples=5, deadline=None)
@given(st.lists(st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2100, 1, 1)),
                min_size=1, max_size=50),
       st.integers(1, 90))
def test_hour_local_bucket_matches_floor_within_hour(spark, stamps, minutes):
    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp")
    got = [r.b for r in df.select(hour_local_bucket("t", minutes).alias("b")).collect()]
    for t, b in zip(stamps, got):
        want = t.replace(minute=(t.minute // minutes) * minutes, second=0, microsecond=0)
        assert b == want


def test_sliding_windows_cover_each_row_twice(spark):
    L = Layers.from_events(spark, SF_SMALL)
    fact = L.fact("all").filter(F.col("interval_start").isNotNull())
    g = fact.groupBy(F.window("interval_start", gd.DELAY_WINDOW, gd.DELAY_SLIDE)).count()
    assert g.agg(F.sum("count")).first()[0] == 2 * fact.count()


def test_clear_scratch_deletes_what_was_made(spark, tmp_path):
    import os

    from linkflow import session
    before, session._scratch[spark.sparkContext.applicationId] = session._scratch.get(
        spark.sparkContext.applicationId, []), []
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert spark.read.parquet(path).count() == 3
    assert session.clear_scratch(spark) == 1
    assert not os.path.exists(path.removeprefix("file://"))
    session._scratch[spark.sparkContext.applicationId] = before
