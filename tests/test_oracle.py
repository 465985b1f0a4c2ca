"""Every registered query with an SQL twin equals its DuckDB result (sf0.001)."""

import pytest

import __spark_entry__ as E
from linkflow.plans.catalog import QUERIES
from linkflow.plans.oracle import SQL
from linkflow.streaming.queries import STREAM_QUERIES
from tests.conftest import SF_SMALL
from tools.compare import same

TWINS = sorted(SQL)


@pytest.mark.parametrize("name", TWINS)
def test_query_matches_sql_twin(spark, duck, name):
    got = E.queries()[name](spark, SF_SMALL).toPandas()
    want = duck.execute(E.oracle_sql()[name]).df()
    ok, why = same(got, want)
    assert ok, f"{name}: {why}"


def test_every_query_registered_and_twinned_or_rows_only():
    qs = E.queries()
    assert set(E.oracle_sql()) <= set(qs)
    assert set(QUERIES) | set(STREAM_QUERIES) == set(SQL) <= set(qs)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["window_start", "window_end", "road_name", "avg_delay_seconds"]
    assert df.count() > 0
