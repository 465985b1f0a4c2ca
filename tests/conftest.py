import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from linkflow.session import build_session, clear_scratch
    # scratch tables and stream checkpoints go to the session's
    # spark.checkpoint.dir; linkflow creates a private one only if unset
    s = build_session("local[4]", app_name="linkflow-tests", shuffle_partitions=4)
    yield s
    clear_scratch(s)
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    con = duckdb.connect()
    for t in ("events",):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
