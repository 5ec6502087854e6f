import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers (the SAS Data Source runs in them) inherit this from the JVM
# the session starts, so they import the package from any working directory.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

SF = {
    "0.001": "/root/testdata/sf0.001",
    "0.01": "/root/testdata/sf0.01",
}


@pytest.fixture(scope="session")
def spark():
    from partweave.session import build_session

    s = build_session(master="local[*]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf001():
    return SF["0.001"]


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    return con


def duck_views(con, sf_dir):
    tables = "region nation customer supplier part orders lineitem events".split()
    for t in tables:
        con.execute(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
