"""Every registered query against its DuckDB oracle on the sf0.001 tables."""

import math

import pytest

from partweave.plans.catalog import ORACLES, QUERIES
from tests.conftest import duck_views

import __spark_entry__ as E

NAMES = sorted(QUERIES)

# DuckDB's names of Spark's types, stated apart from the library's own map.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "float": "FLOAT",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Sex", "Hispanic", "Race", "count"]
    assert df.count() == 88


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, sf001, name):
    duck_views(duck, sf001)
    df = QUERIES[name](spark, sf001)
    s_rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    o_cols = [d[0] for d in res.description]
    o_rows = res.fetchall()
    assert sorted(df.columns) == sorted(o_cols)
    s_types = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString().upper()) for f in df.schema.fields}
    o_types = {d[0]: str(d[1]) for d in res.description}
    assert s_types == o_types
    assert _rows(df.columns, s_rows) == _rows(o_cols, o_rows)
