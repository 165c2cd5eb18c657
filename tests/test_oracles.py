"""Each registered query against its DuckDB twin: names, types and values."""

import math

import duckdb
import pytest

import __spark_entry__ as driver
from rosterloom.plans import testbed

TABLES = "region nation customer supplier part orders lineitem events".split()
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()
DUCK_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def clean(v):
        if isinstance(v, float) and math.isnan(v):
            return None
        return v.isoformat()[:10] if hasattr(v, "isoformat") else v

    return sorted((tuple(clean(row[i]) for i in order) for row in rows), key=repr)


def test_every_query_has_an_oracle():
    assert set(testbed.QUERIES) <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(testbed.QUERIES))
def test_same_result(name, spark, duck, sf_dir):
    df = QUERIES[name](spark, sf_dir)
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    types = {d[0]: str(d[1]) for d in found.description}
    expected = canonical(names, found.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert {c: DUCK_TYPES[t] for c, t in df.dtypes} == types
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == expected


def test_entry(spark):
    rows = driver.entry(spark).collect()
    assert [r.headcount for r in rows] == [150] * 6
    assert [r.hired for r in rows] == [r.left_company for r in rows]
