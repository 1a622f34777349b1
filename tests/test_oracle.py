"""Every query with SQL must give what DuckDB gives on the same tables."""

import math
from pathlib import Path

import duckdb
import pytest

from braidwork.plans import catalog

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="needs the test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from '{p}'")
    return con


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda k: columns[k])

    def one(v):
        if isinstance(v, float):
            return None if math.isnan(v) else int(v) if v.is_integer() else round(v, 6)
        return v

    return sorted((tuple(one(r[k]) for k in order) for r in values), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_matches_duckdb(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    want = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(columns, want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_runs(spark, name):
    assert catalog.queries()[name](spark, SF).count() > 0
