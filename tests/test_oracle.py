"""Every registered query equals its DuckDB oracle (rows, columns, values) at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as entry
from wareloom.plans import registry
from tools.check_oracle import TABLES, digest, type_mismatches

QUERIES = dict(registry.QUERIES)
ORACLES = dict(registry.ORACLES)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, sf, name):
    sdf = QUERIES[name](spark, sf)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    ocols = [c[0] for c in res.description]
    orows = res.fetchall()
    assert sorted(sdf.columns) == sorted(ocols)
    stypes = [f.dataType.simpleString() for f in sdf.schema.fields]
    assert type_mismatches(sdf.columns, stypes, ocols, [str(c[1]) for c in res.description]) == []
    assert len(srows) == len(orows)
    assert digest(srows, sdf.columns)[0] == digest(orows, ocols)[0]
