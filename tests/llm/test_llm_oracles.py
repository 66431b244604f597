"""The registered llm queries against their DuckDB oracles, and their names."""

import duckdb
import pytest

from tools.check_oracle import TABLES, digest, type_mismatches
from wareloom.llm import queries


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def test_query_names():
    assert sorted(n.split("_")[0] for n in queries.QUERIES) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_oracle(spark, duck, sf, name):
    sdf = queries.QUERIES[name](spark, sf)
    rows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(queries.ORACLES[name])
    cols, want = [c[0] for c in res.description], res.fetchall()
    assert sorted(sdf.columns) == sorted(cols)
    assert type_mismatches(sdf.columns, [f.dataType.simpleString() for f in sdf.schema.fields], cols, [str(c[1]) for c in res.description]) == []
    assert digest(rows, sdf.columns)[0] == digest(want, cols)[0]
