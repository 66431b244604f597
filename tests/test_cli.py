"""The environment-configured command line drives the same jobs."""

import json

import pytest

from wareloom import catalog, cli
from wareloom.operators.quality import ContractError


def test_cli_pull_validate_load(spark, sf):
    for db in ("staging", "master"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    env = {"DEPT": "cli", "SOURCE": "tpch", "TABLES": "orders", "ID_COLS": "o_orderkey",
           "SOURCE_PATH": f"{sf}/orders.parquet", "APPEND_COL": "o_orderkey"}
    assert cli.main(["pull"], env) == 0  # no master yet: full pull
    n = spark.table("staging.cli_tpch_orders").count()
    schema = json.loads(cli.generate_schema({**env, "TABLE": "orders", "NA_FALSE": "o_orderkey"}))
    assert schema[0] == {"COLUMN_NAME": "o_orderkey", "DATA_TYPE": "bigint", "NAs": False}
    cli.validate({**env, "TABLE": "orders", "COL_SCHEMA": json.dumps(schema)})
    bad = [dict(r, DATA_TYPE="int") if r["COLUMN_NAME"] == "o_custkey" else r for r in schema]
    with pytest.raises(ContractError):
        cli.validate({**env, "TABLE": "orders", "COL_SCHEMA": json.dumps(bad)})
    assert cli.main(["load", "replace"], env) == 0  # master missing: staging moves
    assert spark.table("master.cli_tpch_orders").count() == n
    assert not catalog.exists(spark, "staging.cli_tpch_orders")
    cli.main(["pull"], env)  # above the high-water mark: nothing new
    assert spark.table("staging.cli_tpch_orders").count() == 0
    out = cli.load("replace", env)
    assert out[0]["deleted"] == 0 and out[0]["inserted"] == 0
    assert cli.main([], env) == 2
