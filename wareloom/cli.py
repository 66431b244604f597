"""Command line for the warehouse jobs, configured by environment variables.

    python -m wareloom.cli load replace      # staging -> master by key
    python -m wareloom.cli load replace-partitions   # same, rewriting only touched partitions
    python -m wareloom.cli load append | overwrite
    python -m wareloom.cli load replace-generated    # by key, ids in GENERATED_ID made anew (order: ID_COLS)
    python -m wareloom.cli convert-datetime  # text columns COLS of the staged tables to timestamps
    python -m wareloom.cli copy              # master tables (COLUMN_Q columns) to TARGET_DB, SUFFIX added
    python -m wareloom.cli export            # master tables as CSV below TARGET_PATH
    python -m wareloom.cli geocode           # new rows of the master tables to <table>_G by the table LOCATOR
    python -m wareloom.cli misses            # geocoded rows without a place, as CSV below TARGET_PATH
    python -m wareloom.cli validate          # schema + null contract of the staged tables
    python -m wareloom.cli generate-schema   # contract of a staged table (JSON on stdout)
    python -m wareloom.cli pull              # incremental pull of the tables into staging

The session comes from ``SparkSession.builder.getOrCreate()`` (spark-submit
decides the master); every data step is the library's DataFrame code.
"""

from __future__ import annotations

import json
import os
import sys
from collections.abc import Mapping

# The environment variables the warehouse jobs are configured
# with (names kept so existing job configurations carry over).
ENV_DEPT = "DEPT"
ENV_SOURCE = "SOURCE"
ENV_TABLE = "TABLE"
ENV_TABLES = "TABLES"
ENV_ID_COLS = "ID_COLS"
ENV_REQ_TABLES = "REQ_TABLES"
ENV_TARGET_SCHEMA = "TARGET_SCHEMA"
ENV_COL_SCHEMA = "COL_SCHEMA"
ENV_NA_FALSE = "NA_FALSE"
ENV_APPEND_COL = "APPEND_COL"
ENV_APPEND_TYPE = "APPEND_TYPE"
ENV_APPEND_SIGN = "APPEND_SIGN"
ENV_SQL = "SQL"
ENV_MAX_COLS = "MAX_COLS"
# additions of this library
ENV_SOURCE_PATH = "SOURCE_PATH"
ENV_JDBC_URL = "JDBC_URL"
ENV_COLLATION = "KEY_COLLATION"
ENV_PARTITION_COLS = "PARTITION_COLS"
ENV_COLS = "COLS"
ENV_COLUMN_Q = "COLUMN_Q"
ENV_SUFFIX = "SUFFIX"
ENV_TARGET_DB = "TARGET_DB"
ENV_TARGET_PATH = "TARGET_PATH"
ENV_GENERATED_ID = "GENERATED_ID"
ENV_WHERE = "WHERE"
ENV_LOCATOR = "LOCATOR"
ENV_ADDRESS = "ADDRESS"
ENV_DISTANCE = "DISTANCE"


def _list(env: Mapping[str, str], name: str) -> list[str]:
    return [x.strip() for x in env.get(name, "").split(",") if x.strip()]


def _tables(env: Mapping[str, str]) -> list[str]:
    return _list(env, ENV_TABLES) or _list(env, ENV_TABLE)


def _spark():
    from pyspark.sql import SparkSession

    return SparkSession.builder.getOrCreate()


def load(mode: str, env: Mapping[str, str]) -> list:
    """Load every listed table from staging into the target layer."""
    from wareloom import jobs
    from wareloom.naming import TableRef

    spark = _spark()
    target = env.get(ENV_TARGET_SCHEMA, "master").lower()
    keys = _list(env, ENV_ID_COLS)
    required = set(_list(env, ENV_REQ_TABLES))
    out = []
    for t in _tables(env):
        ref = TableRef(env[ENV_DEPT], env[ENV_SOURCE], t)
        gate = t in required
        if mode == "replace":
            if not keys:
                raise ValueError(f"{ENV_ID_COLS} is required for a replace")
            out.append(jobs.run_replace(spark, ref, keys, target, require_new_ids=gate,
                                        collation=env.get(ENV_COLLATION) or None))
        elif mode == "replace-partitions":
            out.append(jobs.run_replace_partitions(spark, ref, keys, _list(env, ENV_PARTITION_COLS), target))
        elif mode == "append":
            out.append(jobs.run_append(spark, ref, target, id_cols=keys or None, require_new_ids=gate))
        elif mode == "overwrite":
            out.append(jobs.run_overwrite(spark, ref, target, id_cols=keys or None, require_new_ids=gate))
        elif mode == "replace-generated":
            out.append(jobs.run_replace_generated_id(spark, ref, keys, env[ENV_GENERATED_ID], keys, target))
        else:
            raise ValueError(f"unknown load mode {mode!r}")
    return out


def convert_datetime(env: Mapping[str, str]) -> list[str]:
    from wareloom import jobs
    from wareloom.naming import TableRef

    return [jobs.convert_datetimes(_spark(), TableRef(env[ENV_DEPT], env[ENV_SOURCE], t), _list(env, ENV_COLS)) for t in _tables(env)]


def _masters(env: Mapping[str, str]) -> dict:
    """The listed master tables, reduced to the columns of ``COLUMN_Q`` where given."""
    from wareloom import jobs
    from wareloom.naming import TableRef

    refs = {t: TableRef(env[ENV_DEPT], env[ENV_SOURCE], t, env.get(ENV_TARGET_SCHEMA, "master").lower()) for t in _tables(env)}
    return {ref.name: jobs.read_table(_spark(), ref, _list(env, ENV_COLUMN_Q)) for ref in refs.values()}


def copy(env: Mapping[str, str]) -> list:
    """Copy the listed master tables to ``TARGET_DB``; contents are compared."""
    from wareloom import jobs

    out = jobs.copy_tables(_spark(), _masters(env), env[ENV_TARGET_DB], env.get(ENV_SUFFIX, ""), long_text=_list(env, ENV_MAX_COLS) or None)
    return [tuple(r) for r in out.collect()]  # one row per table


def export(env: Mapping[str, str]) -> list[str]:
    from wareloom.sinks import export as sink

    out = []
    for name, df in _masters(env).items():
        out.append(f"{env[ENV_TARGET_PATH].rstrip('/')}/{name}")
        sink.csv(df, out[-1])
    return out


def geocode(env: Mapping[str, str]) -> list[str]:
    """Load ``<table>_G`` (id, FULL_ADDRESS, place) for the rows it lacks.

    ``ADDRESS`` is the SQL text of the address, ``LOCATOR`` a table of addresses with score and place;
    with ``DISTANCE`` an address may differ from the locator's by so many edits."""
    from wareloom.naming import TableRef
    from wareloom.operators import approximate, enrich

    spark, out = _spark(), []
    locator, distance = spark.table(env[ENV_LOCATOR]), int(env.get(ENV_DISTANCE, "0"))
    for t in _tables(env):
        ref = TableRef(env[ENV_DEPT], env[ENV_SOURCE], t, "master")
        id_col = _list(env, ENV_ID_COLS)[0]
        rows = enrich.address(spark.table(ref.qualified), env[ENV_ADDRESS]).select(id_col, "FULL_ADDRESS")
        find = (lambda todo: approximate.geocode(todo, locator, distance=distance)) if distance else (lambda todo: enrich.geocode(todo, locator))
        out.append(enrich.run(rows, ref.geocoded, lambda todo, f=find: f(todo).select(id_col, "FULL_ADDRESS", "longitude", "latitude"), id_col))
    return out


def misses(env: Mapping[str, str]) -> list[str]:
    """Rows of ``<table>_G`` without a latitude, with the source's columns ``COLS``, as CSV."""
    from wareloom.naming import TableRef
    from wareloom.operators import enrich
    from wareloom.sinks import export as sink

    spark, out = _spark(), []
    for t in _tables(env):
        ref = TableRef(env[ENV_DEPT], env[ENV_SOURCE], t, "master")
        id_col = _list(env, ENV_ID_COLS)[0]
        geo = spark.table(ref.geocoded)
        rows = enrich.misses(geo, spark.table(ref.qualified), id_col, [c for c in geo.columns if c == "FULL_ADDRESS"], _list(env, ENV_COLS), where=env.get(ENV_WHERE) or None)
        out.append(f"{env[ENV_TARGET_PATH].rstrip('/')}/{ref.name}_misses")
        sink.csv(rows, out[-1])
    return out


def contracts(env: Mapping[str, str]) -> dict[str, str]:
    """The contract of each listed table.

    ``COL_SCHEMA`` is one contract (a JSON list, or the path of one) for all tables, or a JSON object
    from table to contract; ``COL_SCHEMA_<TABLE>`` gives a table its own."""
    text, tables = env.get(ENV_COL_SCHEMA, ""), _tables(env)
    by_table = json.loads(text) if text.lstrip().startswith("{") else {}
    out = {}
    for t in tables:
        own = env.get(f"{ENV_COL_SCHEMA}_{t}") or env.get(f"{ENV_COL_SCHEMA}_{t.upper()}") or by_table.get(t)
        if own is None and not by_table:
            own = text
        if not own:
            raise ValueError(f"no contract for {t}: set {ENV_COL_SCHEMA}_{t.upper()}, or give {ENV_COL_SCHEMA} as an object by table")
        out[t] = own if isinstance(own, str) else json.dumps(own)
    return out


def validate(env: Mapping[str, str]) -> None:
    """Raise ContractError when a listed staged table breaks the contract; every
    table is checked before the first error is raised."""
    from wareloom.naming import TableRef
    from wareloom.operators import quality

    spark = _spark()
    broken = []
    for t, contract in contracts(env).items():
        try:
            quality.validate(spark.table(TableRef(env[ENV_DEPT], env[ENV_SOURCE], t).qualified), quality.contract_from_json(spark, contract))
        except quality.ContractError as e:
            broken.append(f"{t}: {e}")
    if broken:
        raise quality.ContractError("; ".join(broken))


def generate_schema(env: Mapping[str, str]) -> str:
    from wareloom.naming import TableRef
    from wareloom.operators import quality

    spark = _spark()
    ref = TableRef(env[ENV_DEPT], env[ENV_SOURCE], env[ENV_TABLE])
    contract = quality.generate_contract(spark.table(ref.qualified), _list(env, ENV_NA_FALSE))
    recs = []
    for r in contract.collect():  # metadata: one row per column
        rec = {"COLUMN_NAME": r["COLUMN_NAME"], "DATA_TYPE": r["DATA_TYPE"]}
        if r["NAs"] is not None:
            rec["NAs"] = r["NAs"]
        recs.append(rec)
    return json.dumps(recs)


def pull(env: Mapping[str, str]) -> list[str]:
    """Incremental pull of every listed table into staging, above the master's
    high-water mark of ``APPEND_COL`` when given.

    The source is ``JDBC_URL`` (the table of that name, or ``SQL``),
    ``SOURCE_PATH`` (Parquet) or ``SQL``; ``{table}`` in path and SQL stands for
    the table's name."""
    from wareloom import catalog, jobs
    from wareloom.functions.columns import long_text_last
    from wareloom.naming import TableRef
    from wareloom.operators import incremental
    from wareloom.sources import jdbc

    spark, out = _spark(), []
    tables = _tables(env)
    if len(tables) > 1 and not env.get(ENV_JDBC_URL) and "{table}" not in (env.get(ENV_SOURCE_PATH) or env.get(ENV_SQL, "")):
        raise ValueError("several tables need {table} in the source")
    for t in tables:
        ref = TableRef(env[ENV_DEPT], env[ENV_SOURCE], t)
        named = lambda v: env[v].replace("{table}", t)  # noqa: E731, B023
        if env.get(ENV_JDBC_URL):
            url = env[ENV_JDBC_URL]
            src = jdbc.query(spark, url, named(ENV_SQL)) if env.get(ENV_SQL) else jdbc.table(spark, url, t)
        else:
            src = spark.read.parquet(named(ENV_SOURCE_PATH)) if env.get(ENV_SOURCE_PATH) else spark.sql(named(ENV_SQL))
        col = env.get(ENV_APPEND_COL)
        if col:
            master = ref.at("master").qualified
            target = spark.table(master) if catalog.exists(spark, master) else None
            src = incremental.pull(src, target, col, env.get(ENV_APPEND_TYPE, "MAX"), env.get(ENV_APPEND_SIGN, ">"))
        out.append(jobs.stage(long_text_last(src, _list(env, ENV_MAX_COLS)), ref))
    return out


JOBS = {"pull": pull, "convert-datetime": convert_datetime, "copy": copy, "export": export, "geocode": geocode, "misses": misses}


def main(argv: list[str] | None = None, env: Mapping[str, str] | None = None) -> int:
    argv = list(sys.argv[1:] if argv is None else argv)
    env = os.environ if env is None else env
    if not argv:
        print(__doc__)
        return 2
    cmd = argv[0]
    if cmd == "load":
        for r in load(argv[1] if len(argv) > 1 else "replace", env):
            print(r)
    elif cmd == "validate":
        validate(env)
        print("contract ok")
    elif cmd == "generate-schema":
        print(generate_schema(env))
    elif cmd in JOBS:
        for t in JOBS[cmd](env):
            print(t)
    else:
        print(__doc__)
        return 2
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
