"""Schema and null contracts.

A contract is a small DataFrame ``(COLUMN_NAME string, DATA_TYPE string,
NAs boolean)`` (the JSON list format).  Checking a staged table is:

* the schema side: the table's (name, type) set, built from ``df.schema``
  (metadata, no job), full-outer-joined with the contract;
* the data side: ONE aggregate job of ``count_if(c IS NULL)`` over every
  column, unpivoted with ``stack`` to one row per column.

Both sides are small, so their join is cheap; the only scan of the data is
the single null-count aggregate.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions.types import sql_type_name
from wareloom.session import local_rows

CONTRACT_SCHEMA = T.StructType([
    T.StructField("COLUMN_NAME", T.StringType()),
    T.StructField("DATA_TYPE", T.StringType()),
    T.StructField("NAs", T.BooleanType()),
])

CONTRACT_DDL = "COLUMN_NAME string, DATA_TYPE string, NAs boolean"
# above this many columns the null counts are computed through an unpivot
WIDE_COLUMNS = 200


class ContractError(RuntimeError):
    pass


def contract_from_records(spark: SparkSession, records: list[dict]) -> DataFrame:
    rows = [(r["COLUMN_NAME"], r["DATA_TYPE"], r.get("NAs")) for r in records]
    return local_rows(spark, rows, CONTRACT_DDL)


def contract_from_json(spark: SparkSession, text_or_path: str) -> DataFrame:
    """Contract from JSON text (a list) or from a JSON file path (a list, pretty-printed or not, or one record per line).

    A contract is metadata, one record per column, so the file is read whole."""
    stripped = text_or_path.lstrip()
    if stripped.startswith("[") or stripped.startswith("{"):
        recs = json.loads(stripped)
        return contract_from_records(spark, recs if isinstance(recs, list) else [recs])
    texts = [r.value.strip() for r in spark.read.text(text_or_path, wholetext=True).collect()]
    records = []
    for text in filter(None, texts):
        if text.startswith("["):
            records += json.loads(text)
        else:
            records += [json.loads(line) for line in text.splitlines() if line.strip()]
    return contract_from_records(spark, records)


def actual_columns(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, actual_type, nullable) of a DataFrame, from its schema only."""
    rows = [(i + 1, f.name, sql_type_name(f), f.nullable) for i, f in enumerate(df.schema.fields)]
    schema = "ordinal int, column_name string, actual_type string, nullable boolean"
    return local_rows(df.sparkSession, rows, schema)


def generate_contract(df: DataFrame, required: list[str] | str | None = None) -> DataFrame:
    """Contract of a staged table; listed columns get ``NAs = false``, others NULL.

    ``required="complete"`` lists the columns that hold no NULL now (one job)."""
    if required == "complete":
        required = [r["column_name"] for r in null_counts(df).where("null_count = 0").collect()]
    required = set(required or [])
    rows = [(f.name, sql_type_name(f), (False if f.name in required else None)) for f in df.schema.fields]
    return local_rows(df.sparkSession, rows, CONTRACT_DDL)


def write_contract(contract: DataFrame, path: str) -> None:
    # a contract is metadata (one row per column): one file is right
    contract.coalesce(1).write.mode("overwrite").json(path)


def null_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(column_name, null_count) for the given (default: all) columns, one job."""
    columns = columns if columns is not None else df.columns
    if not columns:
        return local_rows(df.sparkSession, [], "column_name string, null_count bigint")
    if len(columns) > WIDE_COLUMNS:
        # hundreds of aggregate expressions overflow codegen: one aggregate per
        # block of columns, each of which reads only its own columns
        blocks = [columns[i : i + WIDE_COLUMNS] for i in range(0, len(columns), WIDE_COLUMNS)]
        parts = [null_counts(df, b) for b in blocks]
        return reduce(lambda a, b: a.unionByName(b), parts)
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)])
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', n{i}" for i, c in enumerate(columns))
    return wide.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, null_count)")


def _required(contract: DataFrame, any_declared: bool) -> F.Column:
    # documented intent: NAs = false means "no NULL allowed"; the coded
    # behaviour checked every column with NAs set (any_declared=True)
    return F.col("NAs").isNotNull() if any_declared else F.coalesce(~F.col("NAs"), F.lit(False))


def _required_names(df: DataFrame, contract: DataFrame, any_declared: bool) -> list[str]:
    """The required columns that the table has (a contract is one row per column)."""
    names = {r["COLUMN_NAME"] for r in contract.where(_required(contract, any_declared)).select("COLUMN_NAME").collect()}
    return [c for c in df.columns if c in names]


def schema_report(df: DataFrame, contract: DataFrame, any_declared: bool = False, profile: bool = False) -> DataFrame:
    """One row per column of contract or table:
    column_name, expected_type, actual_type, required, null_count, status
    with status in ok / missing / extra / type_mismatch / null_violation.

    Only required columns are scanned, and ``null_count`` is NULL for the
    others; with ``profile`` every column's NULLs are counted."""
    exp = contract.select(F.col("COLUMN_NAME").alias("column_name"), F.col("DATA_TYPE").alias("expected_type"),
                          _required(contract, any_declared).alias("required"))
    act = actual_columns(df).select("column_name", "actual_type")
    nulls = null_counts(df, None if profile else _required_names(df, contract, any_declared))
    joined = (exp.join(act, "column_name", "full_outer")
              .join(nulls, "column_name", "left"))
    status = (F.when(F.col("actual_type").isNull(), "missing")
              .when(F.col("expected_type").isNull(), "extra")
              .when(F.lower("expected_type") != F.lower("actual_type"), "type_mismatch")
              .when(F.coalesce(F.col("required"), F.lit(False)) & (F.col("null_count") > 0), "null_violation")
              .otherwise("ok"))
    return joined.select("column_name", "expected_type", "actual_type",
                         F.coalesce(F.col("required"), F.lit(False)).alias("required"),
                         F.col("null_count").cast("bigint").alias("null_count"), status.alias("status"))


def check_schema(df: DataFrame, contract: DataFrame) -> None:
    """Raise when the (name, type) sets differ (row and column order ignored)."""
    exp = contract.select(F.col("COLUMN_NAME").alias("column_name"), F.lower("DATA_TYPE").alias("t"))
    act = actual_columns(df).select("column_name", F.lower("actual_type").alias("t"))
    missing = [tuple(r) for r in exp.exceptAll(act).collect()]
    extra = [tuple(r) for r in act.exceptAll(exp).collect()]
    if missing or extra:
        raise ContractError(f"schema differs from contract: missing or changed {missing}; unexpected {extra}")


def check_nulls(df: DataFrame, contract: DataFrame, any_declared: bool = False) -> None:
    """Raise on the first required column (contract order) that holds a NULL. One job."""
    req = [r["COLUMN_NAME"] for r in contract.where(_required(contract, any_declared)).collect()
           if r["COLUMN_NAME"] in df.columns]
    if not req:
        return
    counts = {r["column_name"]: r["null_count"] for r in null_counts(df, req).collect()}
    for c in req:
        if counts.get(c, 0) > 0:
            raise ContractError(f"required column {c} holds {counts[c]} NULL value(s)")


def validate(df: DataFrame, contract: DataFrame, any_declared: bool = False) -> None:
    check_schema(df, contract)
    check_nulls(df, contract, any_declared)


def validate_all(tables: dict[str, tuple[DataFrame, DataFrame]], any_declared: bool = False, profile: bool = False) -> DataFrame:
    """Reports of many tables in one DataFrame with a ``table_name`` column."""
    parts = [schema_report(df, c, any_declared, profile).select(F.lit(name).alias("table_name"), "*")
             for name, (df, c) in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_violations(df: DataFrame, contract_required: list[str]) -> DataFrame:
    """Adds ``violations``: the required columns that are NULL in the row."""
    flags = [F.when(F.col(f"`{c}`").isNull(), F.lit(c)) for c in contract_required]
    return df.withColumn("violations", F.array_compact(F.array(*flags)) if flags else F.array().cast("array<string>"))


def quarantine(df: DataFrame, contract: DataFrame, any_declared: bool = False) -> tuple[DataFrame, DataFrame]:
    """Split rows into (good, bad): bad rows have a NULL in a required column
    and carry the ``violations`` list.  Both sides come from one projection;
    persist it when both are written."""
    req = [r["COLUMN_NAME"] for r in contract.where(_required(contract, any_declared)).collect()
           if r["COLUMN_NAME"] in df.columns]
    tagged = with_violations(df, req)
    good = tagged.where(F.size("violations") == 0).drop("violations")
    bad = tagged.where(F.size("violations") > 0)
    return good, bad


def schema_reports(df: DataFrame, contracts: dict[str, DataFrame], any_declared: bool = False) -> DataFrame:
    """Reports of one table against several contracts (``variant`` column);
    the null counts (of columns that some variant requires) are computed once."""
    spark = df.sparkSession
    exp = reduce(lambda a, b: a.unionByName(b), [
        c.select(F.lit(v).alias("variant"), F.col("COLUMN_NAME").alias("column_name"),
                 F.col("DATA_TYPE").alias("expected_type"), _required(c, any_declared).alias("required"))
        for v, c in contracts.items()])
    actual_rows = [(v, f.name, sql_type_name(f)) for v in contracts for f in df.schema.fields]
    act = local_rows(spark, actual_rows, "variant string, column_name string, actual_type string")
    needed = {c for contract in contracts.values() for c in _required_names(df, contract, any_declared)}
    nulls = null_counts(df, [c for c in df.columns if c in needed])
    joined = exp.join(act, ["variant", "column_name"], "full_outer").join(nulls, "column_name", "left")
    required = F.coalesce(F.col("required"), F.lit(False))
    status = (F.when(F.col("actual_type").isNull(), "missing")
              .when(F.col("expected_type").isNull(), "extra")
              .when(F.lower("expected_type") != F.lower("actual_type"), "type_mismatch")
              .when(required & (F.col("null_count") > 0), "null_violation")
              .otherwise("ok"))
    return joined.select("variant", "column_name", "expected_type", "actual_type", required.alias("required"),
                         F.when(required, F.col("null_count").cast("bigint")).alias("null_count"), status.alias("status"))
