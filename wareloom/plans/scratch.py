"""Databases that registered queries fill: below the shared scratch folder, one of a kind per run."""

from __future__ import annotations

from pyspark.sql import SparkSession

from wareloom.session import scratch_path


def scratch_database(spark: SparkSession, name: str) -> str:
    """A new database for one run of a query.

    The databases of a session's earlier runs of the same query are dropped first; the last one stays, as the
    query's result is read from it after the call.
    """
    path = scratch_path(spark, f"db-{name}")
    prefix = f"wl_q_{name.replace('-', '_')}_"
    for old in spark.catalog.listDatabases(f"{prefix}*"):
        spark.sql(f"DROP DATABASE IF EXISTS {old.name} CASCADE")
    db = prefix + path.rsplit("-", 1)[-1]
    spark.sql(f"CREATE DATABASE {db} LOCATION '{path}'")
    return db
