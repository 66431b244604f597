"""Incremental pulls by high-water mark.

``high_water`` is one global aggregate over the target (a one-row result,
read on the driver).  The mark then becomes a literal filter on the source,
so Catalyst pushes it into the scan (Parquet ``PushedFilters`` / row-group
skipping, JDBC ``WHERE``): only new rows are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom.functions.dates import day_floor

# Allow-lists: the aggregate and the comparison come from job configuration.
AGGREGATES = {"max": F.max, "min": F.min, "avg": F.avg, "sum": F.sum, "count": F.count}
TYPED_LITERALS = {"timestamp_ntz": "TIMESTAMP_NTZ", "date": "DATE"}
OPERATORS = {
    ">": lambda c, v: c > v, ">=": lambda c, v: c >= v,
    "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v,
}


def high_water(target: DataFrame | None, column: str, agg: str = "max", trunc: str | None = None):
    """The mark as a literal column of its own type, or None for a missing / empty target.

    Instants cross the driver as epoch microseconds, dates and zone-free timestamps as
    text, and come back as literals of their own type, so neither the driver's nor
    the session's zone shifts them, also not in the hour that a zone repeats."""
    if target is None:
        return None
    fn = AGGREGATES[agg.lower()]
    value: Column = fn(F.col(f"`{column}`"))
    if trunc == "day":
        value = day_floor(value)
    elif trunc is not None:
        raise ValueError(f"unknown truncation {trunc!r}")
    found = target.agg(value.alias("v"))
    kind = found.schema["v"].dataType.simpleString()
    if kind == "timestamp":
        micros = found.select(F.unix_micros("v").alias("v")).first()["v"]
        return None if micros is None else F.timestamp_micros(F.lit(micros))
    if kind not in TYPED_LITERALS:
        mark = found.first()["v"]
        return None if mark is None else F.lit(mark)
    text = found.select(F.col("v").cast("string").alias("v")).first()["v"]
    return None if text is None else F.expr(f"{TYPED_LITERALS[kind]}'{text}'")


def pull(source: DataFrame, target: DataFrame | None, column: str, agg: str = "max", op: str = ">",
         trunc: str | None = None, source_column: str | None = None) -> DataFrame:
    """Rows of ``source`` beyond the target's mark; everything when there is no mark."""
    mark = high_water(target, column, agg, trunc)
    if mark is None:
        return source
    col = F.col(f"`{source_column or column}`")
    return source.where(OPERATORS[op](col, mark))


def pull_sql(spark: SparkSession, sql: str, target: DataFrame | None, column: str, agg: str = "max",
             trunc: str | None = None, views: dict[str, DataFrame] | None = None, fallback_sql: str | None = None) -> DataFrame:
    """Custom query with the mark bound as the named parameter ``:value``.

    No text is pasted into the query; with no mark, ``fallback_sql`` (the
    unfiltered query) runs instead.
    """
    for name, df in (views or {}).items():
        df.createOrReplaceTempView(name)
    mark = high_water(target, column, agg, trunc)
    if mark is None:
        if fallback_sql is None:
            raise ValueError("no mark and no fallback query")
        return spark.sql(fallback_sql)
    return spark.sql(sql, args={"value": mark})
