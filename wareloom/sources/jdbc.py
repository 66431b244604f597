"""Database tables over JDBC (SQL Server, Oracle, DB2/AS400, Postgres).

Reads are split into ``num_partitions`` range scans on a numeric / date
column; the bounds come from a pushed-down ``min``/``max`` query when not
given.  Filters built on the DataFrame (high-water marks) are pushed into
the remote ``WHERE``.  Not exercised by the test suite: that would need a
database server.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

FETCH_SIZE = 20_000
BATCH_SIZE = 1_024


def _reader(spark: SparkSession, url: str, properties: dict | None, fetchsize: int):
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetchsize)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    return r


def query(spark: SparkSession, url: str, sql: str, properties: dict | None = None,
          fetchsize: int = FETCH_SIZE) -> DataFrame:
    """A custom query as a source (one partition; wrap big queries in ``table``)."""
    return _reader(spark, url, properties, fetchsize).option("query", sql).load()


def table(spark: SparkSession, url: str, dbtable: str, partition_column: str | None = None,
          num_partitions: int = 1, lower: object = None, upper: object = None,
          properties: dict | None = None, fetchsize: int = FETCH_SIZE) -> DataFrame:
    """``SELECT * FROM dbtable`` read as parallel range scans."""
    r = _reader(spark, url, properties, fetchsize).option("dbtable", dbtable)
    if partition_column and num_partitions > 1:
        if lower is None or upper is None:
            b = query(spark, url, f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {dbtable}",
                      properties).first()
            lower, upper = b["lo"], b["hi"]
        if lower is not None and upper is not None:
            r = (r.option("partitionColumn", partition_column).option("lowerBound", str(lower))
                 .option("upperBound", str(upper)).option("numPartitions", num_partitions))
    return r.load()


def prepare_export(df: DataFrame, int64_to_int: bool = True) -> DataFrame:
    """Target-ready columns in one projection: spaces in names become ``_``, dots
    are dropped, and 64-bit integer columns narrow to int where every value
    fits (one aggregate of their bounds); the others keep their type."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    from wareloom.functions.columns import replace_chars, unique_names

    names = unique_names(replace_chars(c) for c in df.columns)
    longs = [f.name for f in df.schema.fields if isinstance(f.dataType, T.LongType)] if int64_to_int else []
    fits = set()
    if longs:
        out_of_int = lambda c: F.count_if(~F.col(f"`{c}`").between(-(2**31), 2**31 - 1))
        row = df.agg(*[out_of_int(c).alias(f"n{i}") for i, c in enumerate(longs)]).first()
        fits = {c for i, c in enumerate(longs) if row[f"n{i}"] == 0}
    return df.select(*[(F.col(f"`{c}`").cast("int") if c in fits else F.col(f"`{c}`")).alias(n) for c, n in zip(df.columns, names)])


def column_types(df: DataFrame, long_cols: list[str] | None = None, width: int = 255) -> str:
    """``createTableColumnTypes`` text: listed long-text columns get an
    unlimited width, other strings ``VARCHAR(width)``."""
    from pyspark.sql import types as T

    long_cols = set(long_cols or [])
    parts = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType):
            parts.append(f"{f.name} {'VARCHAR(MAX)' if f.name in long_cols else f'VARCHAR({width})'}")
    return ", ".join(parts)


def write(df: DataFrame, url: str, dbtable: str, mode: str = "overwrite", column_types: str | None = None,
          properties: dict | None = None, batchsize: int = BATCH_SIZE) -> None:
    """Export to a database table (drop and recreate on overwrite); ``column_types``
    sets widths, e.g. ``"notes VARCHAR(MAX)"``."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", dbtable).option("batchsize", batchsize)
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
