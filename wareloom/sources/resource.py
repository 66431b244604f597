"""SQL over loaded resources, and JSON query results to tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions.columns import flatten


def resource_sql(spark: SparkSession, views: dict[str, DataFrame], sql: str, args: dict | None = None) -> DataFrame:
    """Run a resource query (e.g. a per-year count) with bound named parameters."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql, args=args or None)


def yearly_counts(df: DataFrame, date_col: str, since: str) -> DataFrame:
    """Rows per year from ``since`` on (the example resource query)."""
    return (df.where(F.col(date_col) >= F.lit(since).cast("timestamp_ntz"))
            .groupBy(F.year(date_col).alias("yr"))
            .agg(F.count(F.lit(1)).alias("n")))


def json_records(df: DataFrame, text_col: str, schema: T.StructType | str | None = None,
                 keep: list[str] | None = None) -> DataFrame:
    """Parse a JSON-object text column and flatten it to top-level columns.

    Without a schema it is inferred by Spark's JSON reader over the whole
    column: the texts are written once as a text table in the shared
    checkpoint folder and ``spark.read.json`` infers from it (JVM-side,
    distributed; no Python round trip of the strings).
    """
    spark = df.sparkSession
    if schema is None:
        from wareloom.session import scratch_path

        path = scratch_path(spark, "json-infer")
        df.select(F.col(text_col).alias("value")).where(F.col("value").isNotNull()).write.text(path)
        schema = spark.read.json(path).schema
    keep = keep or [c for c in df.columns if c != text_col]
    parsed = df.select(*[F.col(c) for c in keep], F.from_json(F.col(text_col), schema).alias(text_col))
    return flatten(parsed)
