"""Column profiles that add up: a table is profiled by its new rows only.

A state has one row per column: row, value and digit counts, longest value, values with a
leading zero, and values of a date's shape (digit counts are NULL for columns that are not text).  Counts add and lengths take the larger, so
the state of a table is the merge of its batches' states.  States are kept in a
table, a batch at a time as one whole; a batch that is already there is not read again.
From the merged state come the type inference (B8, B10), the null report
(C5), the digit counts (C7) and the long-text list (B6, C6) without a scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom import catalog
from wareloom.functions import dates as D
from wareloom.functions.infer import DIGITS, WIDE_PROFILE_COLUMNS, ColumnProfile

COUNTS = ["n_rows", "non_null", "non_digit", "leading_zero", "dated"]
SCHEMA = "column_name string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", max_length bigint"


def state(df: DataFrame) -> DataFrame:
    """(column_name, counts, max_length) of ``df``: one aggregate job for every 200 columns."""
    names = df.columns
    if len(names) > WIDE_PROFILE_COLUMNS:
        blocks = [names[i : i + WIDE_PROFILE_COLUMNS] for i in range(0, len(names), WIDE_PROFILE_COLUMNS)]
        return reduce(lambda a, b: a.unionByName(b), [state(df.select(*[F.col(f"`{c}`") for c in b])) for b in blocks])
    shapes = [s for s in map(D.pattern_shape, D.DEFAULT_PATTERNS) if s]
    aggs = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        text = c.cast("string")
        is_text = isinstance(f.dataType, T.StringType)
        dated = reduce(lambda a, b: a | b, [text.rlike(s) for s in shapes]) if is_text else F.lit(False)
        aggs += [F.count(F.lit(1)).alias(f"a{i}"), F.count(c).alias(f"b{i}"),
                 (F.count_if(c.isNotNull() & ~text.rlike(DIGITS)) if is_text else F.lit(None).cast("bigint")).alias(f"c{i}"),
                 (F.count_if(text.startswith("0") & (F.length(text) > 1)) if is_text else F.lit(None).cast("bigint")).alias(f"d{i}"),
                 F.count_if(dated).alias(f"e{i}"), F.max(F.length(text)).cast("bigint").alias(f"f{i}")]
    wide = df.agg(*aggs)
    quoted = lambda n: "'" + n.replace("\\", "\\\\").replace("'", "\\'") + "'"
    stack = ", ".join(f"{quoted(n)}, " + ", ".join(f"{x}{i}" for x in "abcdef") for i, n in enumerate(names))
    return wide.selectExpr(f"stack({len(names)}, {stack}) as (column_name, {', '.join(COUNTS)}, max_length)")


def merge(states: DataFrame) -> DataFrame:
    """One state from several; a column that a batch lacks has NULLs in that batch's rows."""
    per = states.groupBy("column_name").agg(*[F.sum(c).alias(c) for c in COUNTS], F.max("max_length").alias("max_length"))
    if "batch" not in states.columns:
        return per
    total = states.groupBy("batch").agg(F.max("n_rows").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("__all"))  # one row
    return per.crossJoin(total).withColumn("n_rows", F.col("__all")).drop("__all")


def record(df: DataFrame, states_table: str, table: str, batch: str) -> bool:
    """Add the state of a batch of ``table``; False (and no read) when it is there already."""
    spark = df.sparkSession
    if not catalog.exists(spark, states_table):
        empty = spark.createDataFrame([], f"{SCHEMA}, batch string, table_name string")
        catalog.publish(empty, states_table, partition_by=["table_name"])
    held = spark.table(states_table).where((F.col("table_name") == table) & (F.col("batch") == batch))
    if not held.isEmpty():
        return False
    catalog.publish(state(df).coalesce(1).select("*", F.lit(batch).alias("batch"), F.lit(table).alias("table_name")), states_table, "append")
    return True


def merged(spark: SparkSession, states_table: str, table: str) -> DataFrame:
    """The state of all recorded batches of ``table``."""
    return merge(spark.table(states_table).where(F.col("table_name") == table).drop("table_name"))


def null_report(merged_state: DataFrame) -> DataFrame:
    return merged_state.select("column_name", (F.col("n_rows") - F.col("non_null")).alias("null_count"))


def long_text(merged_state: DataFrame, limit: int = 255) -> DataFrame:
    return merged_state.select("column_name", "max_length", F.coalesce(F.col("max_length") > limit, F.lit(False)).alias("long_text"))


def column_profiles(merged_state: DataFrame) -> dict[str, ColumnProfile]:
    """The profiles of the text columns, as ``infer.convert_types`` takes them; one row per column is read."""
    return {r["column_name"]: ColumnProfile(r["column_name"], r["non_null"], r["non_digit"], r["max_length"], r["leading_zero"]) for r in merged_state.where("non_digit is not null").collect()}
