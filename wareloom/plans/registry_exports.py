"""Registered export queries (database export preparation)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareloom.plans import fixtures as FX
from wareloom.plans.registry import register


@register("db_export_prepare", """
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS INTEGER) AS Customer_Key,
  o_orderstatus AS orderstatus, o_totalprice AS total_price, o_orderdate AS Order_Date,
  CASE WHEN o_orderkey % 5 = 0 THEN 9000000000 + o_orderkey WHEN o_orderkey % 5 = 1 THEN o_orderkey * 1000 END::BIGINT AS bigvalue_raw
FROM orders""")
def q_db_export_prepare(spark, d):
    """Orders with warehouse-style names prepared for a database export:
    spaces to ``_``, dots dropped, bigint narrowed to int where every value fits."""
    from wareloom.sources.jdbc import prepare_export

    o = FX.table(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = o.select(
        "o_orderkey", F.col("o_custkey").alias("Customer Key"), F.col("o_orderstatus").alias("order.status"),
        F.col("o_totalprice").alias("total price"), F.col("o_orderdate").alias("Order Date"),
        F.when(k % 5 == 0, F.lit(9_000_000_000) + k).when(k % 5 == 1, k * 1000).alias("big.value raw"))
    return prepare_export(raw)
