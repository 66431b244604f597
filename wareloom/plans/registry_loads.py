"""Registered warehouse-load queries that go through the catalog (publish paths)."""

from __future__ import annotations

from pyspark.sql import functions as F

from wareloom.plans import fixtures as FX
from wareloom.plans.registry import LINE_COLS, register, with_


@register("replace_partitions", with_("master_lines") + f""",
staging AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice + 100 AS l_extendedprice,
                   l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
            FROM lineitem WHERE l_orderkey % 10 >= 5 AND l_returnflag = 'R')
SELECT {LINE_COLS} FROM master_lines m
WHERE NOT EXISTS (SELECT 1 FROM staging s WHERE s.l_returnflag = m.l_returnflag AND s.l_orderkey = m.l_orderkey
                  AND s.l_linenumber = m.l_linenumber)
UNION ALL SELECT {LINE_COLS} FROM staging""")
def q_replace_partitions(spark, d):
    """Replace by (l_returnflag, l_orderkey, l_linenumber) on a master partitioned
    by l_returnflag; staging touches only the 'R' partition, so only it is rewritten."""
    from wareloom import jobs
    from wareloom.naming import TableRef
    from wareloom.plans.scratch import scratch_database

    target = scratch_database(spark, "partitions")
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    ref = TableRef("wl", target, "lines")
    FX.master_lines(spark, d).write.partitionBy("l_returnflag").saveAsTable(ref.at(target).qualified)
    staging = FX.staging_lines(spark, d).where(F.col("l_returnflag") == "R")
    jobs.stage(staging, ref)
    jobs.run_replace_partitions(spark, ref, ["l_returnflag", "l_orderkey", "l_linenumber"], ["l_returnflag"],
                                target_layer=target)
    return spark.table(ref.at(target).qualified)
