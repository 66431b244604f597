"""Plan properties: one-job profiles, pushed filters, no Python in the hot path."""

from pyspark.sql import functions as F

from wareloom.operators import incremental as INC
from wareloom.operators import quality as Q
from wareloom.plans import fixtures as FX
from wareloom.plans import registry as R


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, fn):
    sc = spark.sparkContext
    sc.setJobGroup("probe", "probe")
    try:
        fn()
        return len(sc.statusTracker().getJobIdsForGroup("probe"))
    finally:
        sc.setJobGroup("other", "other")


def test_null_counts_is_one_scan(spark, sf):
    d = FX.text_orders(spark, sf)
    plan = plan_text(Q.null_counts(d))
    assert plan.count("Scan parquet") == 1


def test_incremental_filter_reaches_the_scan(spark, sf):
    o = FX.table(spark, sf, "orders")
    pulled = INC.pull(o, o.where("o_orderkey < 100"), "o_orderkey")
    plan = plan_text(pulled)
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey,99)]" in plan


def test_column_pruning_in_replace_report(spark, sf):
    plan = plan_text(R.QUERIES["replace_report"](spark, sf))
    assert "l_comment" not in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


NO_PYTHON = ["replace_by_key", "replace_report", "append_new_keys", "schema_check", "null_report", "infer_digits",
             "cp1252_repair", "locate_points", "geocode_locator", "listing_latest", "arrival_status", "geojson_to_wkt",
             "epoch_millis", "nth_weekday_window"]


def test_no_python_in_core_plans(spark, sf):
    for name in NO_PYTHON:
        plan = plan_text(R.QUERIES[name](spark, sf))
        for marker in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF"):
            assert marker not in plan, (name, marker)


def test_locate_broadcasts_cells_not_points(spark, sf):
    plan = plan_text(R.QUERIES["locate_points"](spark, sf))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_replace_plan_without_broadcast(spark, sf):
    """The large-data shape: a sort-merge anti join on the salted struct key."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    old_aqe = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(R.QUERIES["replace_by_key"](spark, sf))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        if old_aqe is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old_aqe)
    assert "SortMergeJoin" in plan and "LeftAnti" in plan and "__wl_key" in plan
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
