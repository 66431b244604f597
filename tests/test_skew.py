"""Hot keys: one key (or NULL) holding a third of the rows must not land in one task,
and results must stay whole and exact."""

from pyspark.sql import functions as F

from wareloom.operators import listing as L
from wareloom.operators import load as LD


def hot_master(spark, n=3000):
    # a third of the rows share key 7, a sixth have a NULL key, the rest are unique
    return spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 6 == 1, F.lit(None)).otherwise(F.col("id") + 100)
        .cast("bigint").alias("k"), F.col("id").alias("v"))


def test_null_keys_are_spread_over_partitions(spark):
    m = hot_master(spark)
    salted = m.withColumn("__key", LD._match_key(["k"], LD._null_salt(m, ["k"])))
    parts = (salted.where("k IS NULL").select(F.pmod(F.hash("__key"), F.lit(8)).alias("p"))
             .distinct().count())
    assert parts == 8  # not one NULL-key partition


def test_hot_key_replace_is_exact(spark):
    m = hot_master(spark)
    s = spark.createDataFrame([(7, -1), (7, -2), (None, -3)], "k bigint, v bigint")
    out = LD.replace(m, s, ["k"])
    expected = m.where("k IS NULL OR k <> 7").count() + 3
    assert out.count() == expected
    assert out.where("k = 7").count() == 2


def test_aqe_splits_a_skewed_anti_join(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        m = hot_master(spark, 20000)
        s = spark.range(0, 50).select((F.col("id") * 1000).cast("bigint").alias("k"), F.lit(0).cast("bigint").alias("v"))
        out = LD.delete_by_key(m, s, ["k"])
        assert len(out.collect()) == m.where("k IS NULL OR k % 1000 <> 0 OR k >= 50000").count()
        plan = out._jdf.queryExecution().executedPlan().toString()
        # the NULL-key salt is part of the shuffle key, and AQE splits the hot key's partition
        assert "__wl_key" in plan and "SortMergeJoin" in plan
        assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_top_n_with_a_hot_group(spark):
    d = spark.range(0, 6000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(
        (F.col("id") % 50).cast("string")).alias("g"), F.col("id").alias("t"))
    top = L.top_n_per_group(d, ["g"], [F.col("t").desc()], 3, salt_buckets=16)
    hot = [r["t"] for r in top.where("g = 'hot'").orderBy("rank").collect()]
    assert hot == [5997, 5994, 5991]
    assert top.groupBy("g").count().where("count <> 3").count() == 0


def _small_skew_conf(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    return old


def _restore(spark, old):
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_locate_without_broadcast_equals_broadcast(spark, sf):
    from wareloom.operators.spatial import locate
    from wareloom.plans import fixtures as FX

    pts, polys = FX.points(spark, sf), FX.counties(spark, sf)
    small = sorted(map(tuple, locate(pts, polys, ["STATE", "NAME"]).collect()), key=repr)
    old = _small_skew_conf(spark)
    try:
        shuffled = locate(pts, polys, ["STATE", "NAME"])
        got = sorted(map(tuple, shuffled.collect()), key=repr)
        assert "BroadcastHashJoin" not in shuffled._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    assert got == small


def test_geocode_hot_address_is_split(spark):
    from wareloom.operators import enrich as E

    addrs = spark.range(0, 20000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit("1 MAIN ST"))
                                         .otherwise(F.concat(F.lit("A"), F.col("id").cast("string"))).alias("FULL_ADDRESS"))
    loc = spark.range(0, 20000, 7).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("FULL_ADDRESS"),
                                          F.lit(90).alias("score"), F.lit(1.0).alias("longitude"), F.lit(2.0).alias("latitude"))
    old = _small_skew_conf(spark)
    try:
        out = E.geocode(addrs, loc)
        rows = out.collect()
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        _restore(spark, old)
    assert len(rows) == 20000
    assert sum(1 for r in rows if r["latitude"] is not None) == len([i for i in range(0, 20000, 7) if i % 3 != 0])
    assert "SortMergeJoin(skew=true)" in plan
