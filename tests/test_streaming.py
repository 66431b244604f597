"""Landing-folder stream: restart with the same checkpoint reads only new files."""


from wareloom import catalog
from wareloom.streaming import landing as LS


def test_landing_restart_and_modes(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS land_t LOCATION '{tmp_path}/wh'")
    schema = "k bigint, v string"
    master = "land_t.m"
    catalog.publish(spark.createDataFrame([(1, "a"), (2, "b")], schema), master)
    ck = str(tmp_path / "ck")
    spark.createDataFrame([(2, "B"), (3, "C")], schema).write.parquet(str(tmp_path / "in" / "d1"))
    LS.load_landing(spark, str(tmp_path / "in" / "*"), schema, master, ["k"], ck).awaitTermination()
    assert sorted(map(tuple, spark.table(master).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    # restart: nothing new, nothing applied twice
    LS.load_landing(spark, str(tmp_path / "in" / "*"), schema, master, ["k"], ck).awaitTermination()
    assert spark.table(master).count() == 3
    # a new drop is picked up on the next run
    spark.createDataFrame([(1, "A")], schema).write.parquet(str(tmp_path / "in" / "d2"))
    LS.load_landing(spark, str(tmp_path / "in" / "*"), schema, master, ["k"], ck).awaitTermination()
    assert sorted(map(tuple, spark.table(master).collect())) == [(1, "A"), (2, "B"), (3, "C")]


def test_landing_append_new(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS land_n LOCATION '{tmp_path}/wh'")
    schema = "k bigint, v string"
    master = "land_n.m"
    catalog.publish(spark.createDataFrame([(1, "a")], schema), master)
    spark.createDataFrame([(1, "a"), (2, "b")], schema).write.parquet(str(tmp_path / "in" / "d1"))
    LS.load_landing(spark, str(tmp_path / "in" / "*"), schema, master, ["k", "v"], str(tmp_path / "ck"),
                    mode="append_new").awaitTermination()
    assert sorted(map(tuple, spark.table(master).collect())) == [(1, "a"), (2, "b")]
