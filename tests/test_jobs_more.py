"""More unit cases: bound-parameter pulls, gated overwrite, export row numbers, type repair by catalog type."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wareloom import catalog, jobs
from wareloom.functions import types as TY
from wareloom.naming import TableRef
from wareloom.operators import incremental as INC
from wareloom.operators import load as LD
from wareloom.sinks import export as X
from wareloom.sources import files as FS


def test_pull_sql_binds_the_mark(spark):
    src = spark.createDataFrame([(i, f"r{i}") for i in range(10)], "k bigint, v string")
    target = spark.createDataFrame([(4, "x")], "k bigint, v string")
    out = INC.pull_sql(spark, "SELECT * FROM src_view WHERE k > :value", target, "k", views={"src_view": src})
    assert sorted(r[0] for r in out.collect()) == [5, 6, 7, 8, 9]
    full = INC.pull_sql(spark, "SELECT * FROM src_view WHERE k > :value", None, "k", views={"src_view": src},
                        fallback_sql="SELECT * FROM src_view")
    assert full.count() == 10


def test_pull_with_empty_target_reads_everything(spark):
    src = spark.createDataFrame([(1,), (2,)], "k bigint")
    assert INC.pull(src, src.where("k > 5"), "k").count() == 2
    with pytest.raises(KeyError):
        INC.pull(src, src, "k", agg="median")


def test_run_overwrite_gate(spark):
    for db in ("staging", "master"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    ref = TableRef("g", "s", "t")
    catalog.publish(spark.createDataFrame([(1,), (2,)], "id bigint"), ref.at("master").qualified)
    jobs.stage(spark.createDataFrame([(1,), (2,)], "id bigint"), ref)
    with pytest.raises(LD.GateError):
        jobs.run_overwrite(spark, ref, id_cols=["id"], require_new_ids=True)
    jobs.stage(spark.createDataFrame([(2,), (3,)], "id bigint"), ref)
    assert jobs.run_overwrite(spark, ref, id_cols=["id"], require_new_ids=True).startswith("overwrote")
    assert sorted(r[0] for r in spark.table(ref.at("master").qualified).collect()) == [2, 3]
    assert jobs.run_overwrite(spark, ref).startswith("skipped")


def test_csv_row_numbers_and_null_marker(spark, tmp_path):
    d = spark.createDataFrame([(3, None), (1, ""), (2, "x")], "k int, v string")
    X.csv(d, str(tmp_path / "c"), null_value="NA", row_numbers_by=["k"], snake_header=True)
    back = FS.delimited(spark, str(tmp_path / "c"), sep=",", schema="row_name bigint, k int, v string",
                        null_value="NA")
    assert sorted(map(tuple, back.collect())) == [(1, 1, ""), (2, 2, "x"), (3, 3, None)]


def test_datetimes_by_type_and_to_double(spark):
    d = spark.createDataFrame([(dt.date(2024, 1, 2), 5, "7")], "d date, i int, s string")
    out = TY.to_double(TY.datetimes_by_type(d), ["s"])
    assert dict(out.dtypes) == {"d": "timestamp_ntz", "i": "double", "s": "double"}
    assert out.first()["d"] == dt.datetime(2024, 1, 2)


def test_copy_tables_with_long_text_last(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS copy_t LOCATION '{tmp_path}/copy_t'")
    d = spark.createDataFrame([(1, "long", "a")], "k int, notes string, c string")
    rep = jobs.copy_tables(spark, {"t": d}, "copy_t", suffix="_x", long_text=["notes"])
    assert [tuple(r) for r in rep.collect()] == [("t", 1)]
    assert spark.table("copy_t.t_x").columns == ["k", "c", "notes"]


def test_for_each_table_parallel():
    got = jobs.for_each_table(["a", "b", "c"], lambda t: t.upper(), parallel=2)
    assert got == {"a": "A", "b": "B", "c": "C"}


def test_catalog_columns_listing(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS cat_t")
    catalog.publish(spark.createDataFrame([(1, "a")], "k int, v string"), "cat_t.one")
    rows = {(r["table_name"], r["column_name"], r["data_type"]) for r in catalog.columns(spark, ["cat_t"]).collect()}
    assert rows == {("one", "k", "int"), ("one", "v", "varchar")}


def test_geojson_lines_keep_null_properties(spark, tmp_path):
    d = spark.createDataFrame([(1, -80.0, 40.5, None), (2, None, None, "x")], "id int, lon double, lat double, n string")
    X.geojson_lines(d, str(tmp_path / "g"), "lon", "lat", ["id", "n"])
    lines = [r[0] for r in spark.read.text(str(tmp_path / "g")).collect()]
    assert lines == ['{"type":"Feature","geometry":{"type":"Point","coordinates":[-80.0,40.5]},'
                     '"properties":{"id":1,"n":null}}']


def test_wide_null_counts_and_lengths(spark):
    from wareloom.functions import infer as I
    from wareloom.operators import quality as Q

    d = spark.range(0, 50).select(*[F.when(F.col("id") % (i + 2) == 0, None).otherwise(F.col("id").cast("string"))
                                    .alias(f"c{i}") for i in range(5)])
    narrow = sorted(map(tuple, Q.null_counts(d).collect()))
    narrow_len = sorted(map(tuple, I.long_text_profile(d, 1).collect()))
    old = Q.WIDE_COLUMNS
    Q.WIDE_COLUMNS = I.WIDE_PROFILE_COLUMNS = 2
    try:
        assert sorted(map(tuple, Q.null_counts(d).collect())) == narrow
        assert sorted(map(tuple, I.long_text_profile(d, 1).collect())) == narrow_len
    finally:
        Q.WIDE_COLUMNS = old
        I.WIDE_PROFILE_COLUMNS = 200


def test_safe_cast_equals_try_cast(spark):
    vals = [" 12", "+7", "-0000000000000005", "2147483647", "2147483648", "-2147483648", "99999999999999999999",
            "9" * 39, "12.5", "12.", "n/a", "", None, "１２", "0" * 30 + "42", " -9223372036854775808 "]
    d = spark.createDataFrame([(v,) for v in vals], "s string")
    for t in ("tinyint", "smallint", "int", "bigint", "decimal(38,0)", "decimal(10,2)", "double"):
        got = d.select(TY.safe_cast("s", t).alias("a"), F.col("s").try_cast(t).alias("b")).collect()
        assert [r["a"] for r in got] == [r["b"] for r in got], t


def test_jdbc_column_types_and_errorifexists(spark, tmp_path):
    from wareloom.sources.jdbc import column_types

    d = spark.createDataFrame([(1, "a", "b")], "k bigint, notes string, c string")
    assert column_types(d, ["notes"]) == "notes VARCHAR(MAX), c VARCHAR(255)"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS once_t LOCATION '{tmp_path}/once'")
    catalog.publish(d, "once_t.t", "errorifexists")
    with pytest.raises(RuntimeError):
        catalog.publish(d, "once_t.t", "errorifexists")


def test_cluster_conf_sizes_from_volume():
    from wareloom.session import cluster_conf

    conf = cluster_conf(100 * 1024 ** 4, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert int(cluster_conf(10 * 1024 ** 2, 64)["spark.sql.shuffle.partitions"]) == 192


def test_failed_publish_leaves_master_untouched(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS fail_t LOCATION '{tmp_path}/fail'")
    good = spark.createDataFrame([(1,), (2,)], "k bigint")
    catalog.publish(good, "fail_t.m")
    bad = good.select(F.when(F.col("k") == 2, F.raise_error(F.lit("boom"))).otherwise(F.col("k")).alias("k"))
    with pytest.raises(Exception):
        catalog.publish(bad, "fail_t.m")
    assert sorted(r[0] for r in spark.table("fail_t.m").collect()) == [1, 2]
    catalog.publish(good.where("k = 1"), "fail_t.m")  # the next run still publishes
    assert [r[0] for r in spark.table("fail_t.m").collect()] == [1]


def test_small_public_helpers(spark, tmp_path):
    from wareloom.functions import columns as C
    from wareloom.functions import geo as G
    from wareloom.sources import resource as R

    ref = TableRef("d", "s", "t", "master")
    assert (ref.geocoded, ref.usps_geocoded) == ("master.d_s_t_G", "master.d_s_t_uspsG")
    d = spark.createDataFrame([(1, 2, 3)], "`Unnamed: 0` int, `a:@computed_x` int, `Total Amount` int")
    assert C.drop_matching(d, r"^Unnamed").columns == ["a:@computed_x", "Total Amount"]
    assert C.clean_columns(d).columns == ["unnamed_0", "a_computed_x", "total_amount"]
    g = spark.createDataFrame([('{"type":"MultiPolygon","coordinates":[[[[0,0],[1,0],[1,1],[0,0]]],'
                                '[[[5,5],[6,5],[6,6],[5,5]]]]}',)], "g string")
    assert len(g.select(G.rings_of_geojson("g")).first()[0]) == 2
    o = spark.createDataFrame([(dt.datetime(1995, 5, 1),), (dt.datetime(1996, 5, 1),), (dt.datetime(1996, 7, 1),)],
                              "d timestamp_ntz")
    assert sorted(map(tuple, R.yearly_counts(o, "d", "1996-01-01").collect())) == [(1996, 2)]
    m = spark.createDataFrame([(1, 10, "a"), (2, 20, "b")], "row_id bigint, k bigint, v string")
    s = spark.createDataFrame([(20, "B"), (30, "C")], "k bigint, v string")
    out = LD.replace_generated_id(m, s, ["k"], "row_id", ["k"])
    assert sorted(map(tuple, out.collect())) == [(1, 10, "a"), (3, 20, "B"), (4, 30, "C")]
    (tmp_path / "cp").mkdir()
    (tmp_path / "cp" / "x.csv").write_bytes(b"name\n\x93caf\xe9\x94 \x80\n")
    got = FS.delimited_cp1252(spark, str(tmp_path / "cp"), sep=",", schema="name string").first()[0]
    assert got == "“café” €"


def test_json_records_infers_schema(spark):
    from wareloom.sources import resource as R

    d = spark.createDataFrame([(1, '{"a": 1, "b": {"c": "x"}}'), (2, '{"a": 2}'), (3, None)], "id int, j string")
    out = R.json_records(d, "j")
    assert out.columns == ["id", "j_a", "j_b_c"]
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 1, "x"), (2, 2, None), (3, None, None)], key=str)


def test_file_listing_without_contents(spark, tmp_path):
    from wareloom.sources import files as FSRC

    (tmp_path / "in" / "sub").mkdir(parents=True)
    (tmp_path / "in" / "a.csv").write_text("x\n1\n")
    (tmp_path / "in" / "sub" / "b.csv").write_text("x\n2\n")
    (tmp_path / "in" / "sub" / "c.txt").write_text("skip")
    df = FSRC.listing(spark, str(tmp_path / "in"), glob="*.csv")
    got = sorted((r["name"], r["path"].endswith("/sub"), r["length"]) for r in df.collect())
    assert got == [("a.csv", False, 4), ("b.csv", True, 4)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    read_schema = plan[plan.index("ReadSchema:"):].split("\n")[0]
    assert "content" not in read_schema  # the bytes are never read


def test_extract_modes(spark, tmp_path):
    d = spark.createDataFrame([(1, dt.date(2024, 1, 2))], "k int, d date")
    path = str(tmp_path / "x")
    X.extract(d, path, "create")
    X.extract(d, path, "append")
    back = spark.read.parquet(path)
    assert dict(back.dtypes) == {"k": "double", "d": "timestamp_ntz"} and back.count() == 2
    with pytest.raises(Exception):
        X.extract(d, path, "create")


def test_run_append_adds_files_only(spark, tmp_path):
    import glob as _glob

    spark.sql(f"CREATE DATABASE IF NOT EXISTS staging")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS app_m LOCATION '{tmp_path}/app_m'")
    ref = TableRef("ap", "src", "t")
    catalog.publish(spark.createDataFrame([(1, "a", "x")], "k bigint, v string, w string"), "app_m.ap_src_t")
    before = set(_glob.glob(f"{tmp_path}/app_m/ap_src_t/*.parquet"))
    jobs.stage(spark.createDataFrame([(2, "b")], "k int, v string"), ref)  # narrower type, one column fewer
    assert jobs.run_append(spark, ref, target_layer="app_m").startswith("appended")
    after = set(_glob.glob(f"{tmp_path}/app_m/ap_src_t/*.parquet"))
    assert before < after  # old files kept, new ones added
    assert sorted(map(tuple, spark.table("app_m.ap_src_t").collect())) == [(1, "a", "x"), (2, "b", None)]


def test_replace_only_touched_partitions(spark, tmp_path):
    import glob as _glob

    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS part_m LOCATION '{tmp_path}/part_m'")
    ref = TableRef("pt", "src", "t")
    master = spark.createDataFrame([(1, "a", "r1"), (2, "b", "r1"), (3, "c", "r2"), (4, "d", "r3")],
                                   "id bigint, v string, region string")
    master.write.partitionBy("region").saveAsTable("part_m.pt_src_t")
    untouched = set(_glob.glob(f"{tmp_path}/part_m/pt_src_t/region=r2/*")) | \
        set(_glob.glob(f"{tmp_path}/part_m/pt_src_t/region=r3/*"))
    jobs.stage(spark.createDataFrame([(2, "B", "r1"), (5, "E", "r1")], "id bigint, v string, region string"), ref)
    expected = sorted(map(tuple, LD.replace(spark.table("part_m.pt_src_t"), spark.table("staging.pt_src_t"),
                                            ["region", "id"]).collect()))
    out = jobs.run_replace_partitions(spark, ref, ["region", "id"], ["region"], target_layer="part_m")
    assert out["status"].startswith("replaced 1 partition")
    got = sorted(map(tuple, spark.table("part_m.pt_src_t").select("id", "v", "region").collect()))
    assert got == expected
    assert untouched <= set(_glob.glob(f"{tmp_path}/part_m/pt_src_t/region=*/*"))  # r2, r3 files not rewritten
    with pytest.raises(ValueError):
        jobs.run_replace_partitions(spark, ref, ["id"], ["region"], target_layer="part_m")
