"""Loads that stop half-way, mixed key types, partitions: no master row is lost or doubled."""

import datetime as dt

import pytest
from pyspark.sql import SparkSession

from wareloom import catalog, jobs
from wareloom.functions import columns as C
from wareloom.naming import TableRef
from wareloom.operators import enrich as E
from wareloom.operators import incremental as INC
from wareloom.operators import load as LD
from wareloom.operators import quality as Q


class Stop(Exception):
    pass


@pytest.fixture
def ref(spark, request):
    for db in ("staging", "master"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    return TableRef("safe", "t", "x" + str(abs(hash(request.node.nodeid)) % 10**8))


def table(spark, rows, schema="k bigint, v string"):
    return spark.createDataFrame(rows, schema)


def content(spark, name):
    spark.catalog.refreshTable(name)
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def stop_at(monkeypatch, n):
    """Fails the n-th ALTER / DROP TABLE from now on."""
    seen, real = [0], SparkSession.sql

    def sql(self, text, *a, **b):
        if text.startswith(("ALTER TABLE", "DROP TABLE")):
            seen[0] += 1
            if seen[0] == n:
                raise Stop(text)
        return real(self, text, *a, **b)

    monkeypatch.setattr(SparkSession, "sql", sql)


RUNS = {
    "replace": (lambda s, r: jobs.run_replace(s, r, ["k"]), [(1, "a"), (2, "new"), (4, "d")]),
    "overwrite": (lambda s, r: jobs.run_overwrite(s, r), [(2, "new"), (4, "d")]),
    "append": (lambda s, r: jobs.run_append(s, r), [(1, "a"), (2, "b"), (2, "new"), (4, "d")]),
    "partitions": (lambda s, r: jobs.run_replace_partitions(s, r, ["k"], ["k"]), [(1, "a"), (2, "new"), (4, "d")]),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_a_stop_at_any_step_loses_and_doubles_nothing(spark, ref, name):
    run, want = RUNS[name]
    master = ref.at("master").qualified
    for n in range(1, 8):
        catalog.drop(spark, master)
        by = ["k"] if name == "partitions" else None
        catalog.publish(table(spark, [(1, "a"), (2, "b")]).select("v", "k") if by else table(spark, [(1, "a"), (2, "b")]), master, partition_by=by)
        jobs.stage(table(spark, [(2, "new"), (4, "d")]), ref)
        with pytest.MonkeyPatch.context() as m:
            stop_at(m, n)
            try:
                run(spark, ref)
            except Stop:
                pass
        run(spark, ref)  # the rerun recovers; it is skipped when staging is gone
        assert content(spark, master) == sorted([(v, k) for k, v in want] if by else want, key=str), n
        assert not catalog.exists(spark, ref.qualified)


def test_partitioned_loads(spark, ref):
    master = ref.at("master").qualified
    first = table(spark, [(1, "p"), (2, "q"), (3, None)])
    jobs.stage(first, ref)
    jobs.run_replace_partitions(spark, ref, ["k", "v"], ["v"])  # the first load creates the partitioning
    assert catalog.partition_columns(spark, master) == ["v"]
    jobs.stage(table(spark, [(1, "p"), (9, "p")]), ref)
    jobs.run_replace_partitions(spark, ref, ["k", "v"], ["v"])
    jobs.stage(table(spark, [(7, None)]), ref)
    jobs.run_replace_partitions(spark, ref, ["k", "v"], ["v"])  # the NULL partition keeps its row
    assert content(spark, master) == sorted([(1, "p"), (9, "p"), (2, "q"), (3, None), (7, None)], key=str)
    jobs.stage(table(spark, [(2, "q")]), ref)
    jobs.run_replace(spark, ref, ["k"])
    assert catalog.partition_columns(spark, master) == ["v"]  # a publish keeps it
    jobs.stage(table(spark, [(1, "p")]), ref)
    with pytest.raises(ValueError, match="partitioned by"):
        jobs.run_replace_partitions(spark, ref, ["k", "v"], ["k"])
    assert len(content(spark, master)) == 5
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_partition_loads_side_by_side(spark):
    refs = [TableRef("safe", "par", f"t{i}") for i in range(3)]
    for r in refs:
        catalog.publish(table(spark, [(1, "a"), (2, "b"), (3, "c")]), r.at("master").qualified, partition_by=["v"])
        jobs.stage(table(spark, [(20, "b")]), r)
    run = lambda n: jobs.run_replace_partitions(spark, refs[int(n)], ["k", "v"], ["v"])
    jobs.for_each_table(["0", "1", "2"], run, parallel=3)
    for r in refs:
        assert content(spark, r.at("master").qualified) == [(1, "a"), (2, "b"), (20, "b"), (3, "c")]


def test_keys_meet_in_the_common_type(spark):
    m = table(spark, [(1, "a"), (2, "b")], "k int, v string")
    mixed = table(spark, [(1.5, "x"), (2.0, "y")], "k double, v string")
    got = LD.replace(m, LD.fits(m, mixed, ["k"]), ["k"])
    assert got.schema == m.schema and {r.v for r in got.collect()} == {"a", "y"} and [r.v for r in LD.misfits(m, mixed, ["k"]).collect()] == ["x"]
    got = LD.delete_by_key(m, table(spark, [(2.0, "y"), (1.5, "x")], "k double, v string"), ["k"])
    assert [tuple(r) for r in got.collect()] == [(1, "a")]
    days = table(spark, [(dt.date(2024, 1, 1), "a"), (dt.date(2024, 1, 2), "b")], "k date, v string")
    stamps = table(spark, [(dt.datetime(2024, 1, 1, 10), "x"), (dt.datetime(2024, 1, 2), "y")], "k timestamp_ntz, v string")
    assert [r.v for r in LD.delete_by_key(days, stamps, ["k"]).collect()] == ["a"]
    texts = table(spark, [("2", "x"), ("1.5", "y"), ("one", "z")], "k string, v string")
    assert [r.v for r in LD.delete_by_key(m, texts, ["k"]).collect()] == ["a"]
    report = LD.replace_report(m, table(spark, [(1.5, "x")], "k double, v string"), ["k"]).first()
    assert (report.deleted, report.inserted) == (0, 1)


def test_fewer_columns_and_map_columns(spark):
    m = spark.createDataFrame([(1, "a", {"x": 1}), (None, "n", {"y": 2})], "k bigint, v string, m map<string,int>")
    got = LD.replace(m, spark.createDataFrame([(1,), (5,)], "k int"), ["k"])
    assert got.schema.simpleString() == m.schema.simpleString()
    assert sorted(((r.k, r.v) for r in got.collect()), key=str) == sorted([(None, "n"), (1, None), (5, None)], key=str)


def test_generated_ids_as_a_job(spark, ref):
    jobs.stage(table(spark, [(5, "a"), (6, "b")], "id bigint, v string"), ref)
    jobs.run_replace_generated_id(spark, ref, ["v"], "id", ["v"])
    jobs.stage(table(spark, [(99, "b"), (99, "c")], "id bigint, v string"), ref)
    jobs.run_replace_generated_id(spark, ref, ["v"], "id", ["v"])
    got = {r.v: r.id for r in spark.table(ref.at("master").qualified).collect()}
    assert set(got) == {"a", "b", "c"} and sorted(got.values()) == [1, 3, 4]


def test_convert_datetimes_in_place(spark, ref):
    jobs.stage(spark.createDataFrame([("2024-01-01T10:00:00Z", 1), ("no", 2)], "at string, k int"), ref)
    jobs.convert_datetimes(spark, ref, ["at"])
    assert [r["at"] for r in spark.table(ref.qualified).orderBy("k").collect()] == [dt.datetime(2024, 1, 1, 10), None]


def test_null_addresses_match_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, "A  st")], "id int, FULL_ADDRESS string")
    loc = spark.createDataFrame([(None, 9.0, 1.0, 2.0), ("a st", 1.0, 3.0, 4.0)], "FULL_ADDRESS string, score double, longitude double, latitude double")
    assert {r.id: r.longitude for r in E.geocode(df, loc).collect()} == {1: None, 2: 3.0}


def test_null_ids_are_not_appended_again(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS geo_safe")
    src = spark.createDataFrame([(1, "a"), (None, "b")], "id bigint, FULL_ADDRESS string")
    for _ in range(3):
        E.run(src, "geo_safe.g", lambda d: d)
    assert spark.table("geo_safe.g").count() == 2


def test_client_calls_are_spread_and_kept(spark, tmp_path):
    df = spark.createDataFrame([(i, f"a{i % 400}") for i in range(800)], "id int, FULL_ADDRESS string")
    log = str(tmp_path)

    def factory():
        import os
        import uuid

        def call(addresses):
            with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
                f.write(str(len(addresses)))
            return [(1.0, 2.0) for _ in addresses]
        return call

    out = E.with_client(df, factory, parallelism=5)
    assert out.where("longitude = 1").count() == 800 and out.count() == 800
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert len(sizes) == 5 and sum(sizes) == 400  # once per address, though the result was used twice


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_marks_do_not_shift_with_a_zone(spark, monkeypatch, zone):
    import time

    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        src = spark.createDataFrame([("2024-03-01 13:00:00",), ("2024-03-01 20:00:00",), ("2024-03-01 11:59:59.5",)], "t string").selectExpr("cast(t as timestamp_ntz) as t")
        target = spark.sql("select timestamp_ntz'2024-03-01 12:00:00' as t")
        assert INC.pull(src, target, "t").count() == 2
        assert INC.pull(src.selectExpr("cast(t as timestamp) as t"), target.selectExpr("cast(t as timestamp) as t"), "t").count() == 2
    finally:
        monkeypatch.undo()
        time.tzset()


def test_union_fill_keeps_decimals(spark):
    one = spark.sql("select cast(1.25 as decimal(10,2)) as a, 7 as b")
    two = spark.sql("select cast(3.5 as decimal(12,1)) as a, cast(2.5 as decimal(5,2)) as b")
    got = C.union_fill([one, two])
    assert dict(got.dtypes) == {"a": "decimal(13,2)", "b": "decimal(12,2)"}
    assert sorted(float(r.a) for r in got.collect()) == [1.25, 3.5]


@pytest.mark.parametrize("name,want", [
    ("HTTPServerError", "http_server_error"), ("camelCase2Go", "camel_case2_go"), ("a b!c@d#", "a_bcd"), ("__id__", "id"), ("___x", "_x"),
    ("Total Amount", "total__amount"[:5] + "_amount"), ("x1Y", "x1_y"), ("ABC", "abc"), ("", "")])
def test_snake_case(name, want):
    assert C.snake_case(name) == want


def test_pretty_printed_contract_file(spark, tmp_path):
    path = tmp_path / "c.json"
    path.write_text('[\n  {"COLUMN_NAME": "a",\n   "DATA_TYPE": "int", "NAs": false},\n  {"COLUMN_NAME": "b", "DATA_TYPE": "varchar"}\n]\n')
    assert [tuple(r) for r in Q.contract_from_json(spark, str(path)).collect()] == [("a", "int", False), ("b", "varchar", None)]
    path.write_text('{"COLUMN_NAME": "a", "DATA_TYPE": "int"}\n{"COLUMN_NAME": "b", "DATA_TYPE": "varchar"}\n')
    assert Q.contract_from_json(spark, str(path)).count() == 2


def test_wide_empty_table_keeps_its_rows(spark):
    wide = spark.createDataFrame([], ", ".join(f"c{i} int" for i in range(201)))
    assert Q.null_counts(wide).where("null_count = 0").count() == 201
