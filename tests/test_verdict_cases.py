"""Hard inputs of single operators: wide digits, short patterns, polygons of all sizes, short pages, geometry kinds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wareloom import cli
from wareloom.functions import dates as D
from wareloom.functions import geo as G
from wareloom.functions import infer as I
from wareloom.operators import listing as L
from wareloom.operators import quality as Q
from wareloom.operators import spatial as SP
from wareloom.sources import jdbc, paged


def test_digits_wider_than_any_number_stay_text(spark):
    df = spark.createDataFrame([("1" * 40, "2" * 38, "7"), ("3" * 40, "4", None)], "a string, b string, c string")
    out = I.digits(df)
    assert dict(out.dtypes) == {"a": "string", "b": "decimal(38,0)", "c": "bigint"}
    assert {r.a for r in out.collect()} == {"1" * 40, "3" * 40}
    assert dict(I.convert_types(df).dtypes)["a"] == "string"


def test_wide_empty_text_profile_keeps_its_rows(spark):
    wide = spark.createDataFrame([], ", ".join(f"c{i} string" for i in range(401)))
    assert I.long_text_profile(wide).count() == 401


def test_point_names_that_are_taken(spark):
    df = spark.createDataFrame([("x", '{"type":"Point","coordinates":[1,2]}')], "longitude string, the_latitude_longitude string")
    for out in (I.convert_types(df), G.split_point(df, "the_latitude_longitude")):
        assert sorted(out.columns) == ["latitude", "longitude", "longitude_2"]
        assert out.select("longitude", "longitude_2", "latitude").first() == ("x", 1.0, 2.0)


@pytest.mark.parametrize("text,want", [
    ("2024-01-01T10:00:00Z", dt.datetime(2024, 1, 1, 10)), ("2024-01-01 10:00", dt.datetime(2024, 1, 1, 10)), ("2024-01-01T10:05", dt.datetime(2024, 1, 1, 10, 5)),
    ("2024-01-01 10:00:00.123456", dt.datetime(2024, 1, 1, 10, 0, 0, 123456)), ("2024-01-01T10:00:00.5+02:00", dt.datetime(2024, 1, 1, 10, 0, 0, 500000)),
    ("2024-01-01", dt.datetime(2024, 1, 1)), ("2024-01-01T10:00:00.123", dt.datetime(2024, 1, 1, 10, 0, 0, 123000)), ("2024-13-01", None), ("x", None), (None, None)])
def test_date_texts(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(D.parse_timestamp("t").alias("t")).first()["t"] == want


@pytest.mark.parametrize("geometry,want", [
    ('{"type":"GeometryCollection","geometries":[{"type":"Point","coordinates":[1,2]},{"type":"LineString","coordinates":[[0,0],[1,1]]}]}',
     "GEOMETRYCOLLECTION (POINT (1.0 2.0), LINESTRING (0.0 0.0, 1.0 1.0))"),
    ('{"type":"GeometryCollection","geometries":[]}', "GEOMETRYCOLLECTION EMPTY"), ('{"type":"Polygon","coordinates":[]}', "POLYGON EMPTY"),
    ('{"type":"Point","coordinates":[]}', "POINT EMPTY"), ('{"type":"Point","coordinates":[1,2]}', "POINT (1.0 2.0)"), (None, None)])
def test_wkt_kinds(spark, geometry, want):
    df = spark.createDataFrame([(geometry,)], "g string")
    assert df.select(G.to_wkt("g").alias("w")).first()["w"] == want


FILES = "id string, name string, path string, created timestamp_ntz"


def listing(spark, names):
    return spark.createDataFrame([(f"i{k}", n, "/p", dt.datetime(2024, 1, 1)) for k, n in enumerate(names)], FILES)


def test_short_patterns_next_to_an_empty_one(spark):
    files = listing(spark, ["abc.txt", "b.csv", "long_file_name.txt", "", None])
    req = spark.createDataFrame([(1, "ab", 5), (2, "", 5), (3, "b", 5), (4, None, 5), (5, "file_name", 5), (6, "xt", 5), (7, "nothing here", 5)], "req_id int, pattern string, top int")
    got = {}
    for r in L.latest(req, files).collect():
        got.setdefault(r.req_id, set()).add(r.name)
    assert got == {1: {"abc.txt"}, 3: {"abc.txt", "b.csv"}, 5: {"long_file_name.txt"}, 6: {"abc.txt", "long_file_name.txt"}}
    assert L.latest(req.where("req_id = 2"), files).count() == 0


def test_candidates_grow_with_the_listing(spark, monkeypatch):
    """Candidate rows (before the exact test) per file, for n files and n requests."""
    def per_file(n):
        files = listing(spark, [f"page_{k}" for k in range(n)])
        req = spark.createDataFrame([(k, f"page_{k}", 1) for k in range(n)], "req_id int, pattern string, top int")
        seen = []
        real = type(files).where

        def where(self, condition):
            if "__pattern" in self.columns and "__name" in self.columns:
                seen.append(self.count())
            return real(self, condition)

        with monkeypatch.context() as m:
            m.setattr(type(files), "where", where)
            L.contains_matches(files, req, "name", "pattern", ["req_id", "pattern"])
        return seen[0] / n

    assert per_file(2000) < 3 * per_file(250)


def test_polygons_of_very_different_sizes(spark):
    square = lambda x, y, w: [[[x, y], [x + w, y], [x + w, y + w], [x, y + w]]]
    polys = [(0, "tiny", square(5.0, 5.0, 0.001)), (1, "huge", square(-1e6, -1e6, 2e6)), (2, "flat", [[[50.0, 50.0], [60.0, 50.0], [70.0, 50.0]]]),
             (3, "none", []), (4, "hole", square(20.0, 20.0, 10.0) + square(24.0, 24.0, 2.0))] + [(10 + i, f"p{i}", square(100.0, 100.0, 1.0)) for i in range(300)]
    polygons = spark.createDataFrame(polys, "poly_order int, NAME string, rings array<array<array<double>>>")
    points = spark.createDataFrame([(1, 5.0005, 5.0005), (2, 7.0, 7.0), (3, 2e6, 0.0), (4, None, 1.0), (5, 100.5, 100.5), (5, 100.5, 100.5)], "id int, longitude double, latitude double")
    got = sorted((r.id, r.NAME) for r in SP.locate(points, polygons, ["NAME"]).collect())
    assert got == sorted([(1, "tiny"), (2, "huge"), (3, None), (4, None), (5, "huge"), (5, "huge")], key=lambda r: r[0])
    cells = SP.polygon_cells(SP.shapes(polygons, ["NAME"]))
    assert cells.count() <= 4 * len(polys)
    few = SP.locate(points, polygons.where("poly_order > 1"), ["NAME"])
    assert {r.id: r.NAME for r in few.collect()}[5] == "p0"


def test_int64_keys_survive_an_export(spark):
    df = spark.createDataFrame([(3000000000, 1, None), (1, 2, None)], "`a id` bigint, b bigint, c bigint")
    out = jdbc.prepare_export(df)
    assert dict(out.dtypes) == {"a_id": "bigint", "b": "int", "c": "int"} and {r.a_id for r in out.collect()} == {3000000000, 1}


class ShortPages:
    """Eight rows; never more than two to a call."""

    def __init__(self, opts):
        self.n = int(opts.get("rows", 8))

    def count(self):
        return 8

    def fetch(self, offset, limit):
        return [{"k": i} for i in range(offset, min(offset + min(limit, 2), self.n))]

    def follow(self, link):
        return [{"k": 1}], "a"


@pytest.mark.parametrize("per", [1, 3])
def test_short_pages_lose_nothing(monkeypatch, per):
    monkeypatch.setitem(paged.TRANSPORTS, "short", ShortPages)
    reader = paged.PagedRecordsReader({"transport": "short", "page_size": "3", "pages_per_partition": str(per)})
    assert sum(len(list(reader.read(p))) for p in reader.partitions()) == 8
    fewer = paged.PagedRecordsReader({"transport": "short", "page_size": "3", "rows": "5"})
    with pytest.raises(RuntimeError, match="planned"):
        [list(fewer.read(p)) for p in fewer.partitions()]


def test_a_chain_that_comes_back_raises(monkeypatch):
    monkeypatch.setitem(paged.TRANSPORTS, "short", ShortPages)
    reader = paged.PagedRecordsReader({"transport": "short", "paging": "cursor", "starts": '["a"]'})
    with pytest.raises(RuntimeError, match="comes back"):
        list(reader.read(reader.partitions()[0]))


def test_negations_are_left_to_spark():
    from pyspark.sql import datasource as ds

    for f in (ds.Not(ds.In(("e",), ("a",))), ds.Not(ds.EqualNullSafe(("e",), "a")), ds.EqualNullSafe(("e",), "a")):
        assert not paged._supported(f, {"e"})
    assert paged._supported(ds.In(("e",), ("a",)), {"e"})


def test_cli_pulls_and_validates_every_table(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS staging")
    for t, rows in (("a", [(1,)]), ("b", [(None,)])):
        spark.createDataFrame(rows, "k int").write.parquet(f"{tmp_path}/{t}")
    env = {"DEPT": "cv", "SOURCE": "s", "TABLES": "a,b", "SOURCE_PATH": f"{tmp_path}/{{table}}"}
    assert len(cli.pull(env)) == 2 and spark.table("staging.cv_s_a").count() == spark.table("staging.cv_s_b").count() == 1
    with pytest.raises(ValueError):
        cli.pull(env | {"SOURCE_PATH": f"{tmp_path}/a"})
    with pytest.raises(Q.ContractError, match="^b: "):
        cli.validate(env | {"COL_SCHEMA": '[{"COLUMN_NAME": "k", "DATA_TYPE": "int", "NAs": false}]'})


def test_reports_scan_required_columns_only(spark, sf):
    df = spark.read.parquet(f"{sf}/lineitem.parquet")
    report = Q.schema_report(df, Q.generate_contract(df, ["l_orderkey"]))
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "l_comment" not in plan and report.where("null_count is not null").count() == 1
    assert Q.schema_report(df, Q.generate_contract(df), profile=True).where(F.col("null_count").isNull()).count() == 0
    complete = Q.generate_contract(spark.createDataFrame([(1, None), (2, "x")], "a int, b string"), "complete")
    assert {r.COLUMN_NAME: r.NAs for r in complete.collect()} == {"a": False, "b": None}
