"""Column functions: names, dates, types, text, geometry."""

import datetime as dt

from pyspark.sql import functions as F

from wareloom.functions import columns as C
from wareloom.functions import dates as D
from wareloom.functions import geo as G
from wareloom.functions import infer as I
from wareloom.functions import text as TX


def test_snake_case():
    assert C.snake_case("PartKey") == "part_key"
    assert C.snake_case("HTTPBrand") == "http_brand"
    assert C.snake_case("__RetailPrice__") == "retail_price"
    assert C.snake_case("Size@Bin") == "sizebin"
    assert C.snake_case("First Name!") == "first_name"


def test_unique_and_clean_names():
    assert C.unique_names(["a", "a", "a_2", "b"]) == ["a", "a_2", "a_2_2", "b"]
    assert C.clean_name("Total $ Amount (USD)") == "total_amount_usd"
    assert C.replace_chars("first name.x") == "first_namex"


def test_union_fill_widens(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1.5, "z")], "x double, w string")
    out = C.union_fill([a, b])
    assert dict(out.dtypes) == {"x": "double", "y": "int", "w": "string"}
    assert out.count() == 2


def test_flatten(spark):
    d = spark.createDataFrame([((1, (2, 3)),)], "s struct<a:int, b:struct<c:int, d:int>>")
    assert C.flatten(d).columns == ["s_a", "s_b_c", "s_b_d"]


def test_cyyddd(spark):
    d = spark.createDataFrame([("124366",), ("123366",), ("169001",), ("099001",), ("x",), (None,), ("100060",)],
                              "c string")
    got = [r[0] for r in d.select(D.from_cyyddd("c")).collect()]
    assert got == [dt.date(2024, 12, 31), None, dt.date(1969, 1, 1), None, None, None, dt.date(2000, 2, 29)]


def test_parse_timestamp_keeps_wall_time_in_any_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        d = spark.createDataFrame([("2024-03-10 02:30:00.000",), ("2024-01-05",), ("2024-02-30 00:00:00",)], "t string")
        got = [r[0] for r in d.select(D.parse_timestamp("t")).collect()]
        assert got[0] == dt.datetime(2024, 3, 10, 2, 30)  # inside the DST gap of the session zone
        assert got[1] == dt.datetime(2024, 1, 5)
        assert got[2] is None
        ms = spark.createDataFrame([(1704067207179,)], "m bigint").select(D.epoch_millis_to_ts("m")).first()[0]
        assert ms == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_nth_weekday_window(spark):
    d = spark.createDataFrame([(dt.datetime(2024, 1, 16, 20, 0),), (dt.datetime(2024, 1, 16, 23, 0, 0, 1),),
                               (dt.datetime(2024, 1, 9, 21, 0),), (dt.datetime(2024, 1, 16, 23, 0),)], "ts timestamp_ntz")
    got = [r[0] for r in d.select(D.in_nth_weekday_window("ts")).collect()]
    assert got == [True, False, False, True]


def test_infer_profile_wide_path_matches(spark):
    d = spark.createDataFrame([("1", "x", None), ("22", "3", None)], "a string, b string, c string")
    narrow = I.profile(d)
    old = I.WIDE_PROFILE_COLUMNS
    I.WIDE_PROFILE_COLUMNS = 1
    try:
        wide = I.profile(d)
    finally:
        I.WIDE_PROFILE_COLUMNS = old
    assert narrow == wide
    assert narrow["a"].all_digits and not narrow["b"].all_digits and narrow["c"].all_digits


def test_unicode_digit_is_not_a_digit(spark):
    d = spark.createDataFrame([("½",), ("12",)], "a string")
    assert not I.profile(d)["a"].all_digits


def test_cp1252_high_range(spark):
    raw = bytes(range(0x80, 0xA0))
    d = spark.createDataFrame([(bytearray(raw),)], "b binary")
    got = d.select(TX.from_cp1252("b")).first()[0]
    expected = "".join(TX.CP1252_HIGH.get(b, chr(b)) for b in raw)
    assert got == expected
    bad = spark.createDataFrame([(bytearray(b"ok\xff"),)], "b binary").select(TX.from_utf8_lenient("b")).first()[0]
    assert bad == "ok�"


def test_point_in_polygon_concave_and_hole(spark):
    # concave "U" shape and a square with a square hole
    u = [[[0, 0], [3, 0], [3, 3], [2, 3], [2, 1], [1, 1], [1, 3], [0, 3], [0, 0]]]
    holed = [[[10, 10], [14, 10], [14, 14], [10, 14], [10, 10]], [[11, 11], [13, 11], [13, 13], [11, 13], [11, 11]]]
    def fl(rs):
        return [[[float(v) for v in p] for p in r] for r in rs]

    polys = spark.createDataFrame([(0, "U", fl(u)), (1, "H", fl(holed))],
                                  "poly_order int, NAME string, rings array<array<array<double>>>")
    pts = spark.createDataFrame([(1, 0.5, 2.5), (2, 1.5, 2.5), (3, 10.5, 10.5), (4, 12.0, 12.0), (5, None, None)],
                                "pid int, longitude double, latitude double")
    from wareloom.operators.spatial import locate

    got = {r["pid"]: r["NAME"] for r in locate(pts, polys, ["NAME"]).collect()}
    assert got == {1: "U", 2: None, 3: "H", 4: None, 5: None}


def test_wkt_and_split_point(spark):
    d = spark.createDataFrame([('{"type":"Point","coordinates":[1.5,2]}',), (None,)], "g string")
    assert [r[0] for r in d.select(G.to_wkt("g")).collect()] == ["POINT (1.5 2.0)", None]
    s = G.split_point(d, "g")
    assert s.columns == ["longitude", "latitude"]
    assert [tuple(r) for r in s.collect()] == [(1.5, 2.0), (None, None)]


def test_keep_leading_zero_codes(spark):
    d = spark.createDataFrame([("00731", "12"), ("15213", "7")], "zip string, n string")
    out = I.convert_types(d, keep_leading_zeros=True)
    assert dict(out.dtypes) == {"zip": "string", "n": "bigint"}
    assert dict(I.convert_types(d).dtypes) == {"zip": "bigint", "n": "bigint"}


def test_workbook_sheet_choice(spark, tmp_path):
    from wareloom.plans.workbook_fixture import customer_workbooks
    from wareloom.sources import workbooks as WB

    cust = spark.range(0, 10).select(F.col("id").alias("c_custkey"), F.concat(F.lit("n"), F.col("id").cast("string"))
                                     .alias("c_name"), (F.col("id") * 1.5).alias("c_acctbal"),
                                     F.lit("BUILDING").alias("c_mktsegment"))
    (tmp_path / "wb").mkdir()
    for r in customer_workbooks(cust).collect():
        (tmp_path / "wb" / r.path).write_bytes(r.content)
    first = WB.read_folder(spark, str(tmp_path / "wb"), sheet=0, skip=1, column_types={"c_custkey": "bigint"})
    named = WB.read_folder(spark, str(tmp_path / "wb"), sheet="more", skip=1, column_types={"c_custkey": "bigint"})
    assert sorted(r[0] for r in first.collect()) == [0, 2, 4, 6, 8]
    assert sorted(r[0] for r in named.collect()) == [1, 3, 5, 7, 9]
    assert first.columns == ["c_custkey", "c_name", "c_acctbal"]
