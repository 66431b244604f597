"""Answer store, checked copies, exact keys, headers, line breaks, date shapes, bands of polygons, folder joins, command line jobs."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F
from test_workbooks_more import workbook

from wareloom import catalog, cli, jobs
from wareloom.functions import dates as D
from wareloom.naming import TableRef
from wareloom.operators import enrich as E
from wareloom.operators import listing as L
from wareloom.operators import load as LD
from wareloom.operators import spatial as SP
from wareloom.sinks import export as X
from wareloom.sources import files as FS
from wareloom.sources import workbooks as W


@pytest.fixture(scope="module", autouse=True)
def databases(spark):
    for db in ("staging", "master", "state"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")


# ---- answers -----------------------------------------------------------------

def asking(log, fail_at=None):
    def factory():
        import os
        import uuid

        def call(addresses):
            if fail_at in addresses:
                raise RuntimeError("service down")
            with open(os.path.join(log, uuid.uuid4().hex), "w") as f:
                f.write("\n".join(addresses))
            return [None if a.strip().endswith("0") else (1.0, float(a.split()[-1])) for a in addresses]
        return call
    return factory


def calls(path):
    return sorted(a for p in path.iterdir() for a in p.read_text().split("\n"))


def test_answers_survive_runs_and_failures(spark, tmp_path):
    store = "state.answers"
    df = spark.createDataFrame([(i, None if i % 9 == 0 else f"Road {i % 40}" if i % 2 else f" road  {i % 40} ") for i in range(200)], "id int, FULL_ADDRESS string")
    # a run that fails in some wave keeps the answers of the waves before it
    with pytest.raises(Exception, match="service down"):
        E.answers(df, asking(str(tmp_path), fail_at="Road 33"), store, wave=8, in_flight=1)
    before = spark.table(store).count()
    assert 0 <= before < 40
    n = E.answers(df, asking(str(tmp_path)), store, wave=8, in_flight=2)
    assert n == -(-(40 - before) // 8) and spark.table(store).count() == 40
    stored = [r.key for r in spark.table(store).collect()]
    assert len(set(stored)) == 40
    asked = len(calls(tmp_path))
    out = E.with_client(df, asking(str(tmp_path)), store=store)
    got = {r.id: r.latitude for r in out.collect()}
    assert got == {i: None if i % 9 == 0 or i % 40 % 10 == 0 else float(i % 40) for i in range(200)}
    assert len(calls(tmp_path)) == asked  # nothing is asked twice, addresses without a place neither
    E.answers(df.unionByName(spark.createDataFrame([(900, "Road 41")], df.schema)), asking(str(tmp_path)), store)
    assert len(calls(tmp_path)) == asked + 1


def test_waves_are_bounded_and_read_their_own_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(E, "WAVES", 4)
    df = spark.range(60).select("id", F.concat(F.lit("Road "), F.col("id").cast("string")).alias("FULL_ADDRESS"))
    assert E.answers(df, asking(str(tmp_path)), "state.bounded", wave=2, in_flight=8) == 4
    assert spark.table("state.bounded").count() == 60 and len(calls(tmp_path)) == 60
    assert len(spark.table("state.bounded").inputFiles()) <= 5  # that of the empty table, and one to a wave
    assert E.answers(df, asking(str(tmp_path)), "state.bounded", wave=2) == 0


def test_a_client_must_answer_every_address(spark):
    df = spark.createDataFrame([(1, "a")], "id int, FULL_ADDRESS string")
    with pytest.raises(Exception, match="0 answers to 1"):
        E.answers(df, lambda: (lambda a: []), "state.short")


# ---- copies ------------------------------------------------------------------

def test_a_copy_with_one_changed_cell_is_refused(spark, monkeypatch):
    src = spark.createDataFrame([(i, None if i % 7 == 0 else f"v{i}", float(i), dt.datetime(2024, 1, 1, 1, 1, 1, i), [i]) for i in range(300)], "k long, v string, d double, t timestamp, a array<int>")
    assert jobs.copy_tables(spark, {"t": src}, "state", "_ok").collect()[0]["rows"] == 300
    real = catalog.publish
    for change in (F.when(F.col("k") == 7, "").otherwise(F.col("v")), F.when(F.col("k") == 5, "v6").when(F.col("k") == 6, "v5").otherwise(F.col("v"))):
        monkeypatch.setattr(catalog, "publish", lambda df, t, *a, c=change, **b: real(df.withColumn("v", c) if t.startswith("state.t") else df, t, *a, **b))
        with pytest.raises(jobs.CopyError, match="differs"):
            jobs.copy_tables(spark, {"t": src}, "state", "_bad")
    monkeypatch.undo()
    one, two = jobs.content_digest(src).first(), jobs.content_digest(src.repartition(7).select("a", "t", "d", "v", "k")).first()
    assert one == two and jobs.content_digest(src.limit(0)).first()["rows"] == 0
    assert jobs.content_digest(src.unionByName(src.limit(1))).first() != one


# ---- keys --------------------------------------------------------------------

def test_keys_are_compared_exactly(spark):
    wide = 2**53
    m = spark.createDataFrame([(wide + 1, "a"), (wide, "b"), (5, "c")], "k bigint, v string")
    s = spark.createDataFrame([(float(wide), "x"), (5.0, "y"), (-0.0, "z"), (None, "n")], "k double, v string")
    got = sorted(map(tuple, LD.replace(m, s, ["k"]).collect()), key=str)
    assert got == sorted([(wide + 1, "a"), (wide, "x"), (5, "y"), (0, "z"), (None, "n")], key=str)
    for bad in (1.5, float("nan"), float("inf"), 1e300, 2.0**63):
        odd = spark.createDataFrame([(bad, "x"), (5.0, "y")], "k double, v string")
        assert LD.misfits(m, odd, ["k"]).count() == 1 and LD.fits(m, odd, ["k"]).count() == 1
        with pytest.raises(Exception, match="cannot hold"):
            LD.replace(m, odd, ["k"]).collect()
        assert LD.replace_report(m, LD.fits(m, odd, ["k"]), ["k"]).first()["deleted"] == 1
    with pytest.raises(ValueError, match="cannot be compared exactly"):
        LD.delete_by_key(m.selectExpr("cast(k as decimal(20,2)) k", "v"), s, ["k"])
    texts = spark.createDataFrame([("5", "x"), ("05", "y"), ("five", "z")], "k string, v string")
    assert [r.v for r in LD.misfits(m, texts, ["k"]).collect()] == ["z"]
    narrow = spark.createDataFrame([(1, "a")], "k int, v string")
    assert LD.misfits(narrow, spark.createDataFrame([(2**40, "x"), (7, "y")], "k bigint, v string"), ["k"]).count() == 1


def test_a_job_refuses_a_lossy_key_and_keeps_all(spark):
    ref = TableRef("st", "t", "lossy")
    catalog.publish(spark.createDataFrame([(1, "a")], "k bigint, v string"), ref.at("master").qualified)
    jobs.stage(spark.createDataFrame([(1.5, "x")], "k double, v string"), ref)
    with pytest.raises(Exception, match="cannot hold"):
        jobs.run_replace(spark, ref, ["k"])
    assert spark.table(ref.at("master").qualified).count() == 1 and spark.table(ref.qualified).count() == 1


# ---- workbooks and text --------------------------------------------------------

@pytest.mark.parametrize("headers,clean,want", [
    (["amt", "amt", "amt_2"], False, ["amt", "amt_3", "amt_2"]), (["a", "A", "a"], False, ["a", "A_2", "a_3"]), (["Order ID", "order-id", "ORDER_ID_2"], True, None),
    ([], False, []), (["x", "x", "x_2", "x_2"], False, ["x", "x_3", "x_2", "x_2_2"])])
def test_header_names(headers, clean, want):
    got = W.header_names(headers, clean)
    assert len({n.lower() for n in got}) == len(headers)
    assert want is None or got == want


def test_headers_meet_across_files(spark, tmp_path):
    workbook(tmp_path / "a.xlsx", {"S": [["amt", "amt", "amt_2", "Order ID"], [(1, 0), (2, 0), (3, 0), "x"]]})
    workbook(tmp_path / "b.xlsx", {"S": [["order id", "AMT", "file"], ["y", (4, 0), "own"]]})
    out = W.read_folder(spark, str(tmp_path))
    assert [c.lower() for c in out.columns] == ["amt", "order id", "amt_3", "amt_2", "file"] or set(c.lower() for c in out.columns) == {"amt", "amt_3", "amt_2", "order id", "file"}
    rows = sorted(tuple(r[c] for c in ("amt", "amt_3", "amt_2", "order id", "file")) for r in out.collect())
    assert rows == [("1", "2", "3", "x", None), ("4", None, None, "y", "own")]
    clean = W.read_folder(spark, str(tmp_path), clean=True, keep_source=True)
    assert {"order_id", "amt", "amt_2", "amt_3"} <= set(clean.columns) and clean.count() == 2


def test_cells_come_event_by_event(tmp_path, monkeypatch):
    workbook(tmp_path / "big.xlsx", {"S": [["a", "b"]] + [[(i, 0), f"t{i}"] for i in range(3000)]})
    monkeypatch.setattr(W.ET, "fromstring", lambda data, real=W.ET.fromstring: real(data) if len(data) < 5000 else pytest.fail("a whole sheet was parsed"))
    cells = list(W.parse_xlsx((tmp_path / "big.xlsx").read_bytes()))
    assert len(cells) == 6002 and cells[-1] == (0, "S", 3001, 2, "t2999")


def test_values_keep_breaks_quotes_and_blanks(spark, tmp_path):
    rows = [(1, 'a\n"b",\n'), (2, "  blanks  "), (3, "\n"), (4, None), (5, ""), (6, "NA?"), (7, '"')]
    df = spark.createDataFrame(rows, "k int, v string")
    X.csv(df, str(tmp_path / "c"), null_value="NA")
    assert sorted(map(tuple, FS.delimited(spark, str(tmp_path / "c"), sep=",", schema="k int, v string", null_value="NA").collect())) == rows


FORMS = ["2024-01-02 03:04:05.123456", "2024-01-02 03:04:05.1", "2024-01-02 03:04:05", "2024-01-02 03:04", "2024-01-02T03:04:05.12", "2024-01-02T03:04:05", "2024-01-02T03:04", "2024-01-02",
         "2024-02-30", "2024-1-2", "24-01-02", "2024-01-02 3:04", "2024-01-02 25:00", "", " ", None, "2024-01-02x", "x2024-01-02", "2024-01-02T03:04:05Z", "2024-01-02 03:04:05+05:30", "2024-01-02 03:04:05 -0330",
         "2024-01-02 03:04:05.1234567", "٢٠٢٤-01-02", "9999-12-31 23:59:59.999999"]


def test_one_parse_gives_what_all_patterns_gave(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(FORMS)], "i int, t string")
    c = F.regexp_replace("t", D.WRITTEN_ZONE, "$1")
    each = F.coalesce(*[F.try_to_timestamp(F.concat(c, F.lit("+00:00")), F.lit(p + "XXX")) for p in D.DEFAULT_PATTERNS])
    old = D.add_micros(F.expr(D.EPOCH_NTZ), F.unix_micros(each))
    for r in df.select("t", old.alias("old"), D.parse_timestamp("t").alias("new")).collect():
        assert r.old == r.new, r.t
    zoned = {r.t: r.at for r in df.select("t", D.parse_timestamp("t", convert_zone=True).alias("at")).collect()}
    assert zoned["2024-01-02 03:04:05+05:30"] == dt.datetime(2024, 1, 1, 21, 34, 5) and zoned["2024-01-02 03:04:05 -0330"] == dt.datetime(2024, 1, 2, 6, 34, 5)
    assert zoned["2024-01-02T03:04:05Z"] == zoned["2024-01-02T03:04:05"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    named = df.limit(1).select(D.parse_timestamp(F.lit("02 Jan 2024"), ("dd MMM yyyy",)).alias("a"), D.parse_timestamp(F.lit("02/01/2024"), ("yyyy-MM-dd", "dd/MM/yyyy")).alias("b")).first()
    assert named["a"] == named["b"] == dt.datetime(2024, 1, 2)
    assert D.pattern_shape("yyyy-MM-dd'T'HH:mm:ss.SSSSSS") is not None and D.pattern_shape("d.M.yyyy") is None and D.pattern_shape("dd MMM yyyy") is None


def test_all_null_date_columns_of_any_type(spark):
    df = spark.createDataFrame([(1, None, None, "x", None)], "k int, due_date string, DATE_flag boolean, start_date string, note string")
    out = D.from_epoch_millis(df)
    assert dict(out.dtypes) == {"k": "int", "due_date": "timestamp_ntz", "DATE_flag": "timestamp_ntz", "start_date": "string", "note": "string"}


# ---- polygons and folders --------------------------------------------------------

def inside(x, y, rings):
    n = 0
    for r in rings:
        r = r if r[0] == r[-1] else [*r, r[0]]
        n += sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(r, r[1:]))
    return n % 2 == 1


def polygons():
    import math

    rng = random.Random(3)
    star = [[math.cos(t) * (1 + rng.random()), math.sin(t) * (1 + rng.random())] for t in [i * 2 * math.pi / 700 for i in range(700)]]
    hole = [[0.2 * math.cos(i * 0.1), 0.2 * math.sin(i * 0.1)] for i in range(63)]
    comb = [p for i in range(60) for p in ([5 + i * 0.1, 0.0], [5.02 + i * 0.1, 3.0], [5.06 + i * 0.1, 3.0], [5.08 + i * 0.1, 0.1])] + [[11.0, -1.0], [5.0, -1.0]]
    return [(1, [star, hole]), (2, [comb]), (3, [[[0.0, 0.0], [4.0, 0.0], [4.0, 4.0], [0.0, 4.0]]]), (4, [[[1.0, 1.0], [1.0, 1.0]]]), (5, []), (6, [[[3.0, 1.0], [9.0, 1.0]]])]


def test_bands_give_what_all_edges_give(spark):
    rng, polys = random.Random(4), polygons()
    points = [(i, round(rng.uniform(-2, 12), 3), round(rng.uniform(-2, 4.5), 3)) for i in range(1500)] + [(2000, 0.0, 0.0), (2001, 4.0, 4.0), (2002, 1.0, 1.0), (2003, None, 1.0), (2004, 1.0, float("nan"))]
    points += [(3000 + i, 0.5, 0.5) for i in range(50)] + [(4000 + i, None, None) for i in range(50)]
    p = spark.createDataFrame(points, "id int, x double, y double")
    shapes = spark.createDataFrame([(o, f"n{o}", r) for o, r in polys], "poly_order int, NAME string, rings array<array<array<double>>>")
    got = {r.id: r.NAME for r in SP.locate(p, shapes, ["NAME"], "x", "y").collect()}
    want = {i: next((f"n{o}" for o, r in polys if x is not None and y is not None and y == y and inside(x, y, [q for q in r if q])), None) for i, x, y in points}
    assert got == want and len(got) == len(points)


def test_a_polygon_of_many_vertices_tests_few_edges(spark):
    turn = lambda i: i.cast("double") * (2 * 3.141592653589793 / 100_000)
    ring = F.transform(F.sequence(F.lit(0), F.lit(100_000)), lambda i: F.array(F.cos(turn(i)), F.sin(turn(i))))
    shapes = SP.shapes(spark.range(1).select(F.lit(1).alias("poly_order"), F.lit("d").alias("NAME"), F.array(ring).alias("rings")), ["NAME"])
    bands = SP.band_edges(shapes).select(F.size("edges").alias("n")).collect()
    sizes = sorted(r.n for r in bands)
    assert sum(sizes) < 3 * 100_000 and sizes[len(sizes) // 2] < 100  # most bands; the flat top and bottom hold more
    p = spark.createDataFrame([(0.5, 0.5), (0.99, 0.3), (-0.999999, 0.0), (0.0, 1.0001)], "x double, y double")
    one = spark.range(1).select(F.lit(1).alias("poly_order"), F.lit("d").alias("NAME"), F.array(ring).alias("rings"))
    assert [r.NAME for r in SP.locate(p, one, ["NAME"], "x", "y").orderBy("x").collect()] == ["d", None, "d", None]


def test_missing_coordinates_spread(spark):
    p = spark.range(4000).select(F.col("id"), F.lit(None).cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    shapes = spark.createDataFrame([(1, "a", [[[0.0, 0.0], [1.0, 0.0], [1.0, 1.0]]])], "poly_order int, NAME string, rings array<array<array<double>>>")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for k, v in (("spark.sql.autoBroadcastJoinThreshold", "-1"), ("spark.sql.adaptive.enabled", "false")):
            spark.conf.set(k, v)
        out = SP.locate(p, shapes, ["NAME"], "x", "y")
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_folder_prefixes_against_plain_prefixes(spark):
    paths = ["/a/b/c", "/a/b/cd", "/a/bb", "a/b", "/a/b/", "", "//x", "/a", None]
    files = [(f"{n}{i}", f"f{n}", p) for n in range(2) for i, p in enumerate(paths)]
    prefixes = [None, "", "/", "/a", "/a/", "/a/b", "/a/b/", "/a/b/c", "/a/b/c/", "a", "a/b", "//", "/x", "/a/b/cd/e", "/A"]
    requests = [(f"{n}-{p}", f"f{n}", p) for n in range(3) for p in prefixes]
    got = {r.req_id: (r.n_matches, r.file_id) for r in L.resolve(spark.createDataFrame(requests, "req_id string, name string, path_prefix string"), spark.createDataFrame(files, "id string, name string, path string")).collect()}
    for rid, name, prefix in requests:
        ids = sorted(i for i, n, p in files if n == name and (prefix is None or (p is not None and p.startswith(prefix))))
        assert got[rid] == (len(ids), ids[0] if len(ids) == 1 else None), (rid, ids)
    assert len(got) == len(requests)


def test_begins_of_one_large_folder_meet_by_equality(spark):
    n = 2000
    files = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("f").alias("name"), F.concat(F.lit("/w/"), F.col("id").cast("string")).alias("path"))
    requests = spark.range(n).select(F.col("id").cast("string").alias("req_id"), F.lit("f").alias("name"), F.concat(F.lit("/w/"), F.col("id").cast("string")).alias("path_prefix"))
    out = L.resolve(requests, files)
    got = {r.req_id: r.n_matches for r in out.collect()}
    assert got == {str(i): sum(str(j).startswith(str(i)) for j in range(n)) for i in range(n)}
    assert "StartsWith" not in out._jdf.queryExecution().optimizedPlan().toString()  # no pair of a request and a part but the equal ones


# ---- command line -----------------------------------------------------------------

def test_command_line_jobs(spark, tmp_path):
    env = {"DEPT": "st", "SOURCE": "cli", "TABLES": "one,two"}
    for t in ("one", "two"):
        ref = TableRef("st", "cli", t)
        jobs.stage(spark.createDataFrame([(1, "2024-01-02", None), (2, "no", "b")], "id int, at string, note string"), ref)
    contract = [{"COLUMN_NAME": c, "DATA_TYPE": k} for c, k in (("id", "int"), ("at", "varchar"), ("note", "varchar"))]
    bad = [dict(c, DATA_TYPE="bigint") if c["COLUMN_NAME"] == "id" else c for c in contract]
    with pytest.raises(ValueError, match="no contract for two"):
        cli.validate({**env, "COL_SCHEMA": json.dumps({"one": contract})})
    cli.validate({**env, "COL_SCHEMA": json.dumps(contract)})
    cli.validate({**env, "COL_SCHEMA": json.dumps({"one": contract, "two": contract})})
    with pytest.raises(cli_error(), match="two: "):
        cli.validate({**env, "COL_SCHEMA_ONE": json.dumps(contract), "COL_SCHEMA_TWO": json.dumps(bad)})
    assert cli.main(["convert-datetime"], {**env, "COLS": "at"}) == 0
    assert dict(spark.table("staging.st_cli_one").dtypes)["at"] == "timestamp_ntz"
    assert cli.main(["load", "replace-generated"], {**env, "ID_COLS": "note", "GENERATED_ID": "id"}) == 0
    assert sorted(r.id for r in spark.table("master.st_cli_two").collect()) == [1, 2]
    copied = cli.copy({**env, "TARGET_DB": "state", "SUFFIX": "_c", "COLUMN_Q": "note,id"})
    assert sorted(copied) == [("st_cli_one", 2), ("st_cli_two", 2)] and spark.table("state.st_cli_one_c").columns == ["note", "id"]
    with pytest.raises(ValueError, match="no column nope"):
        cli.copy({**env, "TARGET_DB": "state", "COLUMN_Q": "nope"})
    out = cli.export({**env, "TARGET_PATH": str(tmp_path / "x")})
    assert FS.delimited(spark, out[0], sep=",", null_value="NA").count() == 2
    spark.createDataFrame([("B ST", 90.0, 5.0, 1.0)], "FULL_ADDRESS string, score double, longitude double, latitude double").write.saveAsTable("state.locator")
    geo = {**env, "TABLES": "one", "ID_COLS": "id", "LOCATOR": "state.locator", "ADDRESS": "CASE WHEN id = 1 THEN 'a st' ELSE 'b  st' END"}
    assert cli.geocode(geo)[0].startswith("overwrite") and cli.geocode(geo) == ["nothing to geocode"]
    assert {r.id: r.longitude for r in spark.table("master.st_cli_one_G").collect()} == {1: None, 2: 5.0}
    lost = cli.misses({**env, "TABLES": "one", "ID_COLS": "id", "COLS": "note", "TARGET_PATH": str(tmp_path / "m")})
    assert [r.FULL_ADDRESS for r in FS.delimited(spark, lost[0], sep=",", null_value="NA").collect()] == ["a st"]


def cli_error():
    from wareloom.operators.quality import ContractError

    return ContractError


def test_part_files_are_feature_collections(spark, tmp_path):
    df = spark.createDataFrame([(i, None if i == 3 else float(i), 1.0, 'q"') for i in range(7)], "k int, lon double, lat double, note string")
    for single in (False, True):
        X.geojson(df.repartition(3), str(tmp_path / str(single)), "lon", "lat", ["k", "note"], single)
        docs = [json.loads(p.read_text()) for p in (tmp_path / str(single)).glob("part-*")]
        assert all(d["type"] == "FeatureCollection" for d in docs) and (len(docs) == 1) == single
        assert sorted(f["properties"]["k"] for d in docs for f in d["features"]) == [0, 1, 2, 4, 5, 6]
