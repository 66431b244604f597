"""Publish swap, warehouse jobs, paged sources, listing, workbooks, exports."""

import io
import zipfile

import folder_pages as FP
import pytest
from pyspark.sql import functions as F

from wareloom import catalog, jobs
from wareloom.naming import TableRef, target_name
from wareloom.operators import listing as L
from wareloom.sources import paged as P
from wareloom.sources import workbooks as WB


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    """The test service, for the tasks."""
    spark.sparkContext.addPyFile(FP.__file__)


def test_publish_swap_and_recover(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS t_master")
    t = "t_master.swap"
    catalog.publish(spark.range(5), t)
    # new version may read the old one (write-new, then rename)
    catalog.publish(spark.table(t).withColumn("id", F.col("id") + 10), t)
    assert sorted(r[0] for r in spark.table(t).collect()) == [10, 11, 12, 13, 14]
    # an interrupted swap (old renamed away, new written) is finished on the next publish
    spark.sql(f"ALTER TABLE {t} RENAME TO t_master.swap__old")
    spark.range(3).write.saveAsTable("t_master.swap__new")
    catalog.recover(spark, t)
    assert spark.table(t).count() == 3 and not catalog.exists(spark, "t_master.swap__old")


def test_run_replace_report_and_staging_drop(spark):
    ref = TableRef("dept", "src", "orders")
    for db in ("staging", "master"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    catalog.publish(spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"), ref.at("master").qualified)
    jobs.stage(spark.createDataFrame([(2, "B"), (3, "C")], "k bigint, v string"), ref)
    rep = jobs.run_replace(spark, ref, ["k"])
    assert (rep["deleted"], rep["inserted"], rep["delta"]) == (1, 2, 1)
    assert not catalog.exists(spark, ref.at("staging").qualified)
    assert sorted(map(tuple, spark.table(ref.at("master").qualified).collect())) == [(1, "a"), (2, "B"), (3, "C")]
    assert jobs.run_replace(spark, ref, ["k"])["status"].startswith("skipped")


def test_run_append_moves_when_master_missing(spark):
    ref = TableRef("d2", "s2", "t2")
    for db in ("staging", "master"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    jobs.stage(spark.createDataFrame([(1,)], "k bigint"), ref)
    assert jobs.run_append(spark, ref).startswith("moved")
    jobs.stage(spark.createDataFrame([(2,)], "k bigint"), ref)
    assert jobs.run_append(spark, ref).startswith("appended")
    assert spark.table(ref.at("master").qualified).count() == 2


def test_target_names():
    assert target_name("db.host.org._ORDERS_V", suffix="_copy") == "ORDERS_copy"
    assert TableRef("a", "b", "c").qualified == "staging.a_b_c"


@pytest.mark.parametrize("size", [1, 999, 1000])
def test_offset_pages_reunite(spark, tmp_path, size):
    d = spark.range(0, 2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    path = str(tmp_path / f"p{size}")
    n = FP.write_offset_pages(d, path, "k", size)
    back = P.read(spark, "k bigint, v bigint", transport=FP.NAME, location=path, page_size=size, count=n,
                  pages_per_partition=3)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, d.collect()))


def test_empty_service_and_cursor_chains(spark, tmp_path):
    empty = P.read(spark, "k bigint", transport=FP.NAME, location=str(tmp_path), count=0)
    assert empty.count() == 0
    d = spark.range(0, 50).select(F.col("id").alias("k"), (F.col("id") % 3).alias("chain"))
    starts = FP.write_cursor_pages(d, str(tmp_path / "c"), "chain", "k", 7)
    back = P.read(spark, "k bigint, chain bigint", transport=FP.NAME, location=str(tmp_path / "c"),
                  paging="cursor", starts=starts)
    assert sorted(r[0] for r in back.collect()) == list(range(50))


def test_listing_statuses(spark):
    files = spark.createDataFrame(
        [("1", "a.txt", "/x", "2024-01-01"), ("2", "a.txt", "/y", "2024-01-02"), ("3", "b.csv", "/x", "2024-01-03"),
         ("4", "ab.txt", "/x", "2024-01-04")], "id string, name string, path string, created string"
    ).withColumn("created", F.col("created").cast("timestamp_ntz"))
    req = spark.createDataFrame([("r1", "a.txt", "/x"), ("r2", "a.txt", None), ("r3", "zz", None)],
                                "req_id string, name string, path_prefix string")
    got = {r["req_id"]: (r["status"], r["file_id"]) for r in L.resolve(req, files).collect()}
    assert got == {"r1": ("ok", "1"), "r2": ("ambiguous", None), "r3": ("missing", None)}
    lr = spark.createDataFrame([("q", "a", 2), ("s", "b", 5)], "req_id string, pattern string, top int")
    latest = [(r["req_id"], r["id"]) for r in L.latest(lr, files).orderBy("req_id", "rank").collect()]
    assert latest == [("q", "4"), ("q", "2"), ("s", "4"), ("s", "3")]
    exp = spark.createDataFrame([("e1", "b", "/x", [".csv"]), ("e2", "a", None, None), ("e3", "b", "/x", [".xls"])],
                                "exp_id string, file_name string, folder_path string, file_types array<string>")
    st = {r["exp_id"]: r["status"] for r in L.arrival_status(exp, files).collect()}
    assert st == {"e1": "ready", "e2": "ambiguous", "e3": "waiting"}


def test_parse_xlsx_shared_strings():
    buf = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns} xmlns:r="http://schemas.openxmlformats.org/officeDocument/'
                                      '2006/relationships"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets>'
                                      '</workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f'<sst {ns}><si><t>name</t></si><si><r><t>Jo</t></r><r><t>e</t></r></si></sst>')
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c>'
                                               '</row><row r="2"><c r="A2" t="s"><v>1</v></c><c r="C2" t="b"><v>1</v>'
                                               '</c></row></sheetData></worksheet>')
    cells = list(WB.parse_xlsx(buf.getvalue()))
    assert cells == [(0, "S", 1, 1, "name"), (0, "S", 2, 1, "Joe"), (0, "S", 2, 3, "TRUE")]


def test_typed_pages_push_filters(spark, tmp_path):
    d = spark.range(0, 3000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("g"))
    path = str(tmp_path / "typed")
    n = FP.write_offset_pages(d, path, "k", 500)
    typed = P.read_typed(spark, "k bigint, g string", transport=FP.NAME, location=path, page_size=500, count=n)
    got = typed.where((F.col("k") >= 100) & (F.col("g").isin("1", "2")) & F.col("g").isNotNull())
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan  # every predicate was taken by the source
    expect = d.where((F.col("k") >= 100) & (F.col("g").isin("1", "2")))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, expect.collect()))


def test_soql_translation():
    from pyspark.sql import datasource as ds

    w = P.soql_where([ds.EqualTo(("event_type",), "click"), ds.GreaterThan(("value",), 10.5),
                      ds.Not(ds.IsNull(("ts",)))])
    assert w == "(event_type = 'click') AND (value > 10.5) AND (NOT (ts IS NULL))"


def test_resolve_by_explicit_id(spark):
    files = spark.createDataFrame([("1", "a.txt", "/x"), ("2", "a.txt", "/y")], "id string, name string, path string")
    req = spark.createDataFrame([("r1", "a.txt", None, None), ("r2", "a.txt", None, "2"), ("r3", "a.txt", None, "9")],
                                "req_id string, name string, path_prefix string, file_id string")
    got = {r["req_id"]: (r["status"], r["file_id"]) for r in L.resolve(req, files).collect()}
    assert got == {"r1": ("ambiguous", None), "r2": ("ok", "2"), "r3": ("missing", None)}
