"""Stored marks: ties, late ids, zones, stops, batches that are never loaded."""

import datetime as dt
import decimal

import pytest

from wareloom import catalog, jobs
from wareloom.naming import TableRef
from wareloom.operators import incremental, marks

TABLE = "master.wl_marks"


@pytest.fixture
def ref(spark, request):
    for db in ("staging", "master"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    return TableRef("mrk", "t", "x" + str(abs(hash(request.node.nodeid)) % 10**8))


def frame(spark, rows, kind="bigint"):
    return spark.createDataFrame(rows, f"id bigint, at {kind}")


def pulled(spark, ref):
    spark.catalog.refreshTable(ref.qualified)
    return sorted(r.id for r in spark.table(ref.qualified).collect())


def pull(spark, ref, rows, kind="bigint", load=True):
    marks.pull(frame(spark, rows, kind), ref, "at", "id", TABLE)
    got = pulled(spark, ref)
    if load:
        jobs.run_append(spark, ref)
    return got


D = decimal.Decimal
VALUES = {
    "bigint": [2**53, 2**53 + 1, 2**53 + 2], "double": [0.1, 0.2, 0.30000000000000004], "string": ["a", "b's", "c"], "date": [dt.date(2024, 1, d) for d in (1, 2, 3)],
    "decimal(38,10)": [D("1.0000000001"), D("1.0000000002"), D("12345678901234567890.5")], "timestamp_ntz": [dt.datetime(2024, 3, 10, 2, 30, 0, x) for x in (1, 2, 3)],
    "timestamp": [dt.datetime(2024, 11, 3, 5, 30, 0, x) for x in (1, 2, 3)],
}


@pytest.mark.parametrize("kind", sorted(VALUES))
def test_ties_come_once_and_late_ones_too(spark, ref, kind):
    a, b, c = VALUES[kind]
    assert pull(spark, ref, [(1, a), (2, b)], kind) == [1, 2]
    assert pull(spark, ref, [(1, a), (2, b)], kind) == []
    assert pull(spark, ref, [(1, a), (2, b), (3, b), (4, c), (5, a)], kind) == [3, 4]  # 3 came late at the mark
    assert pull(spark, ref, [(2, b), (4, c), (6, c), (7, c), (8, b)], kind) == [6, 7]
    assert pull(spark, ref, [(4, c), (6, c), (7, c), (9, c)], kind) == [9]
    assert sorted(r.id for r in spark.table(ref.at("master").qualified).collect()) == [1, 2, 3, 4, 6, 7, 9]


def test_a_batch_that_is_not_loaded_is_pulled_again(spark, ref):
    assert pull(spark, ref, [(1, 10)]) == [1]
    assert pull(spark, ref, [(1, 10), (2, 11)], load=False) == [2]
    assert pull(spark, ref, [(1, 10), (2, 11), (3, 12)], load=False) == [2, 3]
    catalog.drop(spark, ref.qualified)  # staging thrown away
    assert pull(spark, ref, [(1, 10), (2, 11), (3, 12)]) == [2, 3]
    assert pull(spark, ref, [(3, 12)]) == []


def test_a_stop_between_pull_and_load(spark, ref):
    assert pull(spark, ref, [(1, 10)]) == [1]

    class Stop(Exception):
        pass

    with pytest.MonkeyPatch.context() as m:  # the mark is noted, the batch never staged
        m.setattr(catalog, "_relocate", lambda *a: (_ for _ in ()).throw(Stop()))
        m.setattr(marks, "_replace", lambda *a, real=marks._replace: (real(*a), (_ for _ in ()).throw(Stop()))[0])
        with pytest.raises(Stop):
            marks.pull(frame(spark, [(1, 10), (2, 11)]), ref, "at", "id", TABLE)
    assert pull(spark, ref, [(1, 10), (2, 11)]) == [2]
    marks.pull(frame(spark, [(2, 11), (3, 12)]), ref, "at", "id", TABLE)
    with pytest.MonkeyPatch.context() as m:  # loaded, but staging not dropped
        m.setattr(jobs, "_done", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            jobs.run_append(spark, ref)
    assert pull(spark, ref, [(2, 11), (3, 12), (4, 13)]) == [4]
    assert sorted(r.id for r in spark.table(ref.at("master").qualified).collect()) == [1, 2, 3, 4]


def test_other_loads_leave_the_mark_alone(spark, ref):
    assert pull(spark, ref, [(1, 10)]) == [1]
    jobs.stage(frame(spark, [(50, 99)]), ref)  # not pulled
    jobs.run_replace(spark, ref, ["id"])
    assert pull(spark, ref, [(1, 10), (2, 11)]) == [2]


def test_null_ids_values_and_empty_sources(spark, ref):
    assert pull(spark, ref, []) == []
    assert pull(spark, ref, [(1, None)]) == [1]  # no mark yet: everything
    assert pull(spark, ref, [(1, None), (2, 5)]) == [1, 2]
    marks.pull(frame(spark, [(None, 5), (2, 5), (3, None)]), ref, "at", "id", TABLE)
    assert [r.id for r in spark.table(ref.qualified).collect()] == [None]  # an id that is not there was never seen
    with pytest.raises(ValueError, match="no stored mark"):
        marks._kind(spark.range(1).selectExpr("array(id) a").schema["a"].dataType)


@pytest.mark.parametrize("stored", [True, False])
def test_the_repeated_hour(spark, ref, stored):
    """01:30 happens twice in New York on 2024-11-03."""
    was = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        micros = [1730611800000000 + i * 900_000_000 for i in range(5)]  # 05:30 UTC = 01:30 EDT, then every 15 minutes
        src = spark.createDataFrame(list(enumerate(micros, 1)), "id bigint, m bigint").selectExpr("id", "timestamp_micros(m) as at")
        if stored:
            marks.pull(src.where("id <= 3"), ref, "at", "id", TABLE)
            jobs.run_append(spark, ref)
            marks.pull(src, ref, "at", "id", TABLE)
            assert pulled(spark, ref) == [4, 5]
        else:
            assert sorted(r.id for r in incremental.pull(src, src.where("id <= 3"), "at").collect()) == [4, 5]
    finally:
        spark.conf.set("spark.sql.session.timeZone", was)


def test_the_mark_reaches_the_scan(spark, ref, tmp_path):
    pull(spark, ref, [(1, 10), (2, 11)])
    frame(spark, [(i, i) for i in range(100)]).write.parquet(str(tmp_path / "s"))
    mark = marks.stored(spark, TABLE, f"{ref.at('master').qualified}.at".lower(), ref.at("master").qualified)
    plan = marks.beyond(spark.read.parquet(str(tmp_path / "s")), "at", "id", mark)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(at,11)" in plan and "EqualTo(at,11)" in plan
