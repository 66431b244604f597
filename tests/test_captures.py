"""Captured pages: plans, waves that break, chains, zones."""

import json
import sys

import pytest
from pyspark.sql import functions as F

from wareloom import catalog
from wareloom.sources import captures as CP

SCHEMA = "k bigint, g string, v double"


class Service:
    """Records 0 .. n - 1, answering at most 7 at a time; chains of pages of 3 by loop value."""

    def __init__(self, opts):
        self.n, self.loop = int(opts.get("n", 20)), json.loads(opts.get("extra_params", "{}")).get("kind")

    def rec(self, k):
        return {"k": k, "g": self.loop or f"g{k % 3}", "v": None if k % 5 == 0 else k / 2}

    def count(self):
        return self.n if self.loop != "none" else 0

    def fetch(self, offset, limit):
        return [self.rec(k) for k in range(offset, min(self.n, offset + min(limit, 7)))]

    def follow(self, link):
        chain, at = link.split(":")
        at = int(at)
        recs = [{"k": k, "g": chain, "v": 1.0} for k in range(at, min(at + 3, len(chain) * 4))]
        if chain == "loop":
            return recs, "loop:0"
        return recs, f"{chain}:{at + 3}" if at + 3 < len(chain) * 4 else None


@pytest.fixture(scope="module")
def service(spark, tmp_path_factory):
    """The service as a module that tasks can import."""
    import inspect

    path = tmp_path_factory.mktemp("svc") / "page_service.py"
    path.write_text("import json\n\n\n" + inspect.getsource(Service))
    spark.sparkContext.addPyFile(str(path))
    sys.path.insert(0, str(path.parent))
    spark.sql("CREATE DATABASE IF NOT EXISTS cap")
    return "page_service:Service"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_a_broken_capture_goes_on(spark, service):
    t, opts = "cap.broken", dict(page_size=4, wave=2, transport=service, n=23)
    real, calls = catalog.publish, [0]

    def third_fails(*a, **b):
        calls[0] += 1
        if calls[0] == 4:
            raise RuntimeError("stopped")
        return real(*a, **b)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(catalog, "publish", third_fails)
        with pytest.raises(RuntimeError, match="stopped"):
            CP.capture(spark, t, SCHEMA, ["k", "v"], **opts)
    held = spark.table(t).count()
    assert 0 < held < 6
    opts["n"] = 999  # the count of the begun capture holds
    assert CP.capture(spark, t, SCHEMA, ["k", "v"], **opts) == 3 - held // 2
    assert rows(CP.read(spark, t, SCHEMA)) == sorted([(k, f"g{k % 3}", None if k % 5 == 0 else k / 2) for k in range(23)], key=str)
    assert CP.capture(spark, t, SCHEMA, ["k", "v"], **opts) == 0


def test_loop_values(spark, service):
    t = "cap.loops"
    CP.capture(spark, t, SCHEMA, ["k"], page_size=8, loop_values=["a", "b's", "none"], loop_param="kind", transport=service, n=10)
    got = CP.read(spark, t, SCHEMA, [("k", ">=", 8)], ["a", "none"], loop_column="asked")
    assert rows(got) == sorted([(8, "a", 4.0, "a"), (9, "a", 4.5, "a")], key=str)
    assert CP.read(spark, t, SCHEMA).count() == 20 and CP.read(spark, t, SCHEMA, loops=[]).count() == 0


def test_a_missing_record_is_an_error(spark, service):
    with pytest.raises(Exception, match="were planned"):
        catalog.publish(CP.zoned(CP.local_rows(spark, [], CP.PAGE), SCHEMA, []), "cap.short")
        catalog.set_property(spark, "cap.short", f"{CP.COUNT}.", "30")
        CP.capture(spark, "cap.short", SCHEMA, page_size=8, transport=service, n=10)
    assert spark.table("cap.short").count() == 0


def test_chains_resume_half_way(spark, service):
    t, starts = "cap.chains", {"abc": "abc:0", "abcdefg": "abcdefg:0", "": None, "x": "x:0"}
    CP.create(spark, t, SCHEMA, ["k"])
    ship = CP._options({"transport": service})
    todo = CP.open_chains(spark, t, starts)
    CP.add(todo.mapInPandas(CP._walk(ship, 2), CP.PAGE), t, SCHEMA, ["k"])  # a first wave, then the run stops
    assert {r.chain: r.page for r in CP.open_chains(spark, t, starts).collect()} == {"abc": 2, "abcdefg": 2}
    assert CP.incomplete(spark, t).count() == 2
    assert CP.follow(spark, t, SCHEMA, starts, ["k"], pages=2, transport=service) == 4
    want = [(k, c, 1.0) for c in ("abc", "abcdefg", "x") for k in range(len(c) * 4)]
    assert rows(CP.read(spark, t, SCHEMA)) == sorted(want, key=str) and CP.incomplete(spark, t).isEmpty()
    assert CP.follow(spark, t, SCHEMA, starts, ["k"], transport=service) == 0
    with pytest.raises(RuntimeError, match="comes back"):
        CP.follow(spark, "cap.round", SCHEMA, {"loop": "loop:0"}, transport=service, pages=1)


def test_a_stream_reads_the_growing_capture(spark, service, tmp_path):
    t = "cap.chains_stream"
    CP.follow(spark, t, SCHEMA, {"ab": "ab:0"}, pages=2, transport=service)
    spark.sql("CREATE DATABASE IF NOT EXISTS cap_out")

    def run():
        pages = spark.readStream.schema(spark.table(t).schema).parquet(catalog._location(spark, t))
        recs = pages.select(F.explode(CP.parsed(F.col("body"), SCHEMA)).alias("r")).select("r.*")
        recs.writeStream.option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).toTable("cap_out.recs").awaitTermination()
        spark.catalog.refreshTable("cap_out.recs")
        return spark.table("cap_out.recs").count()

    assert run() == 8
    CP.follow(spark, t, SCHEMA, {"ab": "ab:0", "abc": "abc:0"}, pages=2, transport=service)
    assert run() == 20 and run() == 20


FILTERS = [[("k", ">", 900)], [("k", "<=", 120), ("k", ">", 100)], [("v", "=", 33.5)], [("g", "in", ["g1", "zz"]), ("k", "<", 50)], [("g", "in", [])], [("v", ">=", 499.5)], [("v", "<", 1.0)]]


@pytest.mark.parametrize("filters", FILTERS, ids=str)
def test_zones_prune_and_keep_every_row(spark, filters):
    t = "cap.zones"
    df = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("g"), (F.col("id") % 3).cast("string")).alias("g"), F.expr("CASE WHEN id % 5 <> 0 THEN id / 2 END").alias("v"))
    if not catalog.exists(spark, t):
        CP.add(CP.pages_of(df, "k", 40), t, SCHEMA, ["k", "v", "g"])
    want = df
    for c, op, v in filters:
        want = want.where(CP.COMPARE[op](F.col(c), v))
    assert rows(CP.read(spark, t, SCHEMA, filters)) == rows(want)
    held, all_ = CP.pages(spark, t, filters).count(), spark.table(t).count()
    assert all_ == 25 and held < (25 if filters != FILTERS[3] else 3)
    if filters[0][1] == ">":
        assert "GreaterThan(max_k" in CP.read(spark, t, SCHEMA, filters)._jdf.queryExecution().executedPlan().toString()


def test_pages_of_a_hot_group_and_null_groups(spark):
    df = spark.createDataFrame([(i, None if i % 7 == 0 else "hot", float(i)) for i in range(100)], SCHEMA)
    pages = CP.pages_of(df, "k", 9, chain_col="g")
    got = pages.select("chain", "page", "rows", "link", "next").collect()
    assert max(r["rows"] for r in got) == 9 and sum(r["rows"] for r in got) == 100
    assert sum(r["next"] is None for r in got) == 2


def test_no_task_places_a_whole_group(spark):
    """The rows' positions become pages without a shuffle by the group alone."""
    rows_of = lambda n: spark.range(n).select(F.col("id").alias("k"), F.when(F.col("id") % 9 > 0, "hot").alias("g"), F.col("id").cast("double").alias("v"))
    alone = CP.pages_of(rows_of(50), "k", 9)
    assert "Join" not in alone._jdf.queryExecution().optimizedPlan().toString().replace("Join Inner, (__pid", "")
    pages = CP.pages_of(rows_of(5000), "k", 9, loop_col="g")  # several blocks of positions
    assert "block" in pages._jdf.queryExecution().optimizedPlan().toString()
    want = {(None, p): min(9, 556 - 9 * p) for p in range(62)} | {("hot", p): min(9, 4444 - 9 * p) for p in range(494)}
    assert {(r["loop"], r["page"]): r["rows"] for r in pages.collect()} == want
