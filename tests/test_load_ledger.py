"""Loads that stop at any step, with another writer in between and NULL keys: nothing is lost or doubled."""

import pytest
from pyspark.sql import SparkSession

from wareloom import catalog, jobs, transactions
from wareloom.naming import TableRef
from wareloom.streaming import landing


class Stop(Exception):
    pass


def rows(spark, data, schema="k bigint, v string, p string"):
    return spark.createDataFrame(data, schema)


def content(spark, name):
    spark.catalog.refreshTable(name)
    return sorted(((r.k, r.v, r.p) for r in spark.table(name).collect()), key=str)


def stop_at(m, n):
    """Fails the n-th table change or file call of a load from now on, before or after it is done."""
    seen = [0]

    def counted(real, after):
        def call(*a, **b):
            seen[0] += 1
            if seen[0] == n and not after:
                raise Stop
            out = real(*a, **b)
            if seen[0] == n:
                raise Stop
            return out
        return call

    def sql(self, text, *a, **b):
        return (change if text.startswith(("ALTER TABLE", "DROP TABLE")) else real)(self, text, *a, **b)

    real = SparkSession.sql
    change = counted(real, n % 2)
    m.setattr(SparkSession, "sql", sql)
    for name in ("write", "move", "delete"):
        m.setattr(transactions.Files, name, counted(getattr(transactions.Files, name), n % 2))
    return seen


MASTER = [(1, "a", "x"), (2, "b", "x"), (None, "c", "y"), (3, "d", "z w")]
STAGED = [(2, "new", "x"), (None, "null", "y"), (4, "e", None), (None, "null", "y")]
OTHER = [(9, "other", "x"), (None, "other", "y")]
RUNS = {
    "append": (lambda s, r: jobs.run_append(s, r), None, MASTER + STAGED),
    "append to partitions": (lambda s, r: jobs.run_append(s, r), ["p"], MASTER + STAGED),
    "replace": (lambda s, r: jobs.run_replace(s, r, ["k"]), None, [x for x in MASTER if x[0] != 2] + STAGED),
    "replace partitions": (lambda s, r: jobs.run_replace_partitions(s, r, ["k", "p"], ["p"]), ["p"], [x for x in MASTER if x[0] != 2] + STAGED),
}


@pytest.mark.parametrize("name", sorted(RUNS))
def test_a_second_writer_between_a_stop_and_the_rerun(spark, name):
    run, by, want = RUNS[name]
    ref = TableRef("led", "t", "".join(c for c in name if c.isalpha()))
    for db in ("staging", "master"):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    master, n, before = ref.at("master").qualified, 0, None
    while True:
        n += 1
        for t in (ref.qualified, master):
            catalog.exists(spark, t)
            catalog.drop(spark, t)
        catalog.publish(rows(spark, MASTER), master, partition_by=by)
        jobs.stage(rows(spark, STAGED), ref)
        stopped = False
        with pytest.MonkeyPatch.context() as m:
            stop_at(m, n)
            try:
                run(spark, ref)
            except Stop:
                stopped = True
        if spark.catalog.tableExists(master):  # another writer adds rows, unless the swap has the table in hand
            added = OTHER
            rows(spark, OTHER).select(*spark.table(master).columns).write.mode("append").insertInto(master)
        else:
            added = []
        run(spark, ref)
        assert content(spark, master) == sorted(want + added, key=str), (name, n)
        assert not catalog.exists(spark, ref.qualified)
        left = catalog._properties(spark, master)
        assert transactions.undecided(spark, catalog._location(spark, master)) == []
        if not stopped:
            assert not [k for k in left if k.startswith(jobs.LOADED)]
            break
    assert n > 5


def test_a_new_staging_version_is_a_new_batch(spark):
    ref = TableRef("led", "t", "again")
    for _ in range(2):
        jobs.stage(rows(spark, STAGED), ref)
        jobs.run_append(spark, ref)
    assert len(content(spark, ref.at("master").qualified)) == 2 * len(STAGED)
    # staging written by another tool has no batch id: it gets one when the load begins
    rows(spark, STAGED).write.saveAsTable(ref.qualified)
    jobs.run_append(spark, ref)
    assert len(content(spark, ref.at("master").qualified)) == 3 * len(STAGED)


def test_a_master_changed_while_it_is_replaced_is_not_overwritten(spark, monkeypatch):
    ref = TableRef("led", "t", "race")
    master = ref.at("master").qualified
    catalog.publish(rows(spark, MASTER), master)
    jobs.stage(rows(spark, STAGED), ref)
    real = catalog.set_property

    def meanwhile(s, table, key, value):
        if table.endswith("__new"):
            monkeypatch.undo()
            rows(spark, OTHER).write.mode("append").insertInto(master)
        real(s, table, key, value)

    monkeypatch.setattr(catalog, "set_property", meanwhile)
    with pytest.raises(transactions.ChangedMeanwhile):
        jobs.run_replace(spark, ref, ["k"])
    assert content(spark, master) == sorted(MASTER + OTHER, key=str)
    jobs.run_replace(spark, ref, ["k"])  # staging is still there
    assert content(spark, master) == sorted([x for x in MASTER + OTHER if x[0] != 2] + STAGED, key=str)


def test_a_replaced_file_refuses_the_partition_commit(spark):
    ref = TableRef("led", "t", "gone")
    master = ref.at("master").qualified
    catalog.publish(rows(spark, MASTER), master, partition_by=["p"])
    with pytest.raises(transactions.ChangedMeanwhile):
        catalog.change_files(rows(spark, OTHER), master, removed=["p=x/was-here.parquet"])
    assert content(spark, master) == sorted(MASTER, key=str)
    assert not [n for n, _ in transactions.Files(spark, catalog._location(spark, master)).children() if n.startswith(transactions.PREFIX)]


def test_only_the_files_of_touched_partitions_change(spark):
    ref = TableRef("led", "t", "touched")
    master = ref.at("master").qualified
    catalog.publish(rows(spark, MASTER), master, partition_by=["p"])
    before = catalog.data_files(spark, master)
    jobs.stage(rows(spark, [(2, "new", "x"), (5, "n", "z w")]), ref)
    assert jobs.run_replace_partitions(spark, ref, ["k", "p"], ["p"])["status"].startswith("replaced 2")
    kept = before & catalog.data_files(spark, master)
    assert kept == {f for f in before if "p=y" in f}
    assert content(spark, master) == sorted([(1, "a", "x"), (2, "new", "x"), (None, "c", "y"), (3, "d", "z w"), (5, "n", "z w")], key=str)


@pytest.mark.parametrize("mode", ["replace", "append_new"])
def test_an_epoch_is_applied_once(spark, tmp_path, mode):
    spark.sql("CREATE DATABASE IF NOT EXISTS led")
    table = f"led.stream_{mode}"
    catalog.publish(rows(spark, MASTER), table)
    schema = spark.table(table).schema
    rows(spark, [(None, "null", "q"), (7, "s", "q")]).write.parquet(f"{tmp_path}/in/one")
    real = landing.apply_batch

    def failing(*a, **b):
        run = real(*a, **b)

        def then_stop(batch, epoch):
            run(batch, epoch)
            raise RuntimeError("stopped after the publish")
        return then_stop

    with pytest.MonkeyPatch.context() as m:
        m.setattr(landing, "apply_batch", failing)
        with pytest.raises(Exception, match="stopped after"):
            landing.load_landing(spark, f"{tmp_path}/in/*", schema, table, ["k"], f"{tmp_path}/ckpt", mode).awaitTermination()
    landing.load_landing(spark, f"{tmp_path}/in/*", schema, table, ["k"], f"{tmp_path}/ckpt", mode).awaitTermination()
    added = [(None, "null", "q"), (7, "s", "q")] if mode == "replace" else [(7, "s", "q")]
    assert content(spark, table) == sorted(MASTER + added, key=str)


def test_a_backlog_is_published_once(spark, tmp_path):
    table = "led.backlog"
    spark.sql("CREATE DATABASE IF NOT EXISTS led")
    catalog.publish(rows(spark, MASTER), table)
    schema = spark.table(table).schema
    rows(spark, [(None, "null", "q")]).write.parquet(f"{tmp_path}/in/one")
    call = lambda: landing.load_backlog(spark, f"{tmp_path}/in/*", schema, table, ["k"], f"{tmp_path}/ckpt")
    with pytest.MonkeyPatch.context() as m:
        m.setattr(landing, "remove_scratch", lambda *a: (_ for _ in ()).throw(Stop()))
        with pytest.raises(Stop):
            call()
    assert call().startswith("already published")
    assert content(spark, table) == sorted([*MASTER, (None, "null", "q")], key=str)
