"""One publish per backlog: latest batch of a key wins, restarts lose nothing."""

import os

import pytest

from wareloom import catalog
from wareloom.streaming import landing as LS


def drop(spark, folder, n, rows):
    """The n-th file to land."""
    spark.createDataFrame(rows, "k bigint, v string").coalesce(1).write.parquet(f"{folder}/d{n}")
    for name in os.listdir(f"{folder}/d{n}"):
        os.utime(f"{folder}/d{n}/{name}", (1_700_000_000 + n, 1_700_000_000 + n))


def test_backlog_is_published_once(spark, tmp_path, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS backlog")
    folder, table, checkpoint = f"{tmp_path}/in", "backlog.t", f"{tmp_path}/ckpt"
    catalog.publish(spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k bigint, v string"), table)
    schema = spark.table(table).schema
    drop(spark, folder, 1, [(1, "x"), (2, "x"), (None, "n1")])
    drop(spark, folder, 2, [(2, "y"), (2, "z"), (None, "n2")])
    published, real = [], catalog.publish
    monkeypatch.setattr(catalog, "publish", lambda *a, **k: (published.append(a[1]), real(*a, **k)))

    def run():
        return LS.load_backlog(spark, f"{folder}/*", schema, table, ["k"], checkpoint, max_files_per_trigger=1)

    with monkeypatch.context() as m:  # stops before the publish
        m.setattr(LS.load, "replace", lambda *a: (_ for _ in ()).throw(RuntimeError("stop")))
        with pytest.raises(RuntimeError):
            run()
    assert published == []
    assert run() == f"published {table}" and published == [table]
    want = [(1, "x"), (2, "y"), (2, "z"), (3, "c"), (None, "n1"), (None, "n2")]
    assert sorted(map(tuple, spark.table(table).collect()), key=str) == sorted(want, key=str)
    assert run() == "nothing landed" and published == [table]
