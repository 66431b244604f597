"""Warehouse jobs with effects: stage, load staging into master, copy tables.

Each job is the pure operator from ``wareloom.operators.load`` plus
``catalog.publish``.  Many tables are run by ``for_each_table``; Spark runs
their jobs side by side when ``parallel > 1`` (driver threads only submit
lazily planned jobs; the data work stays on the executors).

The load ledger: every staging version has a batch id, a property of the staging
table.  A load notes it on the target in the same step in which its rows become
visible (the swap's new version, or the commit of a file change), and a rerun asks
the target first.  So a load that stopped anywhere is done once, whatever other
writers did to the target in between; the note goes when staging is gone.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom import catalog
from wareloom.naming import TableRef
from wareloom.operators import load


def for_each_table(tables: list[str], step: Callable[[str], object], parallel: int = 1) -> dict[str, object]:
    if parallel <= 1:
        return {t: step(t) for t in tables}
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip(tables, pool.map(step, tables)))


BATCH, LOADED, PULLED = "wareloom.batch", "wareloom.loaded", "wareloom.pulled"


def stage(df: DataFrame, ref: TableRef, pulled: str | None = None, before_swap=None, batch: str | None = None) -> str:
    """Overwrite the staging table of ``ref`` with a new batch.

    ``pulled`` names the stored mark that the batch was pulled by (see ``wareloom.operators.marks``)."""
    import uuid

    target = ref.at("staging").qualified
    marks = {BATCH: batch or uuid.uuid4().hex, PULLED: pulled or ""}
    catalog.publish(df, target, "overwrite", marks=marks, before_swap=before_swap)
    return target


def _ledger(spark: SparkSession, staging: str) -> tuple[str, dict[str, str]]:
    """The batch id of a staging version (given now when it has none) and the marks that its load leaves on the target."""
    import uuid

    noted = catalog._properties(spark, staging)
    if not noted.get(BATCH):
        noted[BATCH] = uuid.uuid4().hex
        catalog.set_property(spark, staging, BATCH, noted[BATCH])
    marks = {f"{LOADED}.{noted[BATCH]}": "true"}
    if noted.get(PULLED):
        marks[f"{PULLED}.{noted[PULLED]}"] = noted[BATCH]
    return noted[BATCH], marks


def _done(spark: SparkSession, src: str, dst: str, batch: str) -> None:
    """Staging goes, and then the note of its batch."""
    catalog.drop(spark, src)
    catalog.unset_property(spark, dst, f"{LOADED}.{batch}")


def _load(spark: SparkSession, ref: TableRef, target_layer: str, apply, partition_by: list[str] | None = None, first=None) -> dict:
    """Load staging into the target once: ``apply(staging, dst, batch, marks)`` publishes and returns its report.

    A missing target takes the staging rows as they are (or ``first(staging)``)."""
    src, dst = ref.at("staging").qualified, ref.at(target_layer).qualified
    if not catalog.exists(spark, src):
        return {"status": f"skipped: {src} does not exist"}
    batch, marks = _ledger(spark, src)
    if not catalog.exists(spark, dst):
        staging = spark.table(src)
        catalog.publish(first(staging) if first else staging, dst, "overwrite", partition_by, marks)
        report = {"status": f"moved {src} to {dst}"}
    elif f"{LOADED}.{batch}" in catalog._properties(spark, dst):
        report = {"status": f"already loaded into {dst}"}
    else:
        report = apply(spark.table(src), dst, batch, marks)
    _done(spark, src, dst, batch)
    return report


def read_table(spark: SparkSession, ref: TableRef, columns: list[str] | None = None) -> DataFrame:
    """A warehouse table, or the listed columns of it in their order; a column it lacks is named in the error."""
    table = spark.table(ref.qualified)
    missing = [c for c in columns or [] if c not in table.columns]
    if missing:
        raise ValueError(f"{ref.qualified} has no column {', '.join(missing)}")
    return table.select(*[F.col(f"`{c}`") for c in columns]) if columns else table


def run_overwrite(spark: SparkSession, ref: TableRef, target_layer: str = "master", id_cols=None,
                  require_new_ids: bool = False) -> str:
    """Staging replaces the target; skipped (with a message) when staging is missing."""
    def apply(staging, dst, batch, marks):
        new = load.overwrite(spark.table(dst), staging, id_cols, require_new_ids)
        catalog.publish(new, dst, "overwrite", marks=marks)
        return {"status": f"overwrote {dst}"}

    return _load(spark, ref, target_layer, apply)["status"]


def run_append(spark: SparkSession, ref: TableRef, target_layer: str = "master", exclude: list[str] | None = None,
               id_cols=None, require_new_ids: bool = False) -> str:
    """Append staging to the target, then drop staging.

    Only the staging rows are written, as new files that join the target as one
    whole together with the batch's note; the master's files are not rewritten."""
    def apply(staging, dst, batch, marks):
        master = spark.table(dst)
        if require_new_ids:
            load.require_new_ids(staging, master, id_cols)
        catalog.publish(load.align_by_name(master, staging, exclude), dst, "append", marks=marks, batch=batch)
        return {"status": f"appended to {dst}"}

    return _load(spark, ref, target_layer, apply)["status"]


def run_replace(spark: SparkSession, ref: TableRef, keys: list[str], target_layer: str = "master",
                require_new_ids: bool = False, collation: str | None = None) -> dict:
    """Replace by key, publish one new version, drop staging, return the report.

    The report counts come from ``observe`` metrics of the publishing job
    itself (no extra pass over the data).  The swap is refused (and nothing lost) when
    another writer changed the master while the new version was written.
    """
    def apply(staging, dst, batch, marks):
        from pyspark.sql import Observation

        read = catalog.data_files(spark, dst)
        master = spark.table(dst)
        if require_new_ids:
            load.require_new_ids(staging, master, keys)
        om, ok, os_ = Observation("master"), Observation("kept"), Observation("staged")
        m = master.observe(om, F.count(F.lit(1)).alias("n"))
        s = staging.observe(os_, F.count(F.lit(1)).alias("n"))
        kept = load.delete_by_key(m, staging, keys, collation).observe(ok, F.count(F.lit(1)).alias("n"))
        new = kept.unionByName(load.align_by_name(master, load.refuse_misfits(master, s, keys)))
        catalog.publish(new, dst, "overwrite", marks=marks, read_files=read)
        deleted, inserted = om.get["n"] - ok.get["n"], os_.get["n"]
        return {"status": f"replaced {dst}", "deleted": deleted, "inserted": inserted,
                "delta": inserted - deleted, "message": load.report_message(deleted, inserted)}

    return _load(spark, ref, target_layer, apply)


class CopyError(RuntimeError):
    """A copy does not hold what its source held."""


def digest_columns(df: DataFrame) -> list:
    """Aggregates that tell a table's content in any order of rows: the row count and the sums of two hashes of each row.

    Hash sums are taken as decimals, so they neither overflow nor round; columns count by name."""
    options = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    plain = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), options)
    total = lambda h: F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("string")
    return [F.count(F.lit(1)).alias("rows"), total(F.xxhash64(plain)).alias("one"), total(F.xxhash64(F.reverse(plain), F.lit(1))).alias("two")]


def content_digest(df: DataFrame) -> DataFrame:
    """rows, one and two (see ``digest_columns``) of a table, as one row."""
    return df.agg(*digest_columns(df))


def copy_tables(spark: SparkSession, tables: dict[str, DataFrame], target_db: str, suffix: str = "",
                mode: str = "overwrite", long_text: list[str] | None = None, parallel: int = 4, check: bool = True) -> DataFrame:
    """Copy tables into ``target_db`` (names get ``suffix``); returns (table_name, rows)
    read back from the written tables.  Up to ``parallel`` copies are
    submitted at once, so small tables do not leave the cluster idle.

    Unless ``check`` is off (or rows are appended), the content digests of source and copy must agree, else ``CopyError``;
    the source's is taken while it is written."""
    from pyspark.sql import Observation

    from wareloom.functions.columns import long_text_last

    catalog.ensure_database(spark, target_db)

    def copy(name: str) -> str:
        out = f"{target_db}.{name}{suffix}"
        df = tables[name]
        if long_text:
            df = long_text_last(df, long_text)
        seen = Observation(f"copy-{name}")
        checked = check and mode != "append"
        catalog.publish(df.observe(seen, *digest_columns(df)) if checked else df, out, mode)
        if checked:
            was, now = seen.get, content_digest(spark.table(out)).first().asDict()
            if was != now:
                raise CopyError(f"{out} differs from its source: {now} against {was}")
        return out

    written = for_each_table(list(tables), copy, parallel=min(parallel, len(tables)))
    parts = [spark.table(out).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
             for name, out in written.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def run_replace_generated_id(spark: SparkSession, ref: TableRef, keys: list[str], id_col: str, order_cols: list[str],
                             target_layer: str = "master") -> str:
    """Replace by key into a target whose ``id_col`` is generated: staging's own
    values of it are left out and new ids follow the target's largest."""
    def apply(staging, dst, batch, marks):
        read = catalog.data_files(spark, dst)
        new = load.replace_generated_id(spark.table(dst), staging, keys, id_col, order_cols)
        catalog.publish(new, dst, "overwrite", marks=marks, read_files=read)
        return {"status": f"replaced {dst}"}

    numbered = lambda staging: load.with_sequence_id(staging.drop(id_col), id_col, order_cols)
    out = _load(spark, ref, target_layer, apply, first=numbered)
    return out["status"].replace(f"moved {ref.at('staging').qualified} to", "replaced")


def convert_datetimes(spark: SparkSession, ref: TableRef, columns: list[str]) -> str:
    """Convert text columns of a staged table to timestamps in place."""
    from wareloom.functions import dates

    src = ref.at("staging").qualified
    if not catalog.exists(spark, src):
        return f"skipped: {src} does not exist"
    catalog.publish(dates.try_convert(spark.table(src), columns), src, "overwrite")
    return f"converted {', '.join(columns)} of {src}"


def run_replace_partitions(spark: SparkSession, ref: TableRef, keys: list[str], partition_cols: list[str],
                           target_layer: str = "master") -> dict:
    """Replace by key on a master partitioned by ``partition_cols``, rewriting
    only the partitions that staging touches.

    Exact only when the partition columns are part of the key (then a key
    match implies the same partition) and the master is partitioned by just
    these columns; both are enforced, and a first load creates the master so.
    The files of the touched partitions (the NULL partition too) are listed
    first; their rows that staging does not replace and the staging rows are written beside
    the table, and one commit takes the listed files out and the new ones in.
    Files that other writers add meanwhile stay; when they replaced a listed
    file the commit is refused.
    """
    if not partition_cols or not set(partition_cols) <= set(keys):
        raise ValueError("partition columns must be part of the key for a partition-wise replace")

    def apply(staging, dst, batch, marks):
        if sorted(catalog.partition_columns(spark, dst)) != sorted(partition_cols):
            raise ValueError(f"{dst} is partitioned by {catalog.partition_columns(spark, dst)}, not by {partition_cols}")
        spark.catalog.refreshTable(dst)
        master = spark.table(dst).select("*", F.col("_metadata.file_path").alias("__file"))
        staged = load.align_by_name(spark.table(dst), load.refuse_misfits(spark.table(dst), staging, keys))
        touched = staged.select(*[F.col(f"`{c}`").alias(f"__t_{c}") for c in partition_cols]).distinct()
        same = reduce(lambda a, b: a & b, [master[f"`{c}`"].eqNullSafe(touched[f"`__t_{c}`"]) for c in partition_cols])
        listed = master.join(touched, same, "left_semi").select("__file").distinct()  # reads no column but the partitions'
        old = catalog.relative_files(spark, dst, [r["__file"] for r in listed.collect()])
        kept = load.delete_by_key(catalog.rows_of(spark, dst, old), staging, keys)  # keys are compared before staging takes the master's types
        catalog.change_files(kept.unionByName(staged), dst, marks, old, batch)
        return {"status": f"replaced {touched.count()} partition(s) of {dst}"}

    return _load(spark, ref, target_layer, apply, partition_cols)
