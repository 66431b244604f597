"""Landing-folder loads with Structured Streaming.

New staging files dropped in a landing folder are picked up by a file
stream; each micro-batch is applied to the master table with a keyed load
(replace-by-key or append-new) and published as one new table version.

* ``trigger(availableNow=True)`` processes everything that has landed, in
  bounded batches (``max_files_per_trigger``), then stops: the batch job of
  the reference, without a scheduler-side "what is new" bookkeeping.
* The stream checkpoint (in the shared checkpoint folder) records which files
  were consumed, so a restarted job neither skips nor re-reads files.
* ``load_backlog`` publishes once for everything that has landed, however many
  bounded micro-batches it takes: a replace rewrites the master, so one per
  batch would rewrite it once per small drop.
* The master notes the last epoch of each stream in the same step that publishes
  it, so an epoch that is retried after a failure is not applied twice (rows
  with a NULL key would double, and unseen rows of one batch may share a key).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wareloom import catalog
from wareloom.operators import load
from wareloom.session import remove_scratch


STREAM = "wareloom.stream"


def _epoch_done(spark: SparkSession, table: str, stream: str | None) -> int:
    """The last epoch of a stream that the table holds; -1 for none."""
    return int(catalog.get_property(spark, table, f"{STREAM}.{stream}") or -1) if stream else -1


def apply_batch(master_table: str, keys: list[str], mode: str = "replace", caller: SparkSession | None = None):
    """The ``foreachBatch`` function (runs on the driver).  Micro-batches run in
    a cloned session with its own table cache, so the caller's session is
    refreshed too after each publish."""
    def run(batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        if batch.isEmpty():
            return
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")  # kept by the checkpoint
        marks = {f"{STREAM}.{stream}": str(epoch_id)} if stream else None
        if not catalog.exists(spark, master_table):
            catalog.publish(batch, master_table, "overwrite", marks=marks)
        elif _epoch_done(spark, master_table, stream) < epoch_id:
            spark.catalog.refreshTable(master_table)
            master = spark.table(master_table)
            if mode == "replace":
                catalog.publish(load.replace(master, batch, keys), master_table, "overwrite", marks=marks)
            elif mode == "append_new":
                # only the unseen rows are added; the master's files stay as they are
                fresh = load.align_by_name(master, load.unseen(batch, master, keys))
                catalog.publish(fresh, master_table, "append", marks=marks)
            else:
                raise ValueError(f"unknown mode {mode!r}")
        if caller is not None:
            caller.catalog.refreshTable(master_table)
    return run


def load_landing(spark: SparkSession, landing: str, schema, master_table: str, keys: list[str],
                 checkpoint: str, mode: str = "replace", fmt: str = "parquet",
                 max_files_per_trigger: int | None = None, available_now: bool = True) -> StreamingQuery:
    """Start the landing stream; with ``available_now`` it ends after the backlog."""
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)
    writer = (stream.writeStream.foreachBatch(apply_batch(master_table, keys, mode, caller=spark))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def load_backlog(spark: SparkSession, landing: str, schema, master_table: str, keys: list[str], checkpoint: str,
                 fmt: str = "parquet", max_files_per_trigger: int | None = None) -> str:
    """Replace by key from everything that has landed, in one published version.

    Micro-batches are kept beside the stream checkpoint, numbered; of a key that
    several batches hold the latest batch's rows count, as if the batches had been
    applied in order (rows with a NULL key are all kept).  A run that stops before
    the publish leaves the kept batches for the next run; one that stops after
    it finds the published batches noted on the master and leaves them out.
    """
    kept = f"{checkpoint.rstrip('/')}-backlog"

    def keep(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{kept}/batch={epoch_id}")

    reader = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    writer = reader.load(landing).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(kept)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return "nothing landed"
    wanted = spark.createDataFrame([], schema).withColumn("batch", F.lit(0).cast("long"))
    there = catalog.exists(spark, master_table)
    done = _epoch_done(spark, master_table, query.id) if there else -1
    rows = spark.read.schema(wanted.schema).parquet(kept).where(F.col("batch") > done)
    newest_batch = rows.agg(F.max("batch")).first()[0]
    if newest_batch is None:
        remove_scratch(spark, kept)
        return f"already published {master_table}"
    last = rows.groupBy(*keys).agg(F.max("batch").alias("__last")).withColumnsRenamed({k: f"__k_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [rows[f"`{k}`"] == last[f"`__k_{k}`"] for k in keys])
    newest = rows.join(last, same, "left").where(F.col("__last").isNull() | (F.col("batch") == F.col("__last")))
    staged = newest.select(*[F.col(f"`{c}`") for c in wanted.columns if c != "batch"])
    if there:
        staged = load.replace(spark.table(master_table), staged, keys)
    catalog.publish(staged, master_table, "overwrite", marks={f"{STREAM}.{query.id}": str(newest_batch)})
    remove_scratch(spark, kept)
    return f"published {master_table}"
