"""Catalog helpers: column listing and the publish swap.

A Parquet table cannot be overwritten while it is read, has no MERGE, and
cannot be renamed across databases.  Publishing a new version of
``db.t`` therefore writes ``db.t__new`` first, then renames
``db.t -> db.t__old``, ``db.t__new -> db.t`` and drops ``db.t__old``.  A
failure before the first rename leaves ``db.t`` untouched; ``recover`` finishes
a swap that stopped between the renames, and ``exists`` always recovers first, so
no job takes an interrupted table for a missing one.  Changes that only add or
replace files go through ``wareloom.transactions``, which ``recover`` finishes too.

Both kinds carry ``marks``: properties that become true of the table in the same
step as its new content (the load ledger of ``wareloom.jobs``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wareloom import transactions
from wareloom.functions.types import sql_type_name

NEW, OLD = "__new", "__old"


def exists(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` exists, after finishing an interrupted swap of it."""
    recover(spark, table)
    return spark.catalog.tableExists(table)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _properties(spark: SparkSession, table: str) -> dict[str, str]:
    """The properties that users set on a table."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return {r["key"]: r["value"] for r in rows if not r["key"].startswith(("spark.", "transient", "numFiles", "totalSize"))}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def set_property(spark: SparkSession, table: str, key: str, value: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({_quoted(key)} = {_quoted(value)})")


def unset_property(spark: SparkSession, table: str, key: str) -> None:
    spark.sql(f"ALTER TABLE {table} UNSET TBLPROPERTIES IF EXISTS ({_quoted(key)})")


def get_property(spark: SparkSession, table: str, key: str) -> str | None:
    return _properties(spark, table).get(key)


def _provider(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    return next(r["data_type"] for r in reversed(rows) if r["col_name"].strip() == "Provider").lower()


def data_files(spark: SparkSession, table: str) -> set[str]:
    """The data files a table has now."""
    spark.catalog.refreshTable(table)
    return set(spark.table(table).inputFiles())


def ensure_database(spark: SparkSession, db: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`")


def _split(table: str) -> tuple[str, str]:
    db, _, name = table.rpartition(".")
    return db, name


def columns(spark: SparkSession, databases: list[str] | None = None) -> DataFrame:
    """(db, table_name, ordinal, column_name, data_type, nullable) of catalog tables.

    Metadata only (no data job); one row per column.
    """
    rows = []
    dbs = databases or [d.name for d in spark.catalog.listDatabases()]
    for db in dbs:
        for t in spark.catalog.listTables(db):
            if t.isTemporary:
                continue
            schema = spark.table(f"`{db}`.`{t.name}`").schema
            for i, f in enumerate(schema.fields):
                rows.append((db, t.name, i + 1, f.name, sql_type_name(f), f.nullable))
    from wareloom.session import local_rows

    return local_rows(spark, rows,
                      "db string, table_name string, ordinal int, column_name string, data_type string, nullable boolean")


def _location(spark: SparkSession, table: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE EXTENDED {table} {partition}").collect()
    return next(r["data_type"] for r in reversed(rows) if r["col_name"].strip() == "Location")


def _partition_clause(path: str) -> str:
    """``PARTITION (...)`` of a partition path such as ``a=1/b=x%20y``."""
    from urllib.parse import unquote

    pairs = (part.partition("=") for part in path.split("/"))
    null = "__HIVE_DEFAULT_PARTITION__"
    quoted = lambda v: "null" if v == null else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return "PARTITION (" + ", ".join(f"`{unquote(k)}` = {quoted(unquote(v))}" for k, _, v in pairs) + ")"


def _relocate(spark: SparkSession, table: str) -> None:
    """After a rename: point partitions at the table's own folder where the
    catalog (the in-memory one does) left them at the old name's."""
    if not partition_columns(spark, table):
        return
    parts = [r["partition"] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    home = _location(spark, table).rstrip("/")
    if parts and not _location(spark, table, _partition_clause(parts[0])).startswith(home + "/"):
        for path in parts:
            spark.sql(f"ALTER TABLE {table} {_partition_clause(path)} SET LOCATION '{home}/{path}'")
    spark.catalog.refreshTable(table)


def recover(spark: SparkSession, table: str) -> None:
    """Finish or roll back an interrupted swap of ``table``, then finish its committed file changes."""
    there = spark.catalog.tableExists
    db, name = _split(table)
    new, old = f"{table}{NEW}", f"{table}{OLD}"
    if there(old):
        if not there(table):
            spark.sql(f"ALTER TABLE {new if there(new) else old} RENAME TO {db + '.' if db else ''}{name}")
        _relocate(spark, table)
        spark.sql(f"DROP TABLE IF EXISTS {old}")
    if there(table):
        _finish(spark, table)


def _finish(spark: SparkSession, table: str) -> None:
    """Carry out the committed file changes of a table."""
    location = _location(spark, table)
    for folder in transactions.undecided(spark, location):
        properties, parts = transactions.apply(spark, location, folder)
        for part in parts:
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {_partition_clause(part)}")
        for key, value in properties.items():
            set_property(spark, table, key, value)
        transactions.close(spark, location, folder)
        spark.catalog.refreshTable(table)


def relative_files(spark: SparkSession, table: str, uris: list[str]) -> list[str]:
    """Paths below the table's folder of the files that ``_metadata.file_path`` names."""
    jvm = spark.sparkContext._jvm
    plain = lambda text: jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(text)).toUri().getPath()
    home = jvm.org.apache.hadoop.fs.Path(_location(spark, table)).toUri().getPath().rstrip("/") + "/"
    out = []
    for uri in uris:
        path = plain(uri)
        if not path.startswith(home):
            raise ValueError(f"{path} lies outside of {home}")
        out.append(path[len(home):])
    return out


def rows_of(spark: SparkSession, table: str, files: list[str]) -> DataFrame:
    """The rows of some files of a table, with its schema."""
    schema = spark.table(table).schema
    if not files:
        return spark.createDataFrame([], schema)
    home = _location(spark, table).rstrip("/")
    read = spark.read.format(_provider(spark, table)).schema(schema).option("basePath", home)
    return read.load([f"{home}/{f}" for f in files]).select(*[F.col(f"`{f.name}`") for f in schema.fields])


def change_files(df: DataFrame, table: str, marks: dict[str, str] | None = None, removed: list[str] = (), batch: str | None = None) -> None:
    """Add the files of ``df`` (the table's columns) to ``table`` and take ``removed`` out, as one whole."""
    import uuid

    spark, batch = df.sparkSession, batch or uuid.uuid4().hex
    location, parts = _location(spark, table), partition_columns(spark, table)
    transactions.prepare(df, location, batch, _provider(spark, table), parts)
    transactions.commit(spark, location, batch, marks or {}, removed)
    _finish(spark, table)


def publish(df: DataFrame, table: str, mode: str = "overwrite", partition_by: list[str] | None = None, marks: dict[str, str] | None = None,
            read_files: set[str] | None = None, before_swap=None, batch: str | None = None) -> None:
    """Make ``df`` the content of ``table``.

    ``overwrite`` goes through the swap (``df`` may read ``table``); the new
    version keeps the partitioning (unless ``partition_by`` is given) and the
    properties of the old one.  ``append`` adds files as one whole, columns by name; ``errorifexists``
    refuses an existing target.  ``marks`` are properties of the new content.
    With ``read_files`` (the files that ``df`` was planned on) the swap is refused
    when another writer has changed the table since; ``before_swap`` is called with the
    name of the written, still hidden version.
    """
    spark = df.sparkSession
    db, name = _split(table)
    if db:
        ensure_database(spark, db)
    present = exists(spark, table)
    if mode == "append" and present:
        schema = spark.table(table).schema
        fitted = df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
        change_files(fitted, table, marks, batch=batch)
        return
    if mode == "errorifexists" and present:
        raise RuntimeError(f"{table} already exists")
    new, old = f"{table}{NEW}", f"{table}{OLD}"
    spark.sql(f"DROP TABLE IF EXISTS {new}")
    if partition_by is None and present:
        partition_by = [c for c in partition_columns(spark, table) if c in df.columns]
    writer = df.write.mode("overwrite").format("parquet")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(new)
    for key, value in ((_properties(spark, table) if present else {}) | (marks or {})).items():
        set_property(spark, new, key, value)
    if before_swap is not None:
        before_swap(new)
    if read_files is not None and present and data_files(spark, table) != read_files:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise transactions.ChangedMeanwhile(f"{table} was changed by another writer while its new version was written")
    prefix = f"{db}." if db else ""
    if present:
        spark.sql(f"ALTER TABLE {table} RENAME TO {prefix}{name}{OLD}")
    spark.sql(f"ALTER TABLE {new} RENAME TO {prefix}{name}")
    _relocate(spark, table)
    spark.sql(f"DROP TABLE IF EXISTS {old}")
    # readers planned before the swap cached the old file listing of this name
    spark.catalog.refreshTable(table)


def move(spark: SparkSession, source_table: str, target_table: str, partition_by: list[str] | None = None, marks: dict[str, str] | None = None) -> None:
    """Move a table to another database (copy + drop: no cross-database rename)."""
    publish(spark.table(source_table), target_table, "overwrite", partition_by, marks)
    spark.sql(f"DROP TABLE IF EXISTS {source_table}")


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
