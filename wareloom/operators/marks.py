"""Stored high-water marks: exact, zone free, and kept beside the warehouse.

``incremental.pull`` reads the mark off the master each time and takes ``>``: rows
that share the mark's value but came later are lost, and with ``>=`` they come
twice.  A stored mark knows its value exactly (epoch microseconds or a decimal,
never local text) and which ids it has seen at that value, so the next pull takes
what lies above it and, at it, the ids not seen yet.  Pulls scan no master.

The mark table is partitioned by the mark's name; the rows of a mark are its
value with one id each (and one without an id).  A pull writes the
mark that will hold once its batch is loaded, as ``next`` with the batch id,
before the batch is staged.  The load notes that batch on the target in the step that
makes its rows visible (``wareloom.pulled.<name>``), and only then does ``next`` count.
A batch that is staged but never loaded is pulled again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom import catalog, jobs
from wareloom.naming import TableRef

SCHEMA = "kind string, whole decimal(38,0), fraction double, text string, id string, state string, batch string, mark string"
EPOCH = dt.datetime(1970, 1, 1)


def _kind(t: T.DataType) -> str:
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return "whole"
    if isinstance(t, T.DecimalType):
        return f"decimal({t.precision},{t.scale})"
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return "double"
    if isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType)):
        return t.simpleString()
    raise ValueError(f"no stored mark for a column of type {t.simpleString()}")


def ntz_micros(c: Column) -> Column:
    """Microseconds of a zone-free timestamp since 1970-01-01, whatever the session's zone."""
    day = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    seconds = (F.hour(c) * 3600 + F.minute(c) * 60).cast("long")
    micros = (F.expr("1000000") * F.extract(F.lit("SECOND"), c)).cast("long")
    return (day * 86_400 + seconds) * 1_000_000 + micros


def _stored(c: Column, kind: str) -> dict[str, Column]:
    """The value columns of a mark."""
    none = {"whole": F.lit(None).cast("decimal(38,0)"), "fraction": F.lit(None).cast("double"), "text": F.lit(None).cast("string")}
    if kind == "whole":
        return none | {"whole": c.cast("decimal(38,0)")}
    if kind.startswith("decimal"):
        return none | {"text": c.cast("string")}
    if kind == "double":
        return none | {"fraction": c.cast("double")}
    if kind == "timestamp":
        return none | {"whole": F.unix_micros(c).cast("decimal(38,0)")}
    if kind == "timestamp_ntz":
        return none | {"whole": ntz_micros(c).cast("decimal(38,0)")}
    if kind == "date":
        return none | {"whole": F.unix_date(c).cast("decimal(38,0)")}
    return none | {"text": c}


def _literal(kind: str, whole, fraction, text) -> Column:
    """The stored value as a literal of the column's own type (it reaches the scan's pushed filters)."""
    if kind == "whole":
        return F.lit(int(whole))
    if kind.startswith("decimal"):
        return F.lit(text).cast(kind)
    if kind == "double":
        return F.lit(float(fraction))
    if kind == "timestamp":
        return F.timestamp_micros(F.lit(int(whole)))
    if kind == "timestamp_ntz":
        at = EPOCH + dt.timedelta(microseconds=int(whole))
        return F.expr(f"TIMESTAMP_NTZ'{at.isoformat(sep=' ', timespec='microseconds')}'")
    if kind == "date":
        return F.date_from_unix_date(F.lit(int(whole)))
    return F.lit(text)


@dataclass(frozen=True)
class Mark:
    value: Column
    seen: DataFrame  # id (text) of the rows at the value


def _rows(spark: SparkSession, marks_table: str, name: str) -> DataFrame:
    return spark.table(marks_table).where(F.col("mark") == name)


def stored(spark: SparkSession, marks_table: str, name: str, target: str) -> Mark | None:
    """The mark that holds for ``target`` now; None before the first loaded pull."""
    if not catalog.exists(spark, marks_table):
        return None
    loaded = catalog.get_property(spark, target, f"{jobs.PULLED}.{name}") if catalog.exists(spark, target) else None
    rows = _rows(spark, marks_table, name)
    batch = "" if loaded is None else loaded
    mine = rows.where((F.col("state") == "next") & (F.col("batch") == batch))
    if mine.isEmpty():
        mine = rows.where(F.col("state") == "current")
    head = mine.where(F.col("id").isNull()).first()
    if head is None:
        return None
    return Mark(_literal(head["kind"], head["whole"], head["fraction"], head["text"]), mine.where(F.col("id").isNotNull()).select("id"))


def beyond(source: DataFrame, column: str, id_col: str, mark: Mark | None) -> DataFrame:
    """Rows above the mark, and those at it whose id it has not seen (a NULL id was never seen)."""
    if mark is None:
        return source
    c = F.col(f"`{column}`")
    seen = mark.seen.select(F.struct("id").alias("__seen"))
    at = source.where(c == mark.value).withColumn("__seen", F.struct(F.col(f"`{id_col}`").cast("string").alias("id")))
    fresh = at.join(seen, "__seen", "left_anti").drop("__seen")
    return source.where(c > mark.value).unionByName(fresh)


def _next_rows(pulled: DataFrame, column: str, id_col: str, mark: Mark | None) -> DataFrame:
    """kind, value columns and id of the mark after ``pulled``."""
    kind = _kind(pulled.schema[column].dataType)
    c = F.col(f"`{column}`")
    top = pulled.agg(F.max(c).alias("__top"))
    if mark is not None:  # a pull of nothing, or of late ids only, stays at the mark
        top = top.select(F.greatest(F.coalesce("__top", mark.value), mark.value).alias("__top"))
    at = pulled.join(F.broadcast(top), c == F.col("__top")).select("__top", F.col(f"`{id_col}`").cast("string").alias("id")).where("id is not null")
    if mark is not None:
        at = at.unionByName(top.where(F.col("__top") == mark.value).crossJoin(mark.seen).select("__top", "id"))  # one row against the ids
    rows = top.where("__top is not null").select("__top", F.lit(None).cast("string").alias("id")).unionByName(at.distinct())
    return rows.select(F.lit(kind).alias("kind"), *[v.alias(n) for n, v in _stored(F.col("__top"), kind).items()], "id")


def pull(source: DataFrame, ref: TableRef, column: str, id_col: str, marks_table: str, target_layer: str = "master",
         name: str | None = None) -> str:
    """Stage what ``source`` has beyond the stored mark of (target, column); returns the staging table.

    Loading that batch with ``wareloom.jobs`` advances the mark in the load's own step.
    """
    spark = source.sparkSession
    target = ref.at(target_layer).qualified
    name = name or f"{target}.{column}".lower()
    mark = stored(spark, marks_table, name, target)
    batch = uuid.uuid4().hex

    def note(hidden: str) -> None:
        new = _next_rows(spark.table(hidden), column, id_col, mark)
        rows = new.select(*new.columns, F.lit("next").alias("state"), F.lit(batch).alias("batch"), F.lit(name).alias("mark"))
        if mark is not None:
            kind = _kind(source.schema[column].dataType)
            value = _stored(mark.value, kind)
            one = spark.range(1).select(F.lit(None).cast("string").alias("id")).unionByName(mark.seen)
            rows = rows.unionByName(one.select(F.lit(kind).alias("kind"), *[v.alias(n) for n, v in value.items()], "id", F.lit("current").alias("state"),
                                               F.lit("").alias("batch"), F.lit(name).alias("mark")))
        _replace(spark, marks_table, name, rows)

    return jobs.stage(beyond(source, column, id_col, mark), ref, pulled=name, before_swap=note, batch=batch)


def _replace(spark: SparkSession, marks_table: str, name: str, rows: DataFrame) -> None:
    """Make ``rows`` the rows of one mark; the other marks' files stay as they are."""
    if not catalog.exists(spark, marks_table):
        catalog.publish(spark.createDataFrame([], SCHEMA), marks_table, partition_by=["mark"])
    listed = _rows(spark, marks_table, name).select(F.col("_metadata.file_path").alias("f")).distinct().collect()  # the few files of one mark
    old = catalog.relative_files(spark, marks_table, [r["f"] for r in listed])
    fields = spark.table(marks_table).schema.fields
    catalog.change_files(rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields]), marks_table, removed=old)
