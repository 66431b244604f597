"""Type coercions (ANSI mode is on in Spark 4, so every cast is a ``try_cast``:
bad values become NULL instead of failing the job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
DATETIME = (T.DateType, T.TimestampType, T.TimestampNTZType)

# Warehouse type names of Spark types (the contract vocabulary).
SQL_TYPE_NAMES = {
    "IntegerType": "int",
    "LongType": "bigint",
    "ShortType": "smallint",
    "ByteType": "tinyint",
    "DoubleType": "float",
    "FloatType": "real",
    "BooleanType": "bit",
    "StringType": "varchar",
    "TimestampType": "datetime",
    "TimestampNTZType": "datetime",
    "DateType": "date",
    "DecimalType": "decimal",
    "BinaryType": "varbinary",
}
# Field metadata key that overrides the name (e.g. WKT text declared "geography").
SQL_TYPE_META = "sql_type"


def sql_type_name(field: T.StructField) -> str:
    meta = field.metadata or {}
    if SQL_TYPE_META in meta:
        return str(meta[SQL_TYPE_META])
    return SQL_TYPE_NAMES.get(type(field.dataType).__name__, field.dataType.simpleString())


# Most significant digits an integral / decimal target can hold.
_MAX_DIGITS = {"tinyint": 3, "smallint": 5, "int": 10, "integer": 10, "bigint": 19, "long": 19}


def safe_cast(col: Column | str, target: str | T.DataType) -> Column:
    """``try_cast`` of text to an integral or decimal type, with the same results,
    but without the overflow exception path (about 15x slower per value): text
    whose significant digits cannot fit is NULL before any cast is tried."""
    c = F.col(col) if isinstance(col, str) else col
    dt = target if isinstance(target, T.DataType) else None
    name = dt.simpleString() if dt is not None else str(target).lower()
    limit = _MAX_DIGITS.get(name)
    if limit is None and name.startswith("decimal"):
        dt = dt or T._parse_datatype_string(name)
        limit = dt.precision - dt.scale
    if limit is None:
        return c.try_cast(target)
    digits = F.length(F.regexp_extract(c.cast("string"), r"^\s*[+-]?0*([0-9]*)", 1))
    return F.when(digits > limit, F.lit(None).cast(target)).otherwise(c.try_cast(target))


def to_int(df: DataFrame, columns: list[str]) -> DataFrame:
    """Integer coercion of listed columns; overflow and bad text become NULL."""
    return df.withColumns({c: safe_cast(F.col(f"`{c}`"), "int") for c in columns})


def to_double(df: DataFrame, columns: list[str] | None = None, integral: bool = True) -> DataFrame:
    """Float coercion of listed columns and (by default) of every integral column."""
    columns = list(columns or [])
    if integral:
        columns += [f.name for f in df.schema.fields if isinstance(f.dataType, INTEGRAL) and f.name not in columns]
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in columns})


def strip_zone_expr(col: Column | str) -> Column:
    """A zoned timestamp as naive UTC wall time, independent of the session zone."""
    from wareloom.functions.dates import EPOCH_NTZ, add_micros

    c = F.col(col) if isinstance(col, str) else col
    return add_micros(F.expr(EPOCH_NTZ), F.unix_micros(c.cast("timestamp")))


def strip_zone(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Every zoned (``timestamp``) column, or the listed ones, to naive UTC."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: strip_zone_expr(F.col(f"`{c}`")) for c in columns})


def datetimes_by_type(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Date / datetime columns (or listed text columns) to timestamp_ntz; bad values NULL."""
    if columns is None:
        columns = [f.name for f in df.schema.fields if isinstance(f.dataType, DATETIME)]
    out = {}
    for c in columns:
        dt = df.schema[c].dataType
        ref = F.col(f"`{c}`")
        if isinstance(dt, T.TimestampType):
            out[c] = strip_zone_expr(ref)
        else:
            out[c] = ref.try_cast("timestamp_ntz")
    return df.withColumns(out)
