"""Two-pass type inference for text-staged tables.

Pass 1 (``profile``) is ONE aggregate job over all string columns (map-side
partial aggregation, so its shuffle is #partitions x #columns values).  Its
one-row result is metadata sized by the column count, so it is read on the
driver to decide the casts.  Pass 2 (``convert_types``) is one projection.
Wide tables (hundreds of columns) are profiled through an unpivot + groupBy
instead of hundreds of aggregate expressions, which keeps codegen small.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions import dates as D
from wareloom.functions import geo as G
from wareloom.functions.columns import COMPUTED_MARK

DIGITS = r"^[0-9]+$"
# bigint holds every 18-digit number; longer digit strings go to decimal(38,0)
BIGINT_DIGITS = 18
DECIMAL_DIGITS = 38
WIDE_PROFILE_COLUMNS = 200


@dataclass(frozen=True)
class ColumnProfile:
    name: str
    non_null: int
    non_digit: int
    max_len: int | None
    leading_zero: int = 0  # values such as codes "007" (read with all_digits: digits with a leading zero)

    @property
    def all_digits(self) -> bool:
        # an all-null column counts as numeric (as the reference coded it)
        return self.non_digit == 0


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def profile(df: DataFrame, columns: list[str] | None = None) -> dict[str, ColumnProfile]:
    """Digit profile of string columns in one job."""
    cols = columns if columns is not None else _string_columns(df)
    if not cols:
        return {}
    if len(cols) <= WIDE_PROFILE_COLUMNS:
        aggs = []
        for i, c in enumerate(cols):
            ref = F.col(f"`{c}`")
            aggs += [
                F.count(ref).alias(f"n{i}"),
                F.count_if(ref.isNotNull() & ~ref.rlike(DIGITS)).alias(f"b{i}"),
                F.max(F.length(ref)).alias(f"l{i}"),
                F.count_if(ref.startswith("0") & (F.length(ref) > 1)).alias(f"z{i}"),
            ]
        row = df.agg(*aggs).first()
        return {c: ColumnProfile(c, row[f"n{i}"], row[f"b{i}"], row[f"l{i}"], row[f"z{i}"])
                for i, c in enumerate(cols)}
    long = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cols]).unpivot(
        [], cols, "column_name", "value")
    rows = (long.groupBy("column_name")
            .agg(F.count("value").alias("n"),
                 F.count_if(F.col("value").isNotNull() & ~F.col("value").rlike(DIGITS)).alias("b"),
                 F.max(F.length("value")).alias("l"),
                 F.count_if(F.col("value").startswith("0") & (F.length("value") > 1)).alias("z"))
            .collect())
    got = {r["column_name"]: ColumnProfile(r["column_name"], r["n"], r["b"], r["l"], r["z"]) for r in rows}
    return {c: got.get(c, ColumnProfile(c, 0, 0, None)) for c in cols}


def _digits_cast(c, p: ColumnProfile):
    """Cast an all-digit column to the type that the profile proves every value
    fits; a column with more digits than any number type holds stays text."""
    if p.max_len is not None and p.max_len > DECIMAL_DIGITS:
        return c
    return c.try_cast(digits_type(p))


def digits_type(p: ColumnProfile) -> T.DataType:
    if p.max_len is not None and p.max_len > BIGINT_DIGITS:
        return T.DecimalType(38, 0)
    return T.LongType()


def digits(df: DataFrame, prof: dict[str, ColumnProfile] | None = None) -> DataFrame:
    """Cast every all-digit string column to bigint (decimal(38,0) when too wide, text above 38 digits)."""
    prof = prof if prof is not None else profile(df)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        p = prof.get(f.name)
        cols.append(_digits_cast(c, p).alias(f.name) if p is not None and p.all_digits else c)
    return df.select(*cols)


def dates_by_name(df: DataFrame, marks: tuple[str, ...] = ("date",),
                  patterns: tuple[str, ...] = D.DEFAULT_PATTERNS) -> DataFrame:
    """String columns whose name contains a mark become timestamps; failures NULL."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType) and any(m in f.name for m in marks):
            cols.append(D.parse_timestamp(c, patterns).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


def convert_types(df: DataFrame, prof: dict[str, ColumnProfile] | None = None,
                  patterns: tuple[str, ...] = D.DEFAULT_PATTERNS, keep_leading_zeros: bool = False) -> DataFrame:
    """Ordered rule cascade, first match wins, one projection:

    1. name contains ``:@computed``       -> dropped
    2. every non-null value is ASCII digits -> bigint / decimal(38,0); over 38 digits: text
    3. name contains ``date``             -> timestamp (bad text -> NULL)
    4. name contains latitude and longitude -> ``longitude``, ``latitude`` doubles
       (with a suffix ``_2``, ... where the table has such a column already)
    """
    prof = prof if prof is not None else profile(df)
    out = []
    taken = set(df.columns)
    for f in df.schema.fields:
        name = f.name
        c = F.col(f"`{name}`")
        p = prof.get(name)
        if COMPUTED_MARK in name:
            continue
        if p is not None and p.all_digits:
            if keep_leading_zeros and p.leading_zero > 0:
                out.append(c)  # codes such as "00731" stay text: a number would lose the zeros
            else:
                out.append(_digits_cast(c, p).alias(name))
        elif isinstance(f.dataType, T.StringType) and "date" in name:
            out.append(D.parse_timestamp(c, patterns).alias(name))
        elif "latitude" in name and "longitude" in name:
            lon, lat = G.point_parts(c)
            for part, plain in ((lon, "longitude"), (lat, "latitude")):
                free = G.free_name(plain, taken - {name})
                taken.add(free)
                out.append(part.alias(free))
        else:
            out.append(c)
    return df.select(*out)


def long_text_profile(df: DataFrame, limit: int = 255) -> DataFrame:
    """Longest value (in characters) per column, one aggregate job.

    Returns (column_name, max_length, long_text) with one row per column;
    ``long_text`` is true when the longest value exceeds ``limit``.
    """
    names = df.columns
    if len(names) > WIDE_PROFILE_COLUMNS:
        # one aggregate per block of columns keeps the generated code small
        blocks = [names[i : i + WIDE_PROFILE_COLUMNS] for i in range(0, len(names), WIDE_PROFILE_COLUMNS)]
        parts = [long_text_profile(df.select(*[F.col(f"`{c}`") for c in b]), limit) for b in blocks]
        return reduce(lambda a, b: a.unionByName(b), parts)
    lengths = [F.length(F.col(f"`{c}`").cast("string")) for c in names]
    wide = df.agg(*[F.max(ln).alias(f"m{i}") for i, ln in enumerate(lengths)])
    stack = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', m{i}" for i, c in enumerate(names))
    long = wide.selectExpr(f"stack({len(names)}, {stack}) as (column_name, max_length)")
    return long.select("column_name", F.col("max_length").cast("bigint").alias("max_length"),
                       F.coalesce(F.col("max_length") > F.lit(limit), F.lit(False)).alias("long_text"))
