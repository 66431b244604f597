"""Column-name repair and whole-frame projections.

Name rules run on the driver over the schema only (no job); everything
that touches values is one ``select`` so Catalyst keeps it in a single
codegen stage.
"""

from __future__ import annotations

import itertools
import re
import string
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Placeholder header a spreadsheet reader gives an unnamed column.
UNNAMED_PREFIX = "Unnamed"
# Columns computed by the open-data portal (dropped on ingest).
COMPUTED_MARK = ":@computed"


UPPER, LOWER, DIGIT = string.ascii_uppercase, string.ascii_lowercase, string.digits


def _words(name: str) -> list[str]:
    """Split where the character class changes: a capital opens a word after a
    small letter or digit, and the last capital of a run opens one before a small letter."""
    words = [""]
    for before, char, after in zip(" " + name, name, name[1:] + " "):
        opens = char in UPPER and (before in LOWER + DIGIT or before in UPPER and after in LOWER)
        if opens:
            words.append("")
        words[-1] += char
    return words


def _trim(name: str, most: int = 2) -> str:
    """Without up to ``most`` underscores at either end."""
    for _ in range(most):
        name = name.removeprefix("_")
    for _ in range(most):
        name = name.removesuffix("_")
    return name


def snake_case(name: str) -> str:
    """Lower words joined by ``_``; ``!``, ``@`` and ``#`` go, spaces become ``_``."""
    joined = "_".join(_words(name)).translate({ord("!"): None, ord("@"): None, ord("#"): None, ord(" "): "_"})
    return _trim(joined).lower()


def clean_name(name: str) -> str:
    """Lower words of ASCII letters and digits joined by ``_``, never opening with a digit."""
    alnum = UPPER + LOWER + DIGIT
    runs = ["".join(g) for w in _words(name) for ok, g in itertools.groupby(w, lambda c: c in alnum) if ok]
    clean = "_".join(runs).lower()
    return clean if clean and clean[0] not in DIGIT else "x" + clean


def unique_names(names: Iterable[str]) -> list[str]:
    """De-duplicate names with suffixes ``_2``, ``_3`` ... (first one stays)."""
    seen: dict[str, int] = {}
    out = []
    taken = set()
    for n in names:
        base = n
        if base in seen or base in taken:
            k = seen.get(base, 1) + 1
            while f"{base}_{k}" in taken:
                k += 1
            seen[base] = k
            n = f"{base}_{k}"
        else:
            seen[base] = 1
        taken.add(n)
        out.append(n)
    return out


def replace_chars(name: str) -> str:
    """Target-name repair: space to ``_``, dots dropped."""
    return name.replace(" ", "_").replace(".", "")


def rename(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Rename every column by ``fn`` (projection only, no job)."""
    return df.toDF(*unique_names(fn(c) for c in df.columns))


def snake_case_columns(df: DataFrame) -> DataFrame:
    return rename(df, snake_case)


def clean_columns(df: DataFrame) -> DataFrame:
    return rename(df, clean_name)


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    """Drop every column whose name matches ``pattern`` (``re.search``)."""
    rx = re.compile(pattern)
    return df.drop(*[c for c in df.columns if rx.search(c)])


def drop_placeholders(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(UNNAMED_PREFIX) or COMPUTED_MARK in c])


def long_text_last(df: DataFrame, long_cols: Iterable[str]) -> DataFrame:
    """Move the listed (present) long-text columns to the end, order kept."""
    long_cols = [c for c in long_cols if c in df.columns]
    others = [c for c in df.columns if c not in long_cols]
    return df.select(*[F.col(f"`{c}`") for c in others + long_cols])


def across(df: DataFrame, predicate: Callable[[T.StructField], bool],
           fn: Callable[[Column, T.StructField], Column]) -> DataFrame:
    """Apply ``fn`` to every column whose field satisfies ``predicate`` in one select."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        cols.append(fn(c, f).alias(f.name) if predicate(f) else c)
    return df.select(*cols)


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flatten nested structs into top-level columns ``parent<sep>child``."""

    def walk(dtype: T.DataType, path: list[str]):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from walk(f.dataType, path + [f.name])
        else:
            ref = F.col(".".join(f"`{p}`" for p in path))
            yield ref.alias(sep.join(path))

    cols = []
    for f in df.schema.fields:
        cols.extend(walk(f.dataType, [f.name]))
    return df.select(*cols)


_INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_NUMERIC_ORDER = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def _common_type(types: list[T.DataType]) -> T.DataType:
    uniq = []
    for t in types:
        if t not in uniq:
            uniq.append(t)
    if len(uniq) == 1:
        return uniq[0]
    if all(type(t) in _NUMERIC_ORDER for t in uniq):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in uniq):
            return T.DoubleType()
        return max(uniq, key=lambda t: _NUMERIC_ORDER.index(type(t)))
    if all(type(t) in _NUMERIC_ORDER or isinstance(t, T.DecimalType) for t in uniq):
        if any(isinstance(t, (T.FloatType, T.DoubleType)) for t in uniq):
            return T.DoubleType()
        # decimals and integers: room for the most whole digits and the most decimal places
        whole = [t.precision - t.scale if isinstance(t, T.DecimalType) else _INTEGER_DIGITS[type(t)] for t in uniq]
        scale = max(t.scale for t in uniq if isinstance(t, T.DecimalType))
        if max(whole) + scale <= 38:
            return T.DecimalType(max(whole) + scale, scale)
    if all(isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)) for t in uniq):
        return T.TimestampNTZType() if any(isinstance(t, T.TimestampNTZType) for t in uniq) else T.TimestampType()
    return T.StringType()


def union_fill(frames: list[DataFrame]) -> DataFrame:
    """Union by name; absent columns become NULL; disagreeing types widen.

    Numeric types widen to the widest (double if any is floating, a decimal
    that holds all values if any is decimal and 38 digits suffice);
    timestamps and dates meet as timestamps; anything else meets as string.
    """
    if not frames:
        raise ValueError("union_fill needs at least one frame")
    types: dict[str, list[T.DataType]] = {}
    order: list[str] = []
    for df in frames:
        for f in df.schema.fields:
            if f.name not in types:
                types[f.name] = []
                order.append(f.name)
            types[f.name].append(f.dataType)
    target = {n: _common_type(ts) for n, ts in types.items()}
    aligned = []
    for df in frames:
        have = {f.name: f.dataType for f in df.schema.fields}
        cols = []
        for n in order:
            if n in have:
                c = F.col(f"`{n}`")
                cols.append(c if have[n] == target[n] else c.try_cast(target[n]).alias(n))
            else:
                cols.append(F.lit(None).cast(target[n]).alias(n))
        aligned.append(df.select(*cols))
    return reduce(lambda a, b: a.unionByName(b), aligned)
