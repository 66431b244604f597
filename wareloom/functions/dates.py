"""Date and time repair as column expressions (all JVM-side, no UDFs).

Results are ``timestamp_ntz`` so that they do not depend on the session
time zone; epoch arithmetic uses ``timestamp_add`` / ``timestamp_diff``
against the epoch instead of zone-dependent casts.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"

# Text patterns tried in order; the first that parses wins.  The first one
# is the ODBC canonical style with a fraction (SQL Server style 121); a
# fraction has one to six digits.
DEFAULT_PATTERNS = (
    "yyyy-MM-dd HH:mm:ss.SSSSSS",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd HH:mm",
    "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm",
    "yyyy-MM-dd",
)
# a zone written after a time of day; the wall clock before it is kept
WRITTEN_ZONE = r"(:\d{2}(?:\.\d+)?)\s*(?:Z|[+-]\d{2}:?\d{2})$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


#: a pattern's letters as the shape that a text must have: lengths per field, other characters themselves
FIELDS = {"y": r"[0-9]{4}", "M": r"[0-9]{2}", "d": r"[0-9]{2}", "H": r"[0-9]{2}", "m": r"[0-9]{2}", "s": r"[0-9]{2}"}


def pattern_shape(pattern: str) -> str | None:
    """A regular expression that every text of the pattern matches; None for patterns with other letters.

    The pattern's fields must be as long as FIELDS has them; a fraction has one to as many digits as it has letters."""
    out, quoted = "", False
    for run in re.finditer(r"'|([A-Za-z])\1*|.", pattern):
        text = run.group(0)
        if text == "'":
            quoted = not quoted
        elif quoted or not run.group(1):
            out += re.escape(text)
        elif run.group(1) == "S":
            out += f"[0-9]{{1,{len(text)}}}"
        elif run.group(1) in FIELDS and len(text) == (4 if run.group(1) == "y" else 2):
            out += FIELDS[run.group(1)]
        else:
            return None
    return f"^{out}$"


def parse_timestamp(col: Column | str, patterns: tuple[str, ...] = DEFAULT_PATTERNS, convert_zone: bool = False) -> Column:
    """First pattern that parses; anything else NULL.  Returns timestamp_ntz.

    A text is parsed by the one pattern whose shape (digits and separators) it has; only
    patterns with names or single-letter fields are tried one after the other.
    The text is parsed as UTC (an explicit ``+00:00`` offset is appended) and
    the instant is turned into a naive timestamp by epoch arithmetic, so the
    written wall clock is kept exactly in any session zone, also for times
    that fall into a daylight-saving gap of the session zone.  A written zone is
    left out; with ``convert_zone`` the time is converted from it to UTC.
    """
    c = F.regexp_replace(_c(col), WRITTEN_ZONE, "$1")
    utc_text = F.concat(c, F.lit("+00:00"))
    shapes = [(p, pattern_shape(p)) for p in patterns]
    # one parser call: the pattern is chosen by the text's shape (shapes of two patterns may meet, the first then counts)
    chosen = F.coalesce(*[F.when(c.rlike(s), F.lit(p + "XXX")) for p, s in shapes if s], F.lit(None).cast("string"))
    parsed = [F.when(chosen.isNotNull(), F.try_to_timestamp(utc_text, chosen))]
    parsed += [F.try_to_timestamp(utc_text, F.lit(p + "XXX")) for p, s in shapes if not s]
    micros = F.unix_micros(F.coalesce(*parsed))
    if convert_zone:
        zone = F.regexp_extract(_c(col), r":\d{2}(?:\.\d+)?\s*([+-]\d{2}):?(\d{2})$", 1)
        rest = F.regexp_extract(_c(col), r":\d{2}(?:\.\d+)?\s*([+-]\d{2}):?(\d{2})$", 2)
        sign = F.when(zone.startswith("-"), -1).otherwise(1)
        minutes = F.abs(zone.try_cast("int")) * 60 + rest.try_cast("int")
        micros = micros - F.coalesce(sign * minutes, F.lit(0)).cast("bigint") * 60_000_000
    return add_micros(F.expr(EPOCH_NTZ), micros)


def try_convert(df: DataFrame, columns: list[str], patterns: tuple[str, ...] = DEFAULT_PATTERNS) -> DataFrame:
    """TRY_CONVERT(datetime, col, style) for each listed column; the column type changes."""
    return df.withColumns({c: parse_timestamp(F.col(f"`{c}`"), patterns) for c in columns})


def add_micros(ts: Column, micros: Column) -> Column:
    """timestamp_ntz plus a number of microseconds (zone independent)."""
    return F.timestamp_add("MICROSECOND", micros.cast("bigint"), ts)


def epoch_millis_to_ts(col: Column | str) -> Column:
    return F.timestamp_add("MILLISECOND", _c(col).cast("bigint"), F.expr(EPOCH_NTZ))


def ts_to_epoch_micros(col: Column | str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.expr(EPOCH_NTZ), _c(col).cast("timestamp_ntz"))


def ts_to_epoch_millis(col: Column | str) -> Column:
    """Epoch milliseconds of a timestamp_ntz, truncating microseconds."""
    return F.floor(ts_to_epoch_micros(col) / F.lit(1000)).cast("bigint")


def from_epoch_millis(df: DataFrame, columns: list[str] | None = None, mark: str = "date") -> DataFrame:
    """Epoch-millisecond columns to timestamps.

    Without an explicit list: every column whose name contains ``mark``
    (case-insensitive) and that is numeric, or that holds nothing but NULLs whatever
    its type, is converted (text columns are looked at in one aggregate job).
    """
    from pyspark.sql import types as T

    if columns is None:
        columns = []
        texts = [f.name for f in df.schema.fields if mark.lower() in f.name.lower() and isinstance(f.dataType, (T.StringType, T.BooleanType))]
        if texts:
            full = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(texts)]).first()
            columns += [c for i, c in enumerate(texts) if full[i] == 0]
            df = df.withColumns({c: F.lit(None).cast("bigint") for c in columns})
        for f in df.schema.fields:
            if mark.lower() in f.name.lower() and f.name not in columns and isinstance(
                    f.dataType, (T.IntegerType, T.LongType, T.ShortType, T.DoubleType, T.FloatType,
                                 T.DecimalType, T.NullType)):
                columns.append(f.name)
    return df.withColumns({c: epoch_millis_to_ts(F.col(f"`{c}`")) for c in columns})


def from_cyyddd(col: Column | str) -> Column:
    """Century-digit ordinal date ``1yyddd`` to a date; anything else NULL.

    Two-digit years 69-99 are 19xx and 00-68 are 20xx; day 366 is valid
    only in leap years.
    """
    c = _c(col).cast("string")
    ok = c.rlike(r"^1[0-9]{5}$")
    yy = F.substring(c, 2, 2).try_cast("int")
    ddd = F.substring(c, 4, 3).try_cast("int")
    year = F.when(yy >= 69, yy + 1900).otherwise(yy + 2000)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    days_in_year = F.when(leap, 366).otherwise(365)
    valid = ok & (ddd >= 1) & (ddd <= days_in_year)
    jan1 = F.make_date(year, F.lit(1), F.lit(1))
    return F.when(valid, F.date_add(jan1, ddd - 1))


def day_floor(col: Column | str) -> Column:
    """Midnight of the day (timestamp_ntz), used to truncate high-water marks."""
    return F.to_date(_c(col)).cast("timestamp_ntz")


def time_of_day_micros(col: Column | str) -> Column:
    c = _c(col).cast("timestamp_ntz")
    return F.timestamp_diff("MICROSECOND", F.to_date(c).cast("timestamp_ntz"), c)


# dayofweek(): Sunday = 1 ... Saturday = 7
WEEKDAYS = {"sunday": 1, "monday": 2, "tuesday": 3, "wednesday": 4, "thursday": 5, "friday": 6, "saturday": 7}


def in_nth_weekday_window(col: Column | str, weekday: str = "tuesday", n: int = 3,
                          start: str = "20:00:00", end: str = "23:00:00") -> Column:
    """True when the timestamp is on the n-th given weekday of its month and
    its time of day is within [start, end] (both ends inclusive)."""

    def micros(hms: str) -> int:
        h, m, s = (hms.split(":") + ["0", "0"])[:3]
        return ((int(h) * 60 + int(m)) * 60 + int(float(s))) * 1_000_000

    c = _c(col)
    tod = time_of_day_micros(c)
    return ((F.dayofweek(c) == WEEKDAYS[weekday.lower()])
            & F.dayofmonth(c).between(7 * n - 6, 7 * n)
            & tod.between(micros(start), micros(end)))
