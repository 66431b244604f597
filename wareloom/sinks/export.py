"""Exports: CSV, GeoJSON features, typed extracts.

Files are written in parallel, one part per partition; a single file is
only produced when asked (``single_file``), via ``coalesce(1)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions import types as TY
from wareloom.functions.columns import snake_case


def csv(df: DataFrame, path: str, null_value: str = "NA", header: bool = True, snake_header: bool = False,
        row_numbers_by: list[str] | None = None, single_file: bool = False, sep: str = ",") -> None:
    """CSV with an explicit NULL marker ('NA' or '' - distinct from an empty string)."""
    out = df
    if snake_header:
        out = out.toDF(*[snake_case(c) for c in out.columns])
    if row_numbers_by:
        from wareloom.operators.load import with_sequence_id
        out = with_sequence_id(out, "row_name", row_numbers_by, 0).select("row_name", *out.columns)
    if single_file:
        out = out.coalesce(1)
    (out.write.mode("overwrite").option("header", header).option("sep", sep)
     .option("nullValue", null_value).option("emptyValue", '""').option("quote", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)  # values as they are
     .option("escape", '"').csv(path))


def feature_json(df: DataFrame, lon: str, lat: str, properties: list[str]) -> Column:
    """One GeoJSON point Feature per row as JSON text; NULL properties are kept."""
    geom = F.struct(F.lit("Point").alias("type"),
                    F.array(F.col(lon).cast("double"), F.col(lat).cast("double")).alias("coordinates"))
    props = F.struct(*[F.col(f"`{p}`") for p in properties])
    feat = F.struct(F.lit("Feature").alias("type"), geom.alias("geometry"), props.alias("properties"))
    return F.to_json(feat, {"ignoreNullFields": "false"})


def geojson_features(df: DataFrame, lon: str, lat: str, properties: list[str]) -> DataFrame:
    """Rows with a first coordinate, as point features (column ``feature``)."""
    return df.where(F.col(lon).isNotNull()).select(feature_json(df, lon, lat, properties).alias("feature"))


def geojson_lines(df: DataFrame, path: str, lon: str, lat: str, properties: list[str]) -> None:
    geojson_features(df, lon, lat, properties).write.mode("overwrite").text(path)


def extract_types(df: DataFrame, columns: list[str] | None = None, float_cols: list[str] | None = None) -> DataFrame:
    """Typed projection of a BI extract in ONE select: integral and listed
    columns to double, date/datetime to naive timestamps, zones stripped."""
    if columns:
        df = df.select(*[F.col(f"`{c}`") for c in columns])
    extra = set(float_cols or [])
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, TY.INTEGRAL) or f.name in extra:
            cols.append(c.try_cast("double").alias(f.name))
        elif isinstance(f.dataType, T.TimestampType):
            cols.append(TY.strip_zone_expr(c).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            cols.append(c.try_cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


# extract modes of the original BI job and their Spark save modes
EXTRACT_MODES = {"overwrite": "overwrite", "append": "append", "create": "errorifexists"}


def extract(df: DataFrame, path: str, mode: str = "overwrite", columns: list[str] | None = None,
            float_cols: list[str] | None = None) -> None:
    """Write a typed extract (Parquet): ``overwrite``, ``append`` (types stay
    consistent across runs because every run goes through the same typed
    projection) or ``create`` (fails if the extract exists)."""
    extract_types(df, columns, float_cols).write.mode(EXTRACT_MODES[mode]).parquet(path)


def _collection(batches):
    """Task: a partition's features as the lines of one FeatureCollection document."""
    import pyarrow as pa

    line = lambda texts: pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["value"])
    yield line(['{"type":"FeatureCollection","features":['])
    first = True
    for batch in batches:
        texts = batch.column(0).to_pylist()
        if texts:
            yield line([("" if first and i == 0 else ",") + t for i, t in enumerate(texts)])
            first = False
    yield line(["]}"])


def geojson(df: DataFrame, path: str, lon: str, lat: str, properties: list[str], single_file: bool = False) -> None:
    """GeoJSON documents: every part file is a FeatureCollection of its rows (rows without a coordinate are left out)."""
    out = geojson_features(df, lon, lat, properties)
    out = (out.coalesce(1) if single_file else out).mapInArrow(_collection, "value string")
    out.write.mode("overwrite").text(path)
