"""GeoJSON FeatureCollection pages -> attribute columns + geometry text.

Each file is one FeatureCollection (a page of a GIS service).  Declaring
``properties`` and ``geometry`` as strings makes the JSON reader keep their
raw JSON text; geometry types nest differently, so each type is parsed on
its own later (``functions.geo.to_wkt``) instead of inferring one schema.
Files are read in parallel, one task per file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions import dates as D
from wareloom.functions import geo as G

COLLECTION_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("properties", T.StringType()),
        T.StructField("geometry", T.StringType()),
    ]))),
])


def features(spark: SparkSession, path: str, properties_schema: T.StructType | str) -> DataFrame:
    """One row per feature: properties as columns plus ``geometry`` (GeoJSON text)."""
    coll = spark.read.schema(COLLECTION_SCHEMA).option("multiLine", True).json(path)
    f = coll.select(F.explode("features").alias("f"))
    props = F.from_json(F.col("f.properties"), properties_schema)
    return f.select(props.alias("p"), F.col("f.geometry").alias("geometry")).select("p.*", "geometry")


def standard_fixes(df: DataFrame, int_cols: list[str] | None = None, float_cols: list[str] | None = None,
                   date_cols: list[str] | None = None) -> DataFrame:
    """The layer fixes in one projection: epoch-ms dates, int / float coercion,
    geometry to ``geometry_wkt``."""
    out = D.from_epoch_millis(df, date_cols)
    if int_cols:
        from wareloom.functions.types import safe_cast

        out = out.withColumns({c: safe_cast(F.col(c), "int") for c in int_cols})
    if float_cols:
        out = out.withColumns({c: F.col(c).try_cast("double") for c in float_cols})
    if "geometry" in out.columns:
        out = G.geometry_to_wkt(out, "geometry", "geometry_wkt")
    return out


def write_feature_pages(df: DataFrame, path: str, id_col: str, page_size: int, properties: list[str],
                        geometry: str = "geometry") -> None:
    """Write rows as FeatureCollection files of ``page_size`` features (by id order).

    Each page is assembled by one group of at most ``page_size`` rows, so no
    group grows with the table.
    """
    feat = F.concat(
        F.lit('{"type":"Feature","properties":'),
        F.to_json(F.struct(*[F.col(p) for p in properties]), {"ignoreNullFields": "false"}),
        F.lit(',"geometry":'), F.coalesce(F.col(geometry), F.lit("null")), F.lit("}"))
    pages = (df.select(F.floor(F.col(id_col) / page_size).alias("page"), F.col(id_col).alias("__id"), feat.alias("f"))
             .groupBy("page")
             .agg(F.sort_array(F.collect_list(F.struct("__id", "f"))).alias("fs")))
    text = F.concat(F.lit('{"type":"FeatureCollection","features":['),
                    F.array_join(F.transform("fs", lambda s: s["f"]), ","), F.lit("]}"))
    pages.select("page", text.alias("value")).write.mode("overwrite").partitionBy("page").text(path)
