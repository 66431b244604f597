"""Delimited text and raw-byte files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wareloom.functions.text import cp1252_fix


def delimited(spark: SparkSession, path: str, sep: str = "\t", header: bool = True,
              schema: T.StructType | str | None = None, null_value: str | None = None,
              encoding: str | None = None, quote: str = '"', escape: str = '"',
              multi_line: bool = True) -> DataFrame:
    """CSV / delimited files (default tab).  Give a schema in production:
    inference is an extra pass over the data.  Quoted values may hold line breaks; as that makes
    every file one task, ``multi_line=False`` splits large files whose values have none."""
    r = spark.read.option("header", header).option("sep", sep).option("quote", quote).option("escape", escape)
    if multi_line:
        r = r.option("multiLine", True)
    if null_value is not None:
        r = r.option("nullValue", null_value)
    if encoding is not None:
        r = r.option("encoding", encoding)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.csv(path)


def delimited_cp1252(spark: SparkSession, path: str, **kw) -> DataFrame:
    """Delimited windows-1252 files: read as ISO-8859-1, then fix 0x80-0x9F."""
    df = delimited(spark, path, encoding="ISO-8859-1", **kw)
    return df.select(*[cp1252_fix(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, T.StringType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def listing(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """File listing (id, name, path, created, length) without reading contents.

    ``binaryFile`` skips the bytes when ``content`` is not selected.
    """
    df = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
          .option("recursiveFileLookup", recursive).load(root))
    full = F.col("path")
    name = F.regexp_extract(full, r"([^/]+)$", 1)
    folder = F.regexp_extract(full, r"^(.*)/[^/]+$", 1)
    return df.select(full.alias("id"), name.alias("name"), folder.alias("path"),
                     F.col("modificationTime").cast("timestamp_ntz").alias("created"), "length")
