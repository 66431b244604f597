"""Captured pages of paged services, kept as a table.

A capture is a Parquet table with one row per page: loop value, chain, page number, link
and next link, row count, body (a JSON array of records) and, for each column
in ``zones``, the smallest and largest value on the page.  It lies on any file system
that Spark reads and is filled in waves:

* ``capture`` plans offset windows (per loop value), leaves out the pages that the
  table holds and fetches the rest inside tasks, ``wave`` pages at a time;
* ``follow`` walks cursor chains: each wave fetches at most ``pages`` pages of every
  open chain, one task per chain, from the chain's last next link on.

A wave joins the table as one whole (``wareloom.transactions``), so a capture that
breaks anywhere goes on with the first wave that is not there, and no record
comes twice.  The row count of a service is noted with the capture, so a resumed run
keeps its plan.  A stream can consume the capture while it grows
(``readStream`` on the table's folder); a data source stream reader of its own could not
resume a chain, as its ``latestOffset`` is not told where the query stands.

``read`` parses the bodies.  Filters are first put to the zones, so the scan drops
row groups and pages that cannot match without parsing their bodies.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from wareloom import catalog
from wareloom.session import local_rows, ship_package
from wareloom.sources import paged

PAGE = "loop string, chain string, page bigint, link string, next string, rows bigint, body string"
COUNT = "wareloom.capture.count"
BLOCK_PAGES = 100
COMPARE = {"=": lambda c, v: c == v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v,
           "in": lambda c, v: c.isin(*v)}


def _struct(schema: str) -> StructType:
    return _parse_datatype_string(schema)


def parsed(body: Column, schema: str) -> Column:
    return F.from_json(body, f"array<{_struct(schema).simpleString()}>", paged.JSON_OPTIONS)


def zoned(pages: DataFrame, schema: str, zones: list[str]) -> DataFrame:
    """Pages with ``min_<column>`` and ``max_<column>`` (NULL where a page has no value)."""
    held = pages.withColumn("__rows", parsed(F.col("body"), schema))
    values = lambda c: F.transform("__rows", lambda r: r[c])
    out = {}
    for c in zones:
        out[f"min_{c}"], out[f"max_{c}"] = F.array_min(values(c)), F.array_max(values(c))
    return held.withColumns(out).drop("__rows") if zones else held.drop("__rows")


def pages_of(df: DataFrame, order_col: str, size: int, chain_col: str | None = None, loop_col: str | None = None) -> DataFrame:
    """The rows of ``df`` as pages of ``size`` records in ``order_col`` order, per loop value or chain.

    A chain's pages are linked.  Positions come from one distributed sequence minus each
    group's first position, which the rows meet by group and block of positions, so no task holds a whole group; a page
    is put together from at most ``size`` rows.
    """
    from wareloom.operators.load import with_sequence_id

    group = chain_col or loop_col
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), paged.JSON_OPTIONS)
    base = df.select((F.col(group).cast("string") if group else F.lit("")).alias("g"), F.col(order_col).alias("o"), record.alias("record"))
    seq = with_sequence_id(base, "at", ["g", "o"], start=-1)
    if group:
        block = lambda at: F.floor(at / (BLOCK_PAGES * size))
        first = seq.groupBy("g").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
        first = first.withColumn("block", F.explode(F.sequence(block(F.col("first")), block(F.col("first") + F.col("n") - 1))))
        seq = seq.withColumn("block", block(F.col("at")))
        placed = seq.join(first, seq["g"].eqNullSafe(first["g"]) & (seq["block"] == first["block"])).drop(first["g"], first["block"])
    else:  # one group: its first position is 0, and no page is linked
        placed = seq.withColumns({"first": F.lit(0), "n": F.lit(None).cast("bigint")})
    placed = placed.withColumn("page", F.floor((F.col("at") - F.col("first")) / size))
    pages = placed.groupBy("g", "page", "n").agg(F.sort_array(F.collect_list(F.struct("o", "at", "record"))).alias("rs"))
    link = lambda page: F.concat_ws("/", F.col("g"), page.cast("string"))
    chained = F.lit(chain_col is not None)
    return pages.select(
        (F.col("g") if loop_col else F.lit(None).cast("string")).alias("loop"), F.when(chained, F.col("g")).alias("chain"), "page",
        F.when(chained, link(F.col("page"))).alias("link"), F.when(chained & ((F.col("page") + 1) * size < F.col("n")), link(F.col("page") + 1)).alias("next"),
        F.size("rs").cast("bigint").alias("rows"), F.concat(F.lit("["), F.array_join(F.transform("rs", lambda r: r["record"]), ","), F.lit("]")).alias("body"))


def create(spark: SparkSession, table: str, schema: str, zones: list[str]) -> None:
    """An empty capture table, where there is none."""
    if not catalog.exists(spark, table):
        catalog.publish(zoned(local_rows(spark, [], PAGE), schema, zones), table)


def add(pages: DataFrame, table: str, schema: str, zones: list[str]) -> None:
    """Add pages to a capture as one whole; pages that are near in number lie in the same files, so that zones prune well."""
    create(pages.sparkSession, table, schema, zones)
    catalog.publish(zoned(pages, schema, zones).sortWithinPartitions("loop", "chain", "page"), table, "append")


def _transport(options: dict, loop: str | None):
    if loop is None:
        return paged.transport(options)
    extra = json.loads(options.get("extra_params", "{}")) | {options["loop_param"]: loop}
    return paged.transport(options | {"extra_params": json.dumps(extra)})


def _fetch(options: dict, size: int):
    """Task: (loop, page, count) -> captured pages."""
    def run(frames):
        import pandas as pd

        for plan in frames:
            for loop, page, count in plan.itertuples(index=False):
                loop = None if loop is None or loop != loop else loop
                source, first, recs = _transport(options, loop), page * size, []
                planned = min(size, count - first)
                while len(recs) < planned:  # a service may answer fewer rows than asked
                    got = source.fetch(first + len(recs), planned - len(recs))
                    if not got:
                        raise RuntimeError(f"rows {first} to {first + planned - 1} were planned, but the service gave {len(recs)} of them")
                    recs += got
                yield pd.DataFrame({"loop": [loop], "chain": [None], "page": [page], "link": [None], "next": [None], "rows": [len(recs)],
                                    "body": ["[" + ",".join(map(paged._as_text, recs)) + "]"]})

    return run


def _options(options: dict) -> dict:
    return {k: json.dumps(v) if isinstance(v, (list, dict)) else str(v) for k, v in options.items()}


def capture(spark: SparkSession, table: str, schema: str, zones: list[str] = (), page_size: int = paged.DEFAULT_PAGE_SIZE, wave: int = 1000,
            loop_values: list[str] | None = None, **options) -> int:
    """Fetch the pages that ``table`` lacks; returns how many waves were added."""
    ship_package(spark)
    create(spark, table, schema, zones)
    plain, waves = _options(options), 0
    for loop in loop_values or [None]:
        note = f"{COUNT}.{loop or ''}"
        noted = catalog.get_property(spark, table, note)
        if noted is None:
            noted = str(_transport(plain, loop).count())
            catalog.set_property(spark, table, note, noted)
        count = int(noted)
        for begin in range(0, math.ceil(count / page_size), wave):
            end = min(begin + wave, math.ceil(count / page_size))
            there = spark.table(table).where(F.col("loop").eqNullSafe(F.lit(loop)) & F.col("page").between(begin, end - 1)).select("page")
            todo = spark.range(begin, end).withColumnRenamed("id", "page").join(there, "page", "left_anti")
            if todo.isEmpty():
                continue
            plan = todo.select(F.lit(loop).cast("string").alias("loop"), "page", F.lit(count).cast("bigint").alias("count"))
            tasks = min(end - begin, 4 * spark.sparkContext.defaultParallelism)
            add(plan.repartition(tasks, "page").mapInPandas(_fetch(plain, page_size), PAGE), table, schema, list(zones))
            waves += 1
    return waves


def _walk(options: dict, pages: int):
    """Task: (chain, page, link) -> the next pages of the chain."""
    def run(frames):
        import pandas as pd

        for open_ in frames:
            for chain, page, link in open_.itertuples(index=False):
                source = paged.transport(options)
                for _ in range(pages):
                    recs, after = source.follow(link)
                    yield pd.DataFrame({"loop": [None], "chain": [chain], "page": [page], "link": [link], "next": [after], "rows": [len(recs)],
                                        "body": ["[" + ",".join(map(paged._as_text, recs)) + "]"]})
                    if not after:
                        break
                    page, link = page + 1, after

    return run


def open_chains(spark: SparkSession, table: str, starts: dict[str, str] | DataFrame) -> DataFrame:
    """(chain, page, link): where each chain that has not ended goes on; ``starts`` maps chains to first links."""
    if isinstance(starts, dict):
        starts = local_rows(spark, list(starts.items()), "chain string, link string")
    last = spark.table(table).where("chain is not null").groupBy("chain").agg(F.max_by(F.struct("page", "next"), "page").alias("last"))
    at = starts.join(last, "chain", "left")
    goes_on = F.coalesce(F.col("last.next"), F.when(F.col("last").isNull(), F.col("link")))
    return at.select("chain", F.coalesce(F.col("last.page") + 1, F.lit(0)).cast("bigint").alias("page"), goes_on.alias("link")).where("link is not null")


def follow(spark: SparkSession, table: str, schema: str, starts: dict[str, str] | DataFrame, zones: list[str] = (), pages: int = 100, **options) -> int:
    """Walk every chain to its end, ``pages`` pages a wave; returns how many waves were added."""
    ship_package(spark)
    create(spark, table, schema, zones)
    waves = 0
    while not (todo := open_chains(spark, table, starts)).isEmpty():
        links = spark.table(table).select("chain", "link")
        again = todo.join(links, ["chain", "link"], "left_semi").first()
        if again is not None:
            raise RuntimeError(f"the chain {again['chain']} comes back to {again['link']}")
        tasks = 4 * spark.sparkContext.defaultParallelism
        add(todo.repartition(tasks, "chain").mapInPandas(_walk(_options(options), pages), PAGE), table, schema, list(zones))
        waves += 1
    return waves


def _zone_test(column: str, op: str, value) -> Column:
    """Whether a page may hold a row that passes; NULL zones (no values) do not."""
    lo, hi = F.col(f"min_{column}"), F.col(f"max_{column}")
    if op == "in":
        tests = [(lo <= v) & (hi >= v) for v in value]
        return F.lit(False) if not tests else F.coalesce(*[F.when(t, True) for t in tests], F.lit(False))
    return {"=": (lo <= value) & (hi >= value), ">": hi > value, ">=": hi >= value, "<": lo < value, "<=": lo <= value}[op]


def pages(spark: SparkSession, table: str, filters: list[tuple] = (), loops: list[str] | None = None) -> DataFrame:
    """The pages that may hold rows passing ``filters`` (column, op, value), by their zones."""
    out = spark.table(table)
    if loops is not None:
        out = out.where(F.col("loop").isin(*loops) if loops else F.lit(False))
    for column, op, value in filters:
        if f"min_{column}" in out.columns:
            out = out.where(_zone_test(column, op, value))
    return out


def read(spark: SparkSession, table: str, schema: str, filters: list[tuple] = (), loops: list[str] | None = None, loop_column: str | None = None) -> DataFrame:
    """The records of a capture that pass ``filters``, as columns of ``schema`` (and the loop value)."""
    held = pages(spark, table, filters, loops)
    rows = held.select("loop", F.explode(parsed(F.col("body"), schema)).alias("r"))
    for column, op, value in filters:
        rows = rows.where(COMPARE[op](F.col("r")[column], value))
    return rows.select("r.*", *([F.col("loop").alias(loop_column)] if loop_column else []))


def incomplete(spark: SparkSession, table: str) -> DataFrame:
    """(chain, next): links that a captured page names but the capture does not hold."""
    held = spark.table(table).where("chain is not null")
    return held.where("next is not null").select("chain", F.col("next").alias("link")).join(held.select("chain", "link"), ["chain", "link"], "left_anti")
