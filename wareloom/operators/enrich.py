"""Address enrichment: pending rows, locator lookups, failure lists, region lookups.

* ``pending`` / ``not_attempted`` are anti joins on the id (no ``NOT IN``,
  which plans as a null-aware broadcast-only anti join).  A NULL source id
  never matches, so such rows stay pending (documented choice).
* ``geocode`` pre-aggregates the locator to its best candidate per address
  key (``max_by``, partial aggregation) BEFORE joining, so the join is
  one-to-at-most-one and no window runs over joined rows.
* ``with_client`` calls a user geocoding client once per distinct address,
  batched per partition with ``mapInPandas``; ``answers`` keeps what it said in a
  table, across runs and failures.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WAVES = 100


def address(df: DataFrame, sql_expr: str, name: str = "FULL_ADDRESS") -> DataFrame:
    """Computed address column from SQL text (use concat_ws: NULL parts become empty)."""
    return df.withColumn(name, F.expr(sql_expr))


def address_key(col: Column | str) -> Column:
    """Normalised matching key: trimmed, single-spaced, upper case."""
    c = F.col(col) if isinstance(col, str) else col
    return F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))


def pending(source: DataFrame, geocoded: DataFrame, id_col: str = "id", address_col: str = "FULL_ADDRESS") -> DataFrame:
    """Rows of ``source`` whose id is not yet in ``geocoded``, distinct (id, address)."""
    from wareloom.operators.load import anti_by_key

    return anti_by_key(source, geocoded, [id_col]).dropDuplicates([id_col, address_col])


def failures(geocoded: DataFrame, lat_col: str = "latitude", where: str | None = None) -> DataFrame:
    out = geocoded.where(F.col(lat_col).isNull())
    return out.where(F.expr(where)) if where else out


def not_attempted(failed: DataFrame, attempted: DataFrame, id_col: str = "id") -> DataFrame:
    """Failures whose id is not among earlier attempts."""
    from wareloom.operators.load import anti_by_key

    return anti_by_key(failed, attempted, [id_col])


def best_candidates(locator: DataFrame, address_col: str = "FULL_ADDRESS", score: str = "score",
                    x: str = "longitude", y: str = "latitude") -> DataFrame:
    """One best candidate per address key: highest score, then smallest x, y."""
    rank = F.struct(F.col(score), -F.col(x), -F.col(y))
    best = (locator.withColumn("__key", address_key(address_col))
            .groupBy("__key")
            .agg(F.max_by(F.struct(F.col(x).alias(x), F.col(y).alias(y), F.col(score).alias(score)), rank).alias("__b")))
    return best.select("__key", F.col("__b")[x].alias(x), F.col("__b")[y].alias(y), F.col("__b")[score].alias(score))


def geocode(df: DataFrame, locator: DataFrame, address_col: str = "FULL_ADDRESS", score: str = "score",
            x: str = "longitude", y: str = "latitude") -> DataFrame:
    """Left join each row to the best locator candidate of its address (NULL when none)."""
    from wareloom.operators.load import spread

    # join on struct(key, salt): the best-candidate aggregate is then re-shuffled
    # instead of feeding the join directly, which lets AQE split a partition
    # that one very frequent address makes huge; a NULL address matches nothing
    # (the locator side has none, and rows without one are spread by a salt)
    best = best_candidates(locator.where(F.col(address_col).isNotNull()), address_col, score, x, y)
    best = best.withColumn("__jk", F.struct("__key", F.lit(0).cast("bigint").alias("__salt"))).drop("__key")
    salt = F.when(F.col(address_col).isNotNull(), F.lit(0).cast("bigint")).otherwise(spread(df))
    keyed = df.withColumn("__jk", F.struct(address_key(address_col).alias("__key"), salt.alias("__salt")))
    return keyed.join(best, "__jk", "left").drop("__jk")


def misses(geocoded: DataFrame, source: DataFrame, id_col: str, geo_cols: list[str], source_cols: list[str],
           lat_col: str = "latitude", where: str | None = None) -> DataFrame:
    """Failure listing: geocoded rows without latitude, joined to source columns.

    The NULL-latitude filter sits below the join (Catalyst pushes it into the
    geocoded scan), the optional user condition above it.
    """
    g = geocoded.where(F.col(lat_col).isNull()).select(id_col, *[c for c in geo_cols if c != id_col])
    s = source.select(id_col, *[c for c in source_cols if c != id_col])
    out = g.join(s, id_col, "left")
    return out.where(F.expr(where)) if where else out


def lookup(df: DataFrame, dim: DataFrame, on: list[str] | str, how: str = "left") -> DataFrame:
    """Dimension lookup join, without a hint: AQE broadcasts a dimension that it measured to be small."""
    return df.join(dim, on, how)


def join_back(df: DataFrame, results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Attach enrichment results by (id, FULL_ADDRESS), keeping unmatched rows."""
    return df.join(results, keys or ["id", "FULL_ADDRESS"], "left")


def _ask(client_factory: Callable[[], Callable], x: str, y: str, batch: int):
    """Task: addresses (key, text) -> answers, ``batch`` addresses to a call."""
    def run(batches):
        import pandas as pd

        client = client_factory()
        for frame in batches:
            for a in range(0, len(frame), batch):
                pdf = frame.iloc[a : a + batch]
                got = client(list(pdf["address"]))
                if len(got) != len(pdf):
                    raise ValueError(f"the client gave {len(got)} answers to {len(pdf)} addresses")
                yield pd.DataFrame({"key": pdf["key"], "address": pdf["address"], x: pd.array([None if g is None else g[0] for g in got], dtype="Float64"),
                                    y: pd.array([None if g is None else g[1] for g in got], dtype="Float64")})

    return run


def answers(df: DataFrame, client_factory: Callable[[], Callable], store: str, address_col: str = "FULL_ADDRESS", x: str = "longitude", y: str = "latitude",
            in_flight: int = 8, wave: int = 10_000, batch: int = 100) -> int:
    """Ask for the addresses of ``df`` that the table ``store`` has no answer to; returns how many waves were asked.

    ``store`` (key, address, x, y) is keyed by the normalised address (``address_key``); an answer without a place is kept too.
    At most ``in_flight`` tasks ask at a time.  Each wave's answers join the store as one whole before the
    next wave is asked, so a run that fails has lost one wave at most, and a rerun asks only what is left.
    A wave is ``wave`` addresses, or of more than ``WAVES`` times as many a share of ``1 / WAVES``: what a wave costs
    besides its calls is then paid a bounded number of times.  Each wave reads its own part of the addresses only.
    """
    from wareloom import catalog
    from wareloom.session import cut_lineage, local_rows, scratch_path, ship_package

    spark = df.sparkSession
    ship_package(spark)
    schema = f"key string, address string, {x} double, {y} double"
    if not catalog.exists(spark, store):
        catalog.publish(local_rows(spark, [], schema), store)
    asked = df.where(F.col(address_col).isNotNull()).groupBy(address_key(address_col).alias("key")).agg(F.min(address_col).alias("address"))
    todo = cut_lineage(asked.join(spark.table(store).select("key"), "key", "left_anti"), "addresses")
    n = todo.count()
    waves = min(-(-n // wave), WAVES)
    if not waves:
        return 0
    path, tasks = scratch_path(spark, "waves"), min(in_flight, -(-n // (waves * batch)))  # no more tasks than calls
    todo.withColumn("wave", F.pmod(F.xxhash64("key"), F.lit(waves))).repartition(waves, "wave").write.partitionBy("wave").parquet(path)
    held = spark.read.schema("key string, address string, wave bigint").parquet(path)
    for w in range(waves):
        got = held.where(F.col("wave") == w).drop("wave").repartition(tasks).mapInPandas(_ask(client_factory, x, y, batch), schema)
        catalog.publish(got.hint("rebalance"), store, "append")  # a few files to a wave, not one of each task
    return waves


def with_client(df: DataFrame, client_factory: Callable[[], Callable], address_col: str = "FULL_ADDRESS",
                x: str = "longitude", y: str = "latitude", parallelism: int | None = None, store: str | None = None) -> DataFrame:
    """Geocode through a user client: ``client_factory()`` is called once per
    partition and returns ``f(list[str]) -> list[(x, y) | None]``.

    With ``store`` the answers are taken from that table, which ``answers`` fills first with what it
    lacks.  Without it only distinct addresses are sent, spread over ``parallelism`` tasks (default: the shuffle
    partitions), and the answers are kept as a table in the shared scratch folder, so
    later uses of the result do not call the service again.
    """
    from wareloom.operators.load import spread
    from wareloom.session import cut_lineage, ship_package

    spark = df.sparkSession
    tasks = parallelism or int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.when(F.col(address_col).isNotNull(), F.lit(0).cast("bigint")).otherwise(spread(df))  # rows without an address are spread
    if store:
        answers(df, client_factory, store, address_col, x, y, in_flight=tasks)
        held, key = spark.table(store).drop("address"), address_key(address_col)
    else:
        ship_package(spark)
        addrs = df.select(F.col(address_col).alias("key"), F.col(address_col).alias("address")).where("key is not null").distinct().repartition(tasks, "key")
        held, key = cut_lineage(addrs.mapInPandas(_ask(client_factory, x, y, 10_000), f"key string, address string, {x} double, {y} double"), "geocoded").drop("address"), F.col(address_col)
    held = held.select(F.struct("key", F.lit(0).cast("bigint").alias("salt")).alias("__jk"), x, y)
    return df.withColumn("__jk", F.struct(key.alias("key"), salt.alias("salt"))).join(held, "__jk", "left").drop("__jk")


def run(source: DataFrame, geo_table: str, geocoder: Callable[[DataFrame], DataFrame], id_col: str = "id",
        address_col: str = "FULL_ADDRESS", incremental: bool = True) -> str:
    """Load geocodes into ``geo_table``: only pending rows and append when
    incremental (and the table exists), else geocode all and overwrite;
    nothing is written when no row is pending (one short ``isEmpty`` job).
    Rows with a NULL id are geocoded by a full load only: as they match no
    loaded row, every incremental run would append them again."""
    from wareloom import catalog

    spark = source.sparkSession
    if incremental and catalog.exists(spark, geo_table):
        known = source.where(F.col(id_col).isNotNull())
        todo, mode = pending(known, spark.table(geo_table), id_col, address_col), "append"
    else:
        todo, mode = source.dropDuplicates([id_col, address_col]), "overwrite"
    if todo.isEmpty():
        return "nothing to geocode"
    catalog.publish(geocoder(todo), geo_table, mode)
    return f"{mode} {geo_table}"
