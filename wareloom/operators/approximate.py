"""Approximate address lookup: the nearest locator address within an edit distance.

Addresses are compared in their normalised form (``enrich.address_key``).  Candidates
meet in an equi-join; Levenshtein distance confirms them.  Every pair within the distance
is found.  There are two kinds of join keys:

* what is left of a text after deleting up to ``distance`` characters: of two texts within that
  many edits, both can be cut to one common rest.  Texts that share one are near to each other as wholes, so a
  common part (streets' kinds, towns, the digits of many numbers) makes no candidates, however many addresses there are;
* grams, for long texts or many edits, where there would be more than ``RESTS`` such rests to an address.  Two texts
  within ``distance`` edits differ in at most ``GRAM * distance`` of their distinct grams of ``GRAM`` characters, so
  when both keep only their ``GRAM * distance + 1`` rarest grams (in one order for all: locator count, then text), they still share one.

``geocode`` wants the nearest only: it looks for exact matches first, then within one edit for the addresses that are left,
then within two, and so on.  Of the nearest candidates the higher score wins, then the smaller
coordinates.  Addresses with too few grams for the rule above match exactly only, and those without
an address match nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wareloom.operators.enrich import address_key, best_candidates
from wareloom.operators.load import spread
from wareloom.session import cut_lineage, ship_package

GRAM = 3
RESTS = 1000
RESTS_PER_TASK = 2_000_000


def _cut(key: Column) -> Column:
    """The distinct grams; the text's ends are marked, so that they make grams of their own."""
    padded = F.concat(F.lit("^^"), key, F.lit("$$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - (GRAM - 1)), lambda i: F.substr(padded, i, F.lit(GRAM))))


def _rarest(grams: DataFrame, counts: DataFrame, keep: int) -> DataFrame:
    """(id, gram): the ``keep`` rarest grams of each key."""
    ranked = grams.join(counts, "gram", "left").select("id", F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram").alias("g"))
    first = ranked.groupBy("id").agg(F.slice(F.sort_array(F.collect_list("g")), 1, keep).alias("gs"))  # at most the grams of one address
    return first.select("id", F.explode("gs").alias("g")).select("id", F.col("g.gram").alias("gram"))


def _by_grams(one: DataFrame, two: DataFrame, distance: int) -> DataFrame:
    keep = GRAM * distance + 1
    one, two = (cut_lineage(x.select("id", F.explode(_cut(F.col("key"))).alias("gram")), "grams") for x in (one, two))
    counts = two.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    return _rarest(one, counts, keep).join(_rarest(two, counts, keep).withColumnRenamed("id", "near_id"), "gram")


def _n_rests(length: Column, distance: int) -> Column:
    """How many ways there are to delete up to ``distance`` characters."""
    ways, total = F.lit(1.0), F.lit(1.0)
    for d in range(distance):
        ways = ways * F.greatest(length - d, F.lit(0)) / (d + 1)
        total = total + ways
    return total


def _rests(distance: int, name: str):
    """Task: (id, key) -> (``name``, rest), the hashes of what is left of a key after deleting up to ``distance`` characters.

    A text's hash is the sum of its characters' numbers times powers of ``base``, so a rest's is put together from prefix
    sums, for all keys of a length at once.  Of equal neighbours the first are deleted, as the rest is the same.
    """
    def run(frames):
        import itertools
        import math

        import numpy as np
        import pandas as pd

        base = np.uint64(0x9E3779B97F4A7C15)
        back = np.array([pow(int(base), -1, 2**64)], dtype=np.uint64)
        for frame in frames:
            for length, keys in frame.groupby(frame["key"].str.len()):
                places = [np.array(list(itertools.combinations(range(length), d)), dtype=np.int64).reshape(math.comb(length, d), d) for d in range(min(distance, length) + 1)]
                for a in range(0, len(keys), step := max(1, 1_000_000 // sum(map(len, places)))):
                    part = keys.iloc[a : a + step]
                    codes = np.frombuffer("".join(part["key"]).encode("utf-32-le"), dtype="<u4").reshape(len(part), length)
                    mixed = (codes + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
                    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.cumprod(np.full(length, base))
                    sums = np.concatenate([np.zeros((len(part), 1), np.uint64), np.cumsum(mixed, axis=1)], axis=1)
                    same = np.concatenate([np.zeros((len(part), 1), bool), codes[:, 1:] == codes[:, :-1]], axis=1)
                    for at in places:
                        total, begin, shift, first = 0, np.zeros(len(at), np.int64), np.ones(1, np.uint64), np.ones((len(part), len(at)), bool)
                        for d in range(at.shape[1]):
                            i = at[:, d]
                            total = total + (sums[:, i] - sums[:, begin]) * shift
                            first &= ~same[:, i] | ((begin == i) & (d > 0))
                            begin, shift = i + 1, shift * back
                        total = total + (sums[:, [length]] - sums[:, begin]) * shift
                        row, _ = np.nonzero(first)
                        yield pd.DataFrame({name: part["id"].to_numpy()[row], "rest": total[first].view(np.int64)})

    return run


def _by_rests(one: DataFrame, two: DataFrame, distance: int, tasks: int) -> DataFrame:
    def cut(keys, name):
        rests = keys.select("id", "key").repartition(tasks, "id").mapInPandas(_rests(distance, name), f"{name} bigint, rest bigint")
        return rests.repartition(tasks, "rest")

    ship_package(one.sparkSession)
    return cut(two, "near_id").join(cut(one, "id").hint("shuffle_hash"), "rest")


def _candidates(one: DataFrame, two: DataFrame, distance: int) -> DataFrame:
    """(id, near_id): pairs that share a rest or, where there would be too many rests, a rare gram; repeated."""
    n, rests = one.unionByName(two).agg(F.count(F.lit(1)), F.sum(_n_rests(F.col("length"), distance))).first()
    if n and rests > RESTS * n:
        return _by_grams(one, two, distance)
    return _by_rests(one, two, distance, max(int(one.sparkSession.conf.get("spark.sql.shuffle.partitions")), int((rests or 0) // RESTS_PER_TASK)))


def _keys(addresses: DataFrame, locator: DataFrame) -> DataFrame:
    """The distinct keys of both, numbered: (id, key, length, grams, asked, placed)."""
    flagged = lambda df, asked: df.where("key is not null").select("key", F.lit(asked).alias("asked"), F.lit(not asked).alias("placed"))
    keys = flagged(addresses, True).unionByName(flagged(locator, False)).groupBy("key").agg(F.max("asked").alias("asked"), F.max("placed").alias("placed"))
    keys = keys.withColumns({"length": F.length("key"), "grams": F.size(_cut(F.col("key"))), "id": F.monotonically_increasing_id()})
    return cut_lineage(keys, "address-keys")


def _exact(keys: DataFrame) -> DataFrame:
    return keys.where("asked and placed").select("key", F.col("key").alias("near"), F.lit(0).alias("edits"))


def _close(keys: DataFrame, distance: int, grams: int) -> DataFrame:
    """(key, near, edits) for the pairs of different keys within ``distance`` edits, both of ``grams`` distinct grams at least."""
    able = keys.where(F.col("grams") >= grams)
    reach = lambda side: able.where(side).select(F.explode(F.sequence(F.col("length") - distance, F.col("length") + distance)).alias("length")).distinct()
    one, two = (able.where(side).join(reach(other), "length", "left_semi") for side, other in (("asked", "placed"), ("placed", "asked")))  # lengths are few
    pairs = _candidates(one, two, distance).where("id <> near_id").select("id", "near_id").distinct()
    pairs = pairs.join(one.select("id", "key"), "id").join(two.select(F.col("id").alias("near_id"), F.col("key").alias("near")), "near_id")
    edits = F.levenshtein("key", "near", distance)  # -1 beyond it
    return pairs.where(F.abs(F.length("key") - F.length("near")) <= distance).select("key", "near", edits.alias("edits")).where("edits >= 0")


def nearest(addresses: DataFrame, locator: DataFrame, distance: int = 2) -> DataFrame:
    """(key, near, edits) for all pairs of distinct keys of ``addresses`` (key) and ``locator`` (key) within ``distance`` edits."""
    keys = _keys(addresses, locator)
    return _close(keys, distance, GRAM * distance + 1).unionByName(_exact(keys))


def _first(addresses: DataFrame, locator: DataFrame, distance: int) -> DataFrame:
    """``nearest``, but of each address only the pairs with the fewest edits."""
    keys = _keys(addresses, locator)
    found = [_exact(keys)]
    left = keys.withColumn("asked", F.expr("asked and not placed"))
    for d in range(1, distance + 1):
        found.append(cut_lineage(_close(left, d, GRAM * distance + 1), "near-addresses"))
        done = found[-1].select("key", F.lit(True).alias("done")).distinct()
        left = left.join(done, "key", "left").withColumn("asked", F.expr("asked and done is null")).drop("done")
    return reduce(DataFrame.unionByName, found)


def geocode(df: DataFrame, locator: DataFrame, address_col: str = "FULL_ADDRESS", score: str = "score", x: str = "longitude", y: str = "latitude",
            distance: int = 2) -> DataFrame:
    """Left join each row to the nearest locator address: x, y, score and ``edits`` (NULL when none is near enough)."""
    best = cut_lineage(best_candidates(locator.where(F.col(address_col).isNotNull()), address_col, score, x, y), "locator")
    asked = df.where(F.col(address_col).isNotNull()).select(address_key(address_col).alias("key"))
    found = _first(asked, best.select(F.col("__key").alias("key")), distance)
    placed = found.join(best, F.col("near") == F.col("__key"))
    rank = F.struct(F.col("edits"), -F.col(score), F.col(x), F.col(y))
    first = placed.groupBy("key").agg(F.min_by(F.struct(x, y, score, "edits"), rank).alias("b"))
    first = first.select(F.struct("key", F.lit(0).cast("bigint").alias("salt")).alias("__jk"), "b.*")
    salt = F.when(F.col(address_col).isNotNull(), F.lit(0).cast("bigint")).otherwise(spread(df))
    keyed = df.withColumn("__jk", F.struct(address_key(address_col).alias("key"), salt.alias("salt")))
    return keyed.join(first, "__jk", "left").drop("__jk")
