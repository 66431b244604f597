"""States that add up, and addresses within an edit distance."""

import random

import pytest
from pyspark.sql import functions as F

from wareloom.functions import infer as I
from wareloom.operators import approximate as A
from wareloom.operators import profiles as P
from wareloom.operators import quality as Q


def test_batches_make_the_whole(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS prof")
    rng = random.Random(1)
    rows = [(i, None if i % 7 == 0 else str(rng.randrange(10**6)), "007" if i % 2 else "8", rng.choice(["2024-01-02", "2024-01-02 03:04", "no", None]), None) for i in range(200)]
    df = spark.createDataFrame(rows, "k int, `a b` string, `it's` string, when_date string, none string")
    for n in range(3):
        assert P.record(df.where(F.col("k") % 3 == n), "prof.states", "t", f"b{n}")
    assert not P.record(df, "prof.states", "t", "b1")
    P.record(df.limit(1), "prof.states", "another", "b0")
    one, two = P.merged(spark, "prof.states", "t"), P.state(df)
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, two.collect()), key=str)
    assert P.column_profiles(one)["a b"] == I.profile(df)["a b"] and P.column_profiles(one)["it's"].leading_zero == 100
    assert I.convert_types(df, P.column_profiles(one)).schema == I.convert_types(df).schema
    assert sorted(map(tuple, P.null_report(one).collect())) == sorted(map(tuple, Q.null_counts(df).collect()))
    assert sorted(map(tuple, P.long_text(one, 5).collect())) == sorted(map(tuple, I.long_text_profile(df, 5).collect()))


def test_a_batch_without_a_column_counts_as_nulls(spark):
    P.record(spark.createDataFrame([("1", "x")], "a string, b string"), "prof.states2", "t", "1")
    P.record(spark.createDataFrame([("2",), ("3",)], "a string"), "prof.states2", "t", "2")
    P.record(spark.createDataFrame([], "a string"), "prof.states2", "t", "3")
    assert dict(map(tuple, P.null_report(P.merged(spark, "prof.states2", "t")).collect())) == {"a": 0, "b": 2}


def test_wide_tables_are_profiled_in_blocks(spark):
    wide = spark.range(3).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(230)])
    assert P.state(wide).where("n_rows = 3 and non_digit = 0 and max_length = 1 and dated = 0").count() == 230


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_every_pair_within_the_distance_is_found(spark, distance):
    rng = random.Random(distance)
    words = ["MAIN ST", "OAK AVE", "PITTSBURGH PA", "AAAAAAAA", "ABABABABAB"]
    base = [f"{rng.randrange(300)} {rng.choice(words)}, {rng.choice(words)}" for _ in range(60)]

    def bent(t):
        for _ in range(rng.randrange(4)):
            i = rng.randrange(len(t))
            t = rng.choice([t[:i] + t[i + 1 :], t[:i] + rng.choice("AX1 ") + t[i:], t[:i] + rng.choice("AX1") + t[i + 1 :]])
        return t

    asked = sorted({bent(rng.choice(base)) for _ in range(150)} | {"AB", "", base[0]})
    near = sorted(set(base) | {"AB", "X"})
    frame = lambda keys: spark.createDataFrame([(k,) for k in keys], "key string")
    got = {(r.key, r.near): r.edits for r in A.nearest(frame(asked), frame(near), distance).collect()}
    full = A.GRAM * distance + 1
    grams = lambda t: len({f"^^{t}$$"[i : i + 3] for i in range(len(t) + 2)})
    want = {(a, b): edits(a, b) for a in asked for b in near if edits(a, b) <= distance and (a == b or min(grams(a), grams(b)) >= full)}
    assert got == want and len(got) > 20


def test_the_nearest_place_and_rows_without_one(spark):
    loc = spark.createDataFrame([("12 Main Street East", 90.0, 1.0, 2.0), ("12 Main Street West", 95.0, 3.0, 4.0), (None, 99.0, 9.0, 9.0)], "FULL_ADDRESS string, score double, longitude double, latitude double")
    df = spark.createDataFrame([(1, "12 main  stret east"), (2, "12 Main Street Wast"), (3, None), (4, "elsewhere"), (4, "elsewhere")], "id int, FULL_ADDRESS string")
    got = sorted(((r.id, r.longitude, r.edits) for r in A.geocode(df, loc).collect()), key=str)
    assert got == sorted([(1, 1.0, 1), (2, 3.0, 1), (3, None, None), (4, None, None), (4, None, None)], key=str)


def test_dense_numbers_make_few_candidates(spark):
    n = 3000
    keys = lambda df: df.select(F.concat(F.lit("CUSTOMER#"), F.lpad(F.col("id").cast("string"), 9, "0"), F.lit(", NATION_"), (F.col("id") % 25).cast("string")).alias("key"))
    asked, near = keys(spark.range(n)).withColumn("key", F.replace("key", F.lit("STOM"), F.lit("SOTM"))), keys(spark.range(n))
    numbered = lambda df: df.withColumns({"id": F.monotonically_increasing_id(), "length": F.length("key")})
    assert A._candidates(numbered(asked), numbered(near), 2).select("id", "near_id").distinct().count() < 30 * n  # by grams: hundreds to an address
    got = A.nearest(asked, near, 2).collect()
    assert len(got) == n and all(r.edits == 2 and r.near == r.key.replace("SOTM", "STOM") for r in got)


def test_rests_of_odd_texts(spark):
    import itertools

    import pandas as pd

    rest = lambda t, gone: "".join(c for i, c in enumerate(t) if i not in gone)
    keys = ["", "a", "aa", "0a0", "00012", "é😀x", "é😀xé"]
    for distance in range(4):
        out = pd.concat(A._rests(distance, "id")([pd.DataFrame({"id": range(len(keys)), "key": keys})]))
        got = out.groupby("id")["rest"].agg(set)
        want = [{rest(t, gone) for d in range(distance + 1) for gone in itertools.combinations(range(len(t)), min(d, len(t)))} for t in keys]
        assert [len(x) for x in got] == [len(x) for x in want]
        for a, b in itertools.combinations(range(len(keys)), 2):
            assert len(got[a] & got[b]) == len(want[a] & want[b])


def test_only_the_nearest_places_count(spark):
    place = lambda t, score, x: (t, score, x, 0.0)
    loc = spark.createDataFrame([place("100 Long Meadow Road", 50.0, 1.0), place("100 Long Meadow Roads", 99.0, 2.0), place("200 Short Hill Lane", 80.0, 3.0), place("209 Short Hill Lane", 80.0, 2.5),
                                 place("200 Short Hill Lanes", 95.0, 4.0)], "FULL_ADDRESS string, score double, longitude double, latitude double")
    df = spark.createDataFrame([(1, "100 Long Meadow Road"), (2, "100 Long Medow Roads"), (3, "201 Short Hill Lane"), (4, "201 Short Hil Lane")], "id int, FULL_ADDRESS string")
    assert {r.id: (r.longitude, r.edits) for r in A.geocode(df, loc).collect()} == {1: (1.0, 0), 2: (2.0, 1), 3: (2.5, 1), 4: (2.5, 2)}
