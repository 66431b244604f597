import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wareloom.llm import hard_negatives as hn


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 40), st.integers(0, 40), st.integers(0, 40), st.integers(1, 9), st.integers(0, 2**32), st.sampled_from([5, 2**40, 2**62]))
def test_strassen_is_exact(rows, inner, columns, leaf, seed, top):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-top, top, (rows, inner)), rng.integers(-top, top, (inner, columns))
    assert (hn.strassen(a, b, leaf) == a @ b).all()  # both modulo 2^64


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 5), st.integers(1, 12), st.integers(1, 6), st.integers(0, 2**32))
def test_best_of_a_row(rows, columns, n, seed):
    rng = np.random.default_rng(seed)
    scores, allowed = rng.integers(-2, 3, (rows, columns)), rng.random((rows, columns)) < 0.7
    got = sorted(zip(*map(np.ndarray.tolist, hn.best(scores, allowed, n))))
    want = [(r, c) for r in range(rows) for c in sorted((c for c in range(columns) if allowed[r, c]), key=lambda c: (-scores[r, c], c))[:n]]
    assert got == sorted(want)


def brute(rows, anchor, positives=5, negatives=5, low=80, high=100, scale=256):
    whole = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(scale * x) for x in v]
        if sum(x * x for x in q) < 2**62:
            whole.append((i, label, q))
    out = []
    for n, (i, label, v) in enumerate(whole):
        if not anchor(i):
            continue
        scored = [(-sum(x * y for x, y in zip(v, w)), j, m, other) for m, (j, other, w) in enumerate(whole) if len(w) == len(v) and m != n]
        for p, j, *_ in sorted(s for s in scored if s[3] == label)[:positives]:
            window = sorted(s for s in scored if s[3] != label and low * -p <= high * -s[0] <= high * -p)[:negatives]
            out += [(i, j, rank, s[1], -p, -s[0]) for rank, s in enumerate(window, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, label, v, "x", 1) for i, label, v in rows], "id long, label int, vector array<double>, row string, score int")


@pytest.mark.parametrize("tile", [(hn.ANCHORS, hn.CANDIDATES), (3, 7)])
def test_against_brute_force(spark, tile):
    rng = np.random.default_rng(1)
    rows = [(i, int(rng.integers(0, 3)) if i % 3 else 0, (rng.standard_normal(9) + 1).round(2).tolist()) for i in range(150)]
    rows += [(i, i % 4, [1.0] * 9) for i in range(150, 180)]  # a group of copies: ties in score
    rows += [rows[0], rows[0], (None, 1, [1.0] * 9), (200, None, [1.0] * 9), (201, 1, None), (202, 1, [None] * 9), (203, 1, [math.nan] * 9), (204, 1, [math.inf] * 9),
             (205, 1, [1.0, 2.0]), (210, 2, [1.0, 2.1]), (220, 1, [1.1, 2.0]), (230, 1, []), (240, 2, []), (250, 1, [1e300] * 9), (260, 1, [-1.0] * 9), (-10, 1, [0.5] * 9)]
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in hn.hard_negatives(df, F.col("id") % 10 == 0, tile=tile).collect())
    assert got == brute(rows, lambda i: i % 10 == 0) and len(got) > 50


def test_few_rows_and_columns(spark):
    empty = frame(spark, [])
    out = hn.hard_negatives(empty, F.col("id") % 10 == 0)
    assert out.count() == 0
    assert [(f.name, f.dataType.simpleString()) for f in out.schema.fields] == [(n, "int" if n == "rank" else "bigint") for n in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")]
    rows = [(0, 1, [1.0]), (1, 1, [1.0]), (2, 2, [0.9]), (3, 2, [0.5])]
    assert [tuple(r) for r in hn.hard_negatives(frame(spark, rows), F.col("id") == 0).collect()] == brute(rows, lambda i: i == 0) == [(0, 1, 1, 2, 65536, 58880)]
