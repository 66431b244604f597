"""Hard negatives by exact tile products.

Every component x becomes floor(scale * x), as an int64.  Scores of anchors and
candidates are integer inner products, taken tile by tile with Strassen's
recursion: matrices are padded with zeros to even sides, halved, and seven
products of sums replace eight.  Sums wrap modulo 2^64, so a score is exact
whenever it is an int64 itself.

How: anchors and candidates of equal length are dealt to tiles of about
``ANCHORS`` x ``CANDIDATES`` by a hash of their row number, each candidate once for every
chunk of anchors.  First only rows with the anchor's label meet, and every tile keeps
the best ``positives`` per anchor; then all meet, and every tile keeps the best
``negatives`` per anchor and positive whose score lies in the positive's window.
These small heaps merge: the best of their union (a row-number window, which Spark
already limits before the shuffle) are the best of all.  No tile grows with a
label or with a group of copies, and no score outlives its tile.

Defined cases: rows with a null id, label, vector or component, or a non-finite
component, take no part, nor do vectors whose squared length after scaling is
2^62 or more (their scores would not be int64); vectors of different length
never meet; rows that share an id are rows of their own, and an anchor is not
its own positive but a copy of it can be; ties go to the smaller id; a positive
with a negative score has an empty window; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wareloom.session import cut_lineage, ship_package

ANCHORS, CANDIDATES, LEAF = 1024, 4096, 16
LEAST = np.iinfo(np.int64).min


def _even(x: np.ndarray) -> np.ndarray:
    """Zero rows and columns up to even sides."""
    return np.pad(x, ((0, x.shape[0] % 2), (0, x.shape[1] % 2))) if x.shape[0] % 2 or x.shape[1] % 2 else x


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The int64 product of two matrices, modulo 2^64."""
    rows, columns = a.shape[0], b.shape[1]
    if min(rows, a.shape[1], columns) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    (r, k), c = (x // 2 for x in a.shape), b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :k], a[:r, k:], a[r:, :k], a[r:, k:]
    b11, b12, b21, b22 = b[:k, :c], b[:k, c:], b[k:, :c], b[k:, c:]
    out = np.empty((2 * r, 2 * c), dtype=np.int64)
    m = strassen(a11 + a22, b11 + b22, leaf)
    out[:r, :c] = m
    out[r:, c:] = m
    m = strassen(a21 + a22, b11, leaf)
    out[r:, :c] = m
    out[r:, c:] -= m
    m = strassen(a11, b12 - b22, leaf)
    out[:r, c:] = m
    out[r:, c:] += m
    m = strassen(a22, b21 - b11, leaf)
    out[:r, :c] += m
    out[r:, :c] += m
    m = strassen(a11 + a12, b22, leaf)
    out[:r, :c] -= m
    out[:r, c:] += m
    out[r:, c:] += strassen(a21 - a11, b11 + b12, leaf)
    out[:r, :c] += strassen(a12 - a22, b21 + b22, leaf)
    return out[:rows, :columns]


def best(scores: np.ndarray, allowed: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, columns) of the n best allowed scores of each row; of equal scores the first columns."""
    score = np.where(allowed, scores, LEAST)
    if score.shape[1] > n:
        edge = np.partition(score, score.shape[1] - n, axis=1)[:, score.shape[1] - n, None]
        above, level = score > edge, score == edge
        room = n - above.sum(axis=1, dtype=np.int32, keepdims=True)
        take = above | (level & (np.cumsum(level, axis=1, dtype=np.int32) <= room))
    else:
        take = np.ones(score.shape, dtype=bool)
    return np.nonzero(take & allowed)


def _ints(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _tile(anchors: pa.Table, candidates: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The candidates by id, and the scores of a tile."""
    candidates = candidates.sort_by([("id", "ascending"), ("row", "ascending")])
    return candidates, strassen(_ints(anchors.column("ints")), np.ascontiguousarray(_ints(candidates.column("ints")).T))


FOUND = ["anchor", "of", "row", "id", "score"]


def _heap(anchors: pa.Table, of, candidates: pa.Table, scores: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> pa.Table:
    rows, columns = at
    take = lambda t, name, i: t.column(name).take(pa.array(i)).combine_chunks()
    return pa.table([take(anchors, "row", rows), pa.array(of[rows]), take(candidates, "row", columns), take(candidates, "id", columns), pa.array(scores[rows, columns])], FOUND)


def _positives(n: int):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        if not anchors.num_rows or not candidates.num_rows:
            return pa.table([pa.array([], pa.int64())] * 5, FOUND)
        candidates, scores = _tile(anchors, candidates)
        row = anchors.column("row").to_numpy()
        return _heap(anchors, row, candidates, scores, best(scores, row[:, None] != candidates.column("row").to_numpy()[None, :], n))

    return run


def _negatives(n: int, low: int, high: int):
    def run(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        found = [pa.table([pa.array([], pa.int64())] * 5, FOUND)]
        if anchors.num_rows and candidates.num_rows:
            candidates, scores = _tile(anchors, candidates)
            held = anchors.column("held").to_pylist()
            other = anchors.column("label").to_numpy()[:, None] != candidates.column("label").to_numpy()[None, :]
            for p in range(max(map(len, held))):
                mine = np.array([i for i, h in enumerate(held) if len(h) > p])
                # low * positive <= high * score <= high * positive, in whole numbers
                bounds = np.array([(-(-low * held[i][p]["score"] // high), held[i][p]["score"]) for i in mine], dtype=np.int64)
                score = scores[mine]
                inside = other[mine] & (score >= bounds[:, :1]) & (score <= bounds[:, 1:])
                some = np.flatnonzero(inside.any(axis=1))
                rows, columns = best(score[some], inside[some], n)
                of = np.zeros(len(held), dtype=np.int64)
                of[mine] = [held[i][p]["row"] for i in mine]
                found.append(_heap(anchors, of, candidates, scores, (mine[some[rows]], columns)))
        return pa.concat_tables(found)

    return run


def _dealt(anchors: DataFrame, rows: DataFrame, key: list[str], tile: tuple[int, int]):
    """Both sides with tile numbers (i, j): anchors in chunks i, rows in chunks j, of each group of ``key`` that has anchors."""
    count = F.count(F.lit(1))
    sizes = rows.groupBy(*key).agg(count.alias("_rows")).join(anchors.groupBy(*key).agg(count.alias("_anchors")), key)
    many_i, many_j = F.ceil(F.col("_anchors") / tile[0]).cast("int"), F.ceil(F.col("_rows") / tile[1]).cast("int")
    chunk = lambda n: F.pmod(F.xxhash64("row"), n).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    a = anchors.join(sizes, key).withColumns({"i": chunk(many_i)}).withColumn("j", every(many_j)).drop("_rows", "_anchors")
    r = rows.join(sizes, key).withColumns({"j": chunk(many_j)}).withColumn("i", every(many_i)).drop("_rows", "_anchors")
    return a.groupBy(*key, "i", "j"), r.groupBy(*key, "i", "j")


def _merge(found: DataFrame, key: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy(F.desc("score"), "id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100, scale: int = 256,
                   tile: tuple[int, int] = (ANCHORS, CANDIDATES)) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score from ``vectors`` (id, label, vector).

    An anchor's positives are its best ``positives`` rows of its label; their negatives are the best ``negatives`` rows of
    other labels with low * positive_score <= high * score <= high * positive_score.
    """
    ship_package(vectors.sparkSession)
    x = F.col("vector").cast("array<double>")
    whole = lambda v: F.floor(v * F.lit(float(scale)))
    usable = vectors.where("id is not null and label is not null and vector is not null").select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"), x.alias("x"))
    usable = usable.where(F.forall("x", lambda v: F.coalesce(F.abs(v) < float("inf"), F.lit(False))))
    usable = usable.where(F.aggregate("x", F.lit(0.0), lambda s, v: s + F.pow(F.floor(v * F.lit(float(scale))).cast("double"), F.lit(2.0))) < 2.0**62)
    rows = usable.select(F.monotonically_increasing_id().alias("row"), "id", "label", "anchor", F.transform("x", lambda v: whole(v).cast("long")).alias("ints"))
    rows = cut_lineage(rows.withColumn("length", F.size("ints")), "whole-vectors")
    anchors, rows = rows.where("anchor").drop("anchor"), rows.drop("anchor")
    anchors = anchors.toDF(*anchors.columns)  # columns of their own, as both sides meet in a cogroup
    schema = ", ".join(f"{c} long" for c in FOUND)

    one, two = _dealt(anchors, rows, ["length", "label"], tile)
    near = one.cogroup(two).applyInArrow(_positives(positives), schema)
    near = cut_lineage(_merge(near, ["anchor"], positives), "positives")
    held = near.groupBy("anchor").agg(F.collect_list(F.struct("row", "id", "score")).alias("held"))  # ``positives`` at most
    asked = cut_lineage(anchors.join(held.withColumnRenamed("anchor", "row"), "row"), "anchors")
    one, two = _dealt(asked, rows, ["length"], tile)
    far = one.cogroup(two).applyInArrow(_negatives(negatives, low, high), schema)
    far = _merge(far, ["anchor", "of"], negatives)

    pairs = asked.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"), F.explode("held").alias("p"))
    pairs = pairs.select("anchor", "anchor_id", F.col("p.row").alias("of"), F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"))
    far = far.select("anchor", "of", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(far, ["anchor", "of"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
