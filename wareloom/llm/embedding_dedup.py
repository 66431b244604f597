"""Embedding near-duplicates by Euclidean p-stable hashing.

Vectors are normalised, projected on Gaussian directions, shifted and cut into
cells of width ``WIDTH``; ``k`` cells make a bucket of a table, and there are
``l`` tables.  ``k`` and ``l`` follow from the number of vectors, so that random pairs
rarely meet while a pair at the limit is missed with probability ``MISS``.
Candidates are checked by cosine in double precision; links are pairs at
``cosine`` or above, groups are their connected components.

How: equal vectors are one vertex with a multiplicity.  In a bucket every
member is first checked against the smallest member.  Buckets that then still
hold two components are checked across components: those of up to ``FEW``
members by their pairs, larger ones in blocks of at most ``2 * BLOCK`` vectors,
which return a spanning forest of the links found, never all pairs.  As links lie inside components, each vertex's links are then counted
exactly by matrix products over blocks of its component.  No bucket is capped.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite
components has no links; so has a row with a null vec_id (component_id null,
kept); vectors of different length never link; rows that share a vec_id are
vectors of their own; an empty table gives no rows; other columns, labels
among them, are not read.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.llm.components import components as connected
from wareloom.llm.components import find, forest, smallest_ids, vertex_ids
from wareloom.llm.text_hash import BASE, mix
from wareloom.session import cut_lineage, ship_package

WIDTH, MISS, BLOCK, FEW, SEED = 2.0, 1e-4, 256, 16, 11


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised Gaussian projection agrees for two points at a distance."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def parameters(n: int, cosine: float) -> tuple[int, int]:
    """(cells per bucket, tables) for n vectors: random pairs meet in a table with probability 1 / (4 n) at most."""
    k = math.ceil(math.log(4 * max(n, 2)) / -math.log(collision(math.sqrt(2))))
    return k, math.ceil(math.log(MISS) / math.log1p(-collision(math.sqrt(2 - 2 * cosine)) ** k))


def unit(values) -> np.ndarray | None:
    """The normalised vector in double precision; None where it cannot link."""
    if values is None or not len(values):
        return None
    x = np.array([math.nan if v is None else v for v in values], dtype=np.float64)
    top = np.abs(x).max() if len(x) else 0.0
    if not np.isfinite(top) or top == 0:
        return None
    x = x / top
    return x / np.sqrt((x * x).sum()) + 0.0


def _lists(rows: np.ndarray, kind) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32()), pa.array(np.ascontiguousarray(rows).reshape(-1), kind))


def _normalise(batches):
    for batch in batches:
        out = [(i, u) for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()) if i is not None and (u := unit(v)) is not None]
        yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in out], pa.int64()), pa.array([hashlib.blake2b(u.tobytes(), digest_size=16).digest() for _, u in out], pa.binary()),
                                          pa.array([u for _, u in out], pa.list_(pa.float64()))], ["vec_id", "digest", "unit"])


def _by_dim(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each vector length of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat, begin = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()[:-1]
    return [(at := np.flatnonzero(size == d), flat[begin[at][:, None] + np.arange(d)]) for d in np.unique(size)]


def _hash(k: int, tables: int):
    def run(batches):
        for batch in batches:
            keys = np.zeros((batch.num_rows, tables), dtype=np.int64)
            for at, x in _by_dim(batch.column("unit")):
                rng = np.random.default_rng([SEED, x.shape[1]])
                key = np.zeros((len(at), tables), np.uint64) + mix(np.arange(tables, dtype=np.uint64) * np.uint64(BASE) + np.uint64(x.shape[1]))
                for _ in range(k):  # one projection of every table at a time
                    cell = np.floor((x @ rng.standard_normal((x.shape[1], tables)) + rng.uniform(0, WIDTH, tables)) / WIDTH)
                    key = mix(key * np.uint64(BASE) + cell.astype(np.int64).view(np.uint64))
                keys[at] = key.view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("node"), _lists(keys, pa.int64())], ["node", "buckets"])

    return run


def _check(cosine: float):
    def run(batches):
        for batch in batches:
            keep = np.zeros(batch.num_rows, dtype=bool)
            two = dict()
            for at, y in _by_dim(batch.column("unit_b")):
                two |= dict(zip(at.tolist(), y))
            for at, x in _by_dim(batch.column("unit_a")):
                same = np.array([len(two[i]) == x.shape[1] for i in at.tolist()], dtype=bool)
                if same.any():
                    y = np.stack([two[i] for i in at[same].tolist()])
                    keep[at[same]] = (x[same] * y).sum(axis=1) >= cosine
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], ["a", "b"])

    return run


def _near(table: pa.Table, cosine: float):
    """Row and column numbers of a block, and which of their pairs are near; a block of one chunk counts a pair in both orders."""
    side = table.column("part").to_numpy()
    own = table.column("i")[0].as_py() == table.column("j")[0].as_py()
    for at, x in _by_dim(table.column("unit")):
        one, two = np.flatnonzero(side[at] == 0), np.flatnonzero(side[at] == (0 if own else 1))
        near = x[one] @ x[two].T >= cosine
        if own:
            np.fill_diagonal(near, False)
        yield at[one], at[two], near


def _cross(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        node, group = table.column("node").to_numpy(), table.column("group").to_numpy()
        parent: dict = {}
        for one, two, near in _near(table, cosine):
            near &= group[one][:, None] != group[two][None, :]
            forest(((int(node[one[r]]), int(node[two[c]])) for r, c in zip(*np.nonzero(near))), parent)
        tree = [(x, find(parent, x)) for x in parent]
        tree = [(a, b) for a, b in tree if a != b]
        return pa.table({"a": pa.array([a for a, _ in tree], pa.int64()), "b": pa.array([b for _, b in tree], pa.int64())})

    return run


def _count(cosine: float):
    def run(table: pa.Table) -> pa.Table:
        times = table.column("times").to_numpy()
        links = np.zeros(table.num_rows, dtype=np.int64)
        own = table.column("i")[0].as_py() == table.column("j")[0].as_py()
        for one, two, near in _near(table, cosine):
            links[one] += near @ times[two]
            if not own:
                links[two] += near.T @ times[one]
        return pa.table({"node": table.column("node"), "links": pa.array(links)})

    return run


def _blocks(rows: DataFrame, key: str) -> DataFrame:
    """Rows of groups of ``key`` dealt to pairs (i <= j) of chunks of about BLOCK rows."""
    size = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_size"))
    chunks = F.ceil(F.col("_size") / F.lit(BLOCK)).cast("int")
    dealt = rows.join(size, key).withColumn("_chunk", F.pmod(F.xxhash64("node"), chunks).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), chunks - 1)))
    dealt = dealt.withColumns({"i": F.least("_chunk", "_other"), "j": F.greatest("_chunk", "_other")})
    return dealt.withColumn("part", F.when(F.col("_chunk") == F.col("i"), 0).otherwise(1)).drop("_size", "_chunk", "_other")


def near_vectors(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding)."""
    ship_package(vectors.sparkSession)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    units = cut_lineage(rows.mapInArrow(_normalise, "vec_id long, digest binary, unit array<double>"), "units")
    named, repeated = vertex_ids(units, "vec_id")
    vertices = named.groupBy("digest").agg(F.min("_vertex").alias("node"), F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("times"), F.first("unit").alias("unit"))
    vertices = cut_lineage(vertices, "vectors")
    k, tables = parameters(vertices.count(), cosine)

    hashed = vertices.select("node", "unit").mapInArrow(_hash(k, tables), "node long, buckets array<long>")
    members = cut_lineage(hashed.select("node", F.explode("buckets").alias("bucket")), "vector-buckets")
    shared = members.groupBy("bucket").agg(F.min("node").alias("head"), F.max("node").alias("_last")).where("head < _last").drop("_last")
    held = cut_lineage(members.join(shared, "bucket"), "shared-buckets")
    side = lambda x: vertices.select(F.col("node").alias(x), F.col("unit").alias(f"unit_{x}"))
    star = held.where("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b")).distinct()
    links = cut_lineage(star.join(side("a"), "a").join(side("b"), "b").mapInArrow(_check(cosine), "a long, b long"), "vector-links")
    groups = connected(links)

    label = held.join(groups, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("group"))
    open_ = label.groupBy("bucket").agg(F.min("group").alias("_lo"), F.max("group").alias("_hi"), F.count(F.lit(1)).alias("_n")).where("_lo < _hi")
    rest = cut_lineage(label.join(open_.select("bucket", "_n"), "bucket"), "open-vector-buckets")
    few = rest.where(F.col("_n") <= FEW)
    one = few.select("bucket", F.col("node").alias("a"), F.col("group").alias("_ga"))
    two = few.select("bucket", F.col("node").alias("b"), F.col("group").alias("_gb"))
    pairs = one.join(two, "bucket").where("a > b and _ga <> _gb").select("a", "b").distinct().join(star, ["a", "b"], "left_anti")
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(_check(cosine), "a long, b long")
    many = rest.where(F.col("_n") > FEW).drop("_n").join(vertices.select("node", "unit"), "node")
    blocks = _blocks(many, "bucket").groupBy("bucket", "i", "j").applyInArrow(_cross(cosine), "a long, b long")
    more = cut_lineage(pairs.unionByName(blocks), "cross-links")
    if not more.isEmpty():
        groups = connected(links.unionByName(more))

    inside = vertices.join(groups, "node").select("node", "component", "times", "unit")
    counts = _blocks(inside, "component").groupBy("component", "i", "j").applyInArrow(_count(cosine), "node long, links long")
    counts = counts.groupBy("node").agg(F.sum("links").alias("links"))
    found = smallest_ids(vertices.select("digest", "node", "least", "times"), groups, repeated)
    links = vertices.join(counts, "node", "left").select("digest", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    linked = units.select("vec_id", "digest").join(found.join(links, "digest"), "digest").select("vec_id", "n_links", "component_id")
    alone = rows.mapInArrow(_unlinkable, "vec_id long").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _unlinkable(batches):
    for batch in batches:
        out = [i for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding").to_pylist()) if i is None or unit(v) is None]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], ["vec_id"])
