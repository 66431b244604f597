"""Connected components of a link table, without collecting it anywhere.

Tasks first reduce their links to a spanning forest by union-find; then every
round hooks each node to its smallest neighbour and contracts the links, with
the lineage cut in the shared folder.  A node with very many links is a hot
key of plain equi-joins, which adaptive execution splits, and of aggregations
that combine map-side.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.session import cut_lineage, ship_package


def find(parent: dict, x: int) -> int:
    root = x
    while parent[root] != root:
        root = parent[root]
    while parent[x] != root:
        parent[x], x = root, parent[x]
    return root


def forest(pairs, parent: dict | None = None) -> dict:
    """Union-find over pairs: node -> smallest node of its tree."""
    parent = {} if parent is None else parent
    for a, b in pairs:
        a, b = find(parent, parent.setdefault(a, a)), find(parent, parent.setdefault(b, b))
        if a != b:
            parent[max(a, b)] = min(a, b)
    return parent


def _forest(batches):
    parent: dict = {}
    for batch in batches:
        forest(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()), parent)
    nodes = [x for x in parent if find(parent, x) != x]
    if nodes:
        roots = np.array([find(parent, x) for x in nodes], dtype=np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.array(nodes, dtype=np.int64)), pa.array(roots)], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a long, b long); component is its smallest node."""
    ship_package(links.sparkSession)
    left = cut_lineage(links.select("a", "b").where("a <> b").mapInArrow(_forest, "a long, b long"), "links")
    labels = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = cut_lineage(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("to")).withColumnRenamed("a", "node"), "hooks")
        if labels is None:
            labels = hook.select("node", F.col("to").alias("component"))
        else:
            step = hook.select(F.col("node").alias("component"), "to")
            labels = cut_lineage(labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        on = lambda c: hook.select(F.col("node").alias(c), F.col("to").alias(f"{c}_to"))
        moved = left.join(on("a"), "a").join(on("b"), "b").select(F.greatest("a_to", "b_to").alias("a"), F.least("a_to", "b_to").alias("b"))
        left = cut_lineage(moved.where("a <> b").distinct(), "links")
    if labels is None:
        return links.sparkSession.range(0).select(F.col("id").alias("node"), F.col("id").alias("component"))
    return labels


def vertex_ids(rows: DataFrame, id_col: str) -> tuple[DataFrame, bool]:
    """``rows`` (id, digest) with ``_vertex``, an id that no two digests share, and whether any id did.

    An id with several digests stays with the smallest of them; the others get numbers from 2^62 on.
    """
    twice = rows.groupBy(id_col).agg(F.min("digest").alias("_own"), F.max("digest").alias("_last")).where("_own < _last").drop("_last")
    twice = cut_lineage(twice, "repeated-ids")
    if twice.isEmpty():
        return rows.withColumn("_vertex", F.col(id_col)), False
    other = F.lit(1 << 62).bitwiseOR(F.shiftrightunsigned(F.xxhash64("digest"), 2))
    own = F.col("_own").isNull() | (F.col("_own") == F.col("digest"))
    return rows.join(twice, id_col, "left").withColumn("_vertex", F.when(own, F.col(id_col)).otherwise(other)).drop("_own"), True


def smallest_ids(vertices: DataFrame, groups: DataFrame, repeated: bool) -> DataFrame:
    """(digest, component_id, group): the smallest id in the component of each of ``vertices`` (digest, node, least), and the component's own number."""
    at = vertices.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    if not repeated:
        return at.select("digest", F.col("component").alias("component_id"), F.col("component").alias("group"))
    least = at.groupBy("component").agg(F.min("least").alias("component_id"))
    return at.join(least, "component").select("digest", "component_id", F.col("component").alias("group"))
