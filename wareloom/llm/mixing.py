"""Mixing sources to target weights by weighted fair queueing.

Native DataFrame functions only.  Documents of a source queue in a shuffled,
reproducible order (MD5 of seed and doc_id), up to ``epochs`` times over.  A
queued copy's virtual finish time is the source's words up to and including
the copy, divided by the source's target; all copies are range-sorted by that
time and taken until the total budget is used.  Targets share the budget by
weight, stop at ``epochs`` times their source's size and pass the excess on by
weight until none is above (water filling).

Scale: texts are scanned once; the queue table (ids, sizes, order) is written
to the shared scratch folder.  Running sums are taken in two levels: per
(source, slice of the shuffled order), then inside a slice, so a source that
holds a third of all rows is spread over all slices.  The global order is cut
by two histograms of virtual times first; only the one fine slot that holds the cut is
sorted exactly, and that holds a millionth part of the copies.  The one-task
windows run over that slot and over one row per source.

Defined cases: null text has size 0; copies of size 0 are never taken
(``taken`` 0); the null source is a source, last in order; a null doc_id is
shuffled as the text ``null``; repeated rows queue one by one; an empty table
gives no rows; ``size``, ``source_size``, ``target`` and ``taken`` of the input
are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wareloom.session import cut_lineage

MADE = ("size", "source_size", "target", "taken")
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: F.Column) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _finish(e: F.Column) -> F.Column:
    """Virtual finish time of the e-th copy of a queued document."""
    return (e.cast("double") * F.col("source_size") + F.col("_until")) / F.col("target")


def _slots(time: F.Column) -> tuple[F.Column, F.Column]:
    """Coarse and fine slot of a time in [0, inf); both grow with it."""
    x = time / (time + 1) * 1024
    return F.floor(x).cast("int"), F.floor((x - F.floor(x)) * 1024).cast("int")


def shuffle_key(seed: str) -> F.Column:
    """A hex text that both Spark and the oracle compute alike."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))).cast("binary"))


def source_targets(sources: DataFrame, budget_share: float = 1.0, weights: tuple = (1, 2, 3), epochs: int = 3) -> DataFrame:
    """(source, source_size, weight, target) from (source, source_size): one row per source."""
    ranked = sources.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    everything = Window.partitionBy()
    caps = ranked.withColumn("weight", weight).withColumn("_cap", epochs * F.col("source_size").cast("double"))
    caps = caps.withColumn("_budget", F.sum("source_size").over(everything) * F.lit(budget_share))
    order = Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    caps = caps.withColumns({
        "_before": F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)),
        "_left": F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)),
    })
    level = (F.col("_budget") - F.col("_before")) / F.col("_left")
    # the first source in this order that its share does not overfill sets the level of all later ones
    level = F.min(F.when(level * F.col("weight") <= F.col("_cap"), F.struct(F.col("_cap") / F.col("weight"), F.col("_rank"), level))).over(everything)["col3"]
    target = F.least(F.col("_cap"), F.coalesce(level * F.col("weight"), F.col("_cap")))
    return caps.withColumn("target", target).select("source", "source_size", "weight", "target")


def mix(docs: DataFrame, seed: str = "mix", budget_share: float = 1.0, weights: tuple = (1, 2, 3), epochs: int = 3) -> DataFrame:
    """``docs`` (without text) with size, source_size, target and taken (words the mix takes, repeats counted)."""
    rest = [c for c in docs.columns if c not in (*MADE, "text")]
    doc = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).alias("_doc")  # no name of the input meets one made here
    queue = docs.select(doc, "source", word_count(F.col("text")).alias("size"), shuffle_key(seed).alias("_key"))
    queue = cut_lineage(queue.withColumn("_slice", F.conv(F.substring("_key", 1, 3), 16, 10).cast("int")), "mix-queue")

    slices = queue.groupBy("source", "_slice").agg(F.sum("size").alias("_words"))
    before = F.sum("_words").over(Window.partitionBy("source").orderBy("_slice")) - F.col("_words")
    slices = cut_lineage(slices.withColumn("_before", before), "mix-slices")
    targets = source_targets(slices.groupBy("source").agg(F.sum("_words").alias("source_size")), budget_share, weights, epochs)
    targets = cut_lineage(targets, "mix-targets")
    starts = slices.join(targets, slices["source"].eqNullSafe(targets["source"])).select(
        slices["source"].alias("_s"), slices["_slice"].alias("_i"), "_before", "source_size", "target")

    inner = Window.partitionBy("source", "_slice").orderBy("_key", "size").rowsBetween(Window.unboundedPreceding, 0)
    queue = queue.withColumn("_in", F.sum("size").over(inner))
    queue = queue.join(starts, queue["source"].eqNullSafe(starts["_s"]) & (queue["_slice"] == starts["_i"])).drop("_s", "_i")
    queue = cut_lineage(queue.withColumn("_until", F.col("_before") + F.col("_in")), "mix-times")

    budget = targets.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0] * budget_share
    live = (F.col("size") > 0) & (F.col("target") > 0)
    copies = queue.where(live).withColumn("_e", F.explode(F.array(*[F.lit(e) for e in range(epochs)])))
    coarse, fine = _slots(_finish(F.col("_e")))
    copies = copies.select("source", "size", "_key", "_e", _finish(F.col("_e")).alias("_time"), coarse.alias("_coarse"), fine.alias("_fine"))
    used, slot, end = 0, [], None
    for column in ("_coarse", "_fine"):  # two histograms of 1024 slots at most find the slot that holds the cut
        held = copies
        for c, v in zip(("_coarse", "_fine"), slot):
            held = held.where(F.col(c) == v)
        for s, words in sorted(map(tuple, held.groupBy(column).agg(F.sum("size")).collect())):
            if used + words > budget:
                slot.append(s)
                break
            used += words
    if len(slot) == 2:
        last = copies.where((F.col("_coarse") == slot[0]) & (F.col("_fine") == slot[1]))
        order = Window.orderBy("_time", F.col("source").asc_nulls_last(), "_key", "size", "_e")
        run = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0))
        last = last.withColumn("_run", run).where(F.col("_run") + F.lit(used) <= budget)
        end = last.orderBy(F.desc("_run")).select("_time", "source", "_key", "size", "_e").first()

    def taken_once(e: int) -> F.Column:
        if len(slot) < 2:
            return F.lit(1)  # the budget covers every copy
        at = _slots(_finish(F.lit(e)))
        inside = (at[0] < slot[0]) | ((at[0] == slot[0]) & (at[1] < slot[1]))
        if end is not None:
            mine = (_finish(F.lit(e)), F.col("source").isNull(), F.coalesce("source", F.lit("")), F.col("_key"), F.col("size"), F.lit(e))
            edge = (end[0], end[1] is None, end[1] or "", *end[2:4], end[4])
            upto = F.struct(*mine) <= F.struct(*[F.lit(v).cast(t) for v, t in zip(edge, ("double", "boolean", "string", "string", "long", "int"))])
            inside = inside | ((at[0] == slot[0]) & (at[1] == slot[1]) & upto)
        return F.when(inside, 1).otherwise(0)

    times = sum((taken_once(e) for e in range(epochs)), F.lit(0))
    taken = F.when(live, F.col("size") * times).otherwise(0).cast("long")
    return queue.withColumn("taken", taken).select(*[F.col(f"_doc.c{i}").alias(c) for i, c in enumerate(rest)], *MADE)
