"""Benchmark decontamination by winnowing.

Words are lower-cased in A-Z and match ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A
window is ``window`` consecutive words of an item; a shorter item is one window
as a whole.  A document word inside any occurrence of a window is hit.

How: of every run of ``window - k + 1`` hashed k-grams the smallest (the last
of equals) is a fingerprint, so two texts that share ``window`` words share a
fingerprint inside them.  The benchmark's fingerprints meet the documents' in
the tasks; every match is extended to the windows around it, whose words are
compared one by one, so hash collisions cannot make a hit.  Short items are
winnowed the same way, one class per length.  The benchmark is broadcast in
blocks of about ``block_bytes``; beyond one block the documents pass once per
block, carrying the marked words along, with the lineage cut in between.
Windows with equal words are kept once, with the list of their items.

Defined cases: a null or empty text has no words and is clean; items without
words have no windows; a null item_id is named by the empty string and equal
item_ids count once; repeated rows are judged alike; with an empty benchmark
everything is clean; result columns of the input are replaced.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wareloom.llm.text_hash import ALNUM, ngrams, slices, words
from wareloom.session import cut_lineage, ship_package

K = 5
BLOCK_BYTES = 4 << 20
MADE = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
NAMES = [x.strip().split(" ")[0] for x in MADE.split(",")]


def winnow(hashes: np.ndarray, first: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, word positions) of texts of ``length`` words or more.

    ``first`` has the word index where each text begins, and the end.
    """
    grams = ngrams(hashes, k)
    w = length - k + 1
    starts = len(hashes) - length + 1
    if starts <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    best, at = grams[:starts].copy(), np.arange(starts)
    for j in range(1, w):
        here = grams[j : j + starts]
        less = here <= best
        best[less] = here[less]
        at[less] = np.flatnonzero(less) + j
    # windows that cross from one text into the next do not count
    inside = np.ones(starts, dtype=bool)
    for end in first[1:-1]:
        inside[max(0, int(end) - length + 1) : int(end)] = False
    at = np.unique(at[inside])
    return grams[at], at


class Block:
    """Fingerprints and windows of a block of items, by window length."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.classes = []
        by_length = defaultdict(list)
        for item, text in items:
            data = pa.array([text], pa.string())
            for _, raw, off in slices(data, 1 << 62):
                s, e, h, _ = words(raw, off, ALNUM)
                if len(s):
                    lowered = raw.tobytes().lower()
                    by_length[min(window, len(s))].append((item, h, [lowered[a:b] for a, b in zip(s, e)]))
        for length, held in sorted(by_length.items()):
            k = min(K, length)
            prints, windows = [], {}
            for item, h, tokens in held:
                prints.append(winnow(h, np.array([0, len(h)]), length, k)[0])
                for i in range(len(tokens) - length + 1):
                    windows.setdefault(b" ".join(tokens[i : i + length]), set()).add(item)
            groups: dict = {}
            # window -> number of its set of items, so documents merge few sets
            numbered = {wd: groups.setdefault(frozenset(ids), len(groups)) for wd, ids in windows.items()}
            self.classes.append((length, k, np.unique(np.concatenate(prints)), numbered, list(groups)))


def _hits(block: Block, raw: np.ndarray, off: np.ndarray):
    """For each text of a slice: number of words, hit word positions, items."""
    s, e, h, first = words(raw, off, ALNUM)
    n = len(off) - 1
    hit = [None] * n
    items: list = [None] * n
    for length, k, prints, windows, groups in block.classes:
        found, at = winnow(h, first, length, k)
        if not len(found):
            continue
        where = np.minimum(np.searchsorted(prints, found), len(prints) - 1)
        at = at[prints[where] == found]
        if not len(at):
            continue
        doc = np.searchsorted(first, at, side="right") - 1
        # all windows that hold the matched k-gram, inside its text
        begin = (at[:, None] - np.arange(length - k, -1, -1)[None, :])
        ok = (begin >= first[doc][:, None]) & (begin + length <= first[doc + 1][:, None])
        begin = np.unique(begin[ok])
        for d in np.unique(np.searchsorted(first, begin, side="right") - 1):
            mine = begin[(begin >= first[d]) & (begin < first[d + 1])]
            cache: dict = {}
            sets = set()
            marks = np.zeros(int(first[d + 1] - first[d]), dtype=bool) if hit[d] is None else hit[d]
            for b in mine.tolist():
                for j in range(b, b + length):
                    if j not in cache:
                        cache[j] = raw[s[j] : e[j]].tobytes().lower()
                group = windows.get(b" ".join([cache[j] for j in range(b, b + length)]))
                if group is not None:
                    sets.add(group)
                    marks[b - first[d] : b - first[d] + length] = True
            if sets:
                hit[d] = marks
                items[d] = (items[d] or set()).union(*(groups[g] for g in sets))
    return np.diff(first), hit, items


def _judge(held, last: bool, ratio: int):
    def run(batches):
        block = held.value if held else Block([], 1)
        for batch in batches:
            counts, spans, names = [], [], []
            old_hits, old_items = batch.column("_hits"), batch.column("_items")
            for row, raw, off in slices(batch.column("text")):
                n, hit, items = _hits(block, raw, off)
                for i in range(len(n)):
                    was, ids = old_hits[row + i].as_py(), set(old_items[row + i].as_py() or ())
                    marks = hit[i]
                    if was:
                        marks = np.zeros(int(n[i]), dtype=bool) if marks is None else marks
                        marks[np.array(was)] = True
                    counts.append(int(n[i]))
                    spans.append(marks)
                    names.append(ids | (items[i] or set()))
            columns = {f.name: batch.column(i) for i, f in enumerate(batch.schema) if f.name not in ("_hits", "_items")}
            if last:
                n_hit = [0 if m is None else int(m.sum()) for m in spans]
                columns["n_words"] = pa.array(counts, pa.int64())
                columns["n_hit"] = pa.array(n_hit, pa.int64())
                columns["n_items"] = pa.array([len(x) for x in names], pa.int64())
                columns["items_sha256"] = pa.array([hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in names], pa.string())
                columns["contaminated"] = pa.array([h > 0 and ratio * h >= c for h, c in zip(n_hit, counts)], pa.bool_())
            else:
                columns["_hits"] = pa.array([None if m is None else np.flatnonzero(m) for m in spans], pa.list_(pa.int32()))
                columns["_items"] = pa.array([sorted(x) for x in names], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return run


def _blocks(benchmark: DataFrame, block_bytes: int):
    """Lists of distinct (item name, text), each of about ``block_bytes`` of text or one item."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.coalesce("text", F.lit("")).alias("text")).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text") + 16), F.lit(0))).first()[0]
    n = max(1, -(-2 * total // block_bytes)) if total > block_bytes else 1
    placed = items.withColumn("_block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
    for b in range(n):
        yield [(r.item, r.text) for r in placed.where(F.col("_block") == b).select("item", "text").toLocalIterator()]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 13, ratio: int = 20, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated (n_hit > 0 and ratio * n_hit >= n_words)."""
    spark = docs.sparkSession
    ship_package(spark)
    plain = docs.drop(*NAMES, "_hits", "_items")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    state = plain.withColumns({"_hits": F.lit(None).cast("array<int>"), "_items": F.lit(None).cast("array<string>")})
    held = None
    for items in _blocks(benchmark, block_bytes):
        if held is not None:
            state = cut_lineage(state.mapInArrow(_judge(held, False, ratio), schema + ", _hits array<int>, _items array<string>"), "hits")
        held = spark.sparkContext.broadcast(Block(items, window))
    return state.mapInArrow(_judge(held, True, ratio), f"{schema}, {MADE}")
